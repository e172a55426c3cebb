"""Embedding near-dedup: an exact metric range join of a table with itself.

Unit vectors at cosine >= t are unit vectors at chord distance <= r with
r^2 = 2 - 2t. Pivots partition the vectors into cells (nearest pivot). By
the triangle inequality a vector can only link into another cell if it is
no farther from that cell's pivot than the cell's radius plus r, and no more
than 2r farther than from its own; in Euclidean space its distance to the
plane between the two pivots is at most r, too. It is copied to those cells
only (to the lower-numbered of the two, where the pair meets once), and the
cells then join independently, block by block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, doubles, seeded, ship
from .components import components

SLACK = 1e-7  # replication bounds are widened by this; decisions are not


@dataclass(frozen=True)
class Pivots:
    """Unit pivots of one dimension and the cells' radii, if known."""
    points: np.ndarray
    radius: np.ndarray | None = None


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spread_pivots(sample: np.ndarray, k: int, apart: float) -> np.ndarray:
    """Up to ``k`` points of ``sample``, each pair farther than ``apart`` (one at least)."""
    chosen = [0]
    near = sample @ sample[0]
    limit = 1 - apart * apart / 2
    while len(chosen) < k:
        free = np.flatnonzero(near <= limit)
        if not len(free):
            break
        chosen.append(int(free[0]))
        near = np.maximum(near, sample @ sample[free[0]])
    return sample[chosen]


def chords(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ pivots.T)))


def by_dim(batch: pa.RecordBatch, col: str):
    """(row numbers, matrix) for each length of list in the batch."""
    lists = batch.column(col)
    sizes = np.asarray(lists.value_lengths())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, np.asarray(lists.take(pa.array(at)).flatten(), dtype=float).reshape(-1, dim)


def assigner(pivots):
    """Rows (cid, vec) -> (cid, unit vec, dim, home cell, distance to its pivot)."""
    def run(batches):
        for b in batches:
            for dim, at, x in by_dim(b, "vec"):
                u = unit(x, dim)
                p = pivots.value.get(dim)
                d = chords(u, p.points) if p is not None else np.zeros((len(u), 1))
                home = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("cid").take(pa.array(at)), pa.array([v.tobytes() for v in u], pa.binary()),
                     pa.array(np.full(len(u), dim, "i4")), pa.array(home.astype("i4")),
                     pa.array(d[np.arange(len(u)), home])],
                    ["cid", "u", "dim", "home", "d"])
    return run


def replicator(pivots, r: float):
    """Adds ``cells``: the lower-numbered cells that the vector may link into."""
    def run(batches):
        for b in batches:
            dims, homes = np.asarray(b.column("dim")), np.asarray(b.column("home"))
            cells: list = [[]] * b.num_rows
            raw = b.column("u").to_pylist()
            for dim in np.unique(dims):
                p = pivots.value.get(int(dim))
                if p is None:
                    continue
                at = np.flatnonzero(dims == dim)
                d = chords(np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), dim), p.points)
                own = d[np.arange(len(at)), homes[at]][:, None]
                between = chords(p.points, p.points)[homes[at]]
                ok = ((d <= p.radius + r + SLACK) & (d - own <= 2 * r + SLACK)
                      & (d * d - own * own <= 2 * between * r + SLACK)
                      & (np.arange(len(p.points)) < homes[at][:, None]))
                for i, row in zip(at, ok):
                    cells[i] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int32()))],
                                             [*b.schema.names, "cells"])
    return run


def join_block(threshold: float):
    """All links inside one block, or between its two halves.

    Returns (cid, links, root): the copies that the vector's class links to
    here, and the smallest class reachable within the block, which keeps the
    block's connections with one row a vector instead of one a pair.
    """
    def run(key, table):
        left, right, kind = (x.as_py() for x in key[2:5])
        cid, n = np.asarray(table["cid"]), np.asarray(table["n"])
        x = np.frombuffer(b"".join(table["u"].to_pylist())).reshape(len(cid), -1)
        side = np.asarray(table["side"])
        if kind == 0 and left == right:
            a = b = np.arange(len(cid))
        else:
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(a) or not len(b):
            return pa.table({"cid": cid[:0], "links": n[:0], "root": cid[:0]})
        near = np.empty((len(a), len(b)), bool)
        for s in range(0, len(a), 512):
            near[s:s + 512] = x[a[s:s + 512]] @ x[b].T >= threshold
        if a is b:
            np.fill_diagonal(near, False)
        links = np.zeros(len(cid), "i8")
        links[a] += near @ n[b]
        if a is not b:
            links[b] += n[a] @ near
        rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        near = near[np.ix_(rows, cols)]
        la, lb = a[rows], b[cols]
        root, far = cid.copy(), np.iinfo("i8").max
        while len(rows):
            old = root.copy()
            for s in range(0, len(rows), 512):
                part = near[s:s + 512]
                low = np.where(part, root[lb], far).min(axis=1)
                root[la[s:s + 512]] = np.minimum(root[la[s:s + 512]], low)
                back = np.where(part, root[la[s:s + 512]][:, None], far).min(axis=0)
                root[lb] = np.minimum(root[lb], back)
            if (old == root).all():
                break
        hit = links > 0
        return pa.table({"cid": cid[hit], "links": links[hit], "root": root[hit]})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, *, vec_id: str = "vec_id",
                    embedding: str = "embedding", rows_per_cell: int = 2_000, max_pivots: int = 1_024,
                    block: int = 2_048, sample_bytes: int = 32 << 20) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors that are null, empty, zero, or hold null or non-finite values
    link with nothing; vectors of different lengths never link. Rows with
    equal vectors are one class with a number of copies, so a third of all
    rows being copies costs one vector; they link with each other and count
    in ``n_links``. Repeated ids stay separate rows. A null id is a row
    whose component is the smallest non-null id reachable, if any. Extra
    columns are ignored; an empty table gives an empty result.

    Pivots (at most ``max_pivots``, at most 8 candidates each and
    ``sample_bytes`` of them on the driver) only steer the partitioning:
    the result is exact for any pivots. A cell of more than ``block``
    vectors is split by hash, and each pair of its blocks is a task of its
    own; no block's pairs are emitted, only counts and roots.
    """
    spark = vectors.sparkSession
    ship(spark)
    sc = spark.sparkContext
    scratch = Scratch(spark, "embed")
    r = float(np.sqrt(2 - 2 * threshold))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), doubles(embedding).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("vec", F.when(F.col("vec").isNotNull() & finite & some, F.col("vec")))
    classes = (rows.where("vec is not null").groupBy("vec")
               .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = scratch.keep(classes, "classes")

    pivots = {}
    for s in classes.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(64).collect():
        k = min(max_pivots, -(-s["n"] // rows_per_cell))
        most = max(1, min(8 * k, sample_bytes // 8 // s["dim"]))
        got = (classes.where(F.size("vec") == s["dim"]).select("vec", seeded(5, "cid").alias("h"))
               .orderBy("h").limit(most).select("vec").collect())
        points = unit(np.array([g["vec"] for g in got], float), s["dim"])
        pivots[s["dim"]] = Pivots(spread_pivots(points, k, 2 * r))
    told = sc.broadcast(pivots)
    homes = (classes.select("cid", "vec")
             .mapInArrow(assigner(told), "cid long, u binary, dim int, home int, d double"))
    homes = scratch.keep(homes, "homes")
    sizes = homes.groupBy("dim", "home").agg(F.max("d").alias("r"), F.count(F.lit(1)).alias("n")).collect()
    for dim, p in pivots.items():
        radius = np.full(len(p.points), -np.inf)
        for s in sizes:
            if s["dim"] == dim:
                radius[s["home"]] = s["r"]
        pivots[dim] = Pivots(p.points, radius)
    told = sc.broadcast(pivots)
    placed = homes.mapInArrow(replicator(told, r), "cid long, u binary, dim int, home int, d double, cells array<int>")
    placed = scratch.keep(placed.join(classes.select("cid", "n"), "cid"), "placed")
    scratch.drop("homes")
    guests = {(s["dim"], s["cell"]): s["n"] for s in
              placed.select("dim", F.explode("cells").alias("cell")).groupBy("dim", "cell")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = [(s["dim"], s["home"], -(-s["n"] // block), -(-guests.get((s["dim"], s["home"]), 0) // (4 * block)))
             for s in sizes]
    cells = scratch.keep(spark.createDataFrame(cells, "dim int, cell int, blocks int, guests int"), "cells")

    salt = seeded(7, "cid")
    mine = placed.withColumn("cell", F.col("home")).join(cells, ["dim", "cell"]).withColumn("b", (salt % F.col("blocks")).cast("int"))
    inner = mine.select("dim", "cell", "b", "cid", "n", "u", F.explode(F.expr("sequence(0, blocks - 1)")).alias("o")).select(
        "dim", "cell", F.least("b", "o").alias("l"), F.greatest("b", "o").alias("g"), F.lit(0).alias("kind"),
        F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "cid", "n", "u")
    hosts = mine.where("guests > 0").select("dim", "cell", F.col("b").alias("l"), F.explode(F.expr("sequence(0, guests - 1)")).alias("g"),
                                            F.lit(1).alias("kind"), F.lit(0).alias("side"), "cid", "n", "u")
    visiting = (placed.withColumn("cell", F.explode("cells")).join(cells, ["dim", "cell"])
                .select("dim", "cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("l"), (salt % F.col("guests")).cast("int").alias("g"),
                        F.lit(1).alias("kind"), F.lit(1).alias("side"), "cid", "n", "u"))
    found = (inner.union(hosts).union(visiting).groupBy("dim", "cell", "l", "g", "kind")
             .applyInArrow(join_block(threshold), "cid long, links long, root long"))
    found = scratch.keep(found, "found")
    scratch.drop("placed")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch)
    tied = (classes.select("cid", "n", "low", "vec").join(comps.withColumnRenamed("id", "cid"), "cid", "left")
            .withColumn("root", F.coalesce("root", "cid")))
    lows = tied.groupBy("root").agg(F.min("low").alias("component"))
    known = tied.join(lows, "root").join(links, "cid", "left").select(
        "vec", "component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return (rows.join(known, "vec", "left")
            .select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
                    F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
