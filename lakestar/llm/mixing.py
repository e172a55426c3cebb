"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows from the root of a domain-language-source tree to its
leaves in proportion to the weights. A child never gets more than it can
give (its tokens times the allowed epochs); what it lacks goes to its
siblings by their weights, and only what no sibling can take stays with the
ancestor. A leaf takes whole seeded epochs, then the token-prefix of the
next epoch's seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bucket_of, group_key, seeded_md5

BROADCAST_LEAVES = 100_000  # of a plan that is broadcast, some hundred bytes each; a larger one is joined by shuffle


def water_fill(budget: float, weights: list[float], caps: list[float]) -> list[float]:
    """Split ``budget`` by weight; capped children pass the rest to siblings."""
    got, open_ = [0.0] * len(caps), [i for i, w in enumerate(weights) if w > 0 and caps[i] > 0]
    left = min(budget, sum(caps[i] for i in open_))
    while open_ and left > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] >= caps[i] * total]
        for i in full or open_:
            got[i] = caps[i] if full else weights[i] * (left / total)
        left -= sum(got[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)] if full else []
    return got


def leaf_budgets(leaves: dict[tuple, float], budget: float, weights: dict[tuple, float],
                 epochs: int) -> dict[tuple, float]:
    """Tokens each leaf path gets. ``weights``: by path prefix, 1 if absent."""
    out: dict[tuple, float] = {}
    cap: dict[tuple, float] = {}
    children: dict[tuple, list] = {}
    for path, tokens in sorted(leaves.items()):
        for k in range(len(path) + 1):
            if path[:k] not in cap and k:
                children.setdefault(path[:k - 1], []).append(path[:k])
            cap[path[:k]] = cap.get(path[:k], 0.0) + tokens * epochs
    todo = [((), min(budget, cap.get((), 0.0)))]
    while todo:
        node, share = todo.pop()
        if node in leaves:
            out[node] = share
            continue
        kids = children.get(node, [])
        todo += zip(kids, water_fill(share, [weights.get(k, 1.0) for k in kids], [cap[k] for k in kids]))
    return out


def mix(docs: DataFrame, levels: dict[str, Column], *, tokens: Column, fraction: float,
        weights: dict[tuple, float] | None = None, epochs: int = 1, seed: int = 29, salt: Column | None = None,
        doc_id: str = "doc_id", rows_per_bucket: int = 20_000, max_leaves: int = 1_000_000) -> DataFrame:
    """Choose the rows of ``docs`` that make up the mixture.

    ``levels`` are the tree's levels from the root (name -> column),
    ``weights`` the target weight of a path of level values (1 if absent, 0
    leaves it out), ``fraction`` the budget as a share of all tokens times
    the allowed ``epochs``. Returns all columns of ``docs`` once for each
    epoch that a row is taken in, plus ``_epoch`` (from 0), ``_tokens`` and
    ``_budget`` (of its leaf).

    A leaf's seeded order is that of a hash of seed, epoch, id and ``salt``
    (which tells rows of one id apart; absent: a hash of all columns), then
    of id and all columns. In the last epoch a row is taken while the tokens before it in its
    leaf's seeded order are below what is left of the budget, so a leaf
    overshoots by less than one row. Null level values are leaves of their
    own; null token counts count 0, and a leaf without tokens gets nothing;
    of repeated rows, equal in all columns, as many are taken as the budget
    reaches to; extra columns
    pass through (names starting with ``_`` are reserved); an empty table
    gives an empty result.

    The leaf totals, one row a source, are the only thing the driver sees
    (more than ``max_leaves`` is an error). A hot leaf is never sorted
    whole: buckets of its hash order are summed, and only the bucket where
    the budget ends is sorted row by row. Texts are never shuffled: the end
    of each leaf's prefix is a place in its order, which the rows are
    compared with where they are read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    names = [f"_l{i}" for i in range(len(levels))]
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.withColumns({n: group_key(c) for n, c in zip(names, levels.values())}
                             | {"_tokens": F.coalesce(tokens.cast("long"), F.lit(0).cast("long")),
                                "_key": key, "_salt": key if salt is None else salt})
    light = scratch.keep(keyed.select(*names, "_tokens", F.col(doc_id).alias("_id"), "_key", "_salt"), "light")
    totals = light.groupBy(*names).agg(F.sum("_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    found = totals.limit(max_leaves + 1).collect()
    if len(found) > max_leaves:
        raise ValueError(f"more than {max_leaves} leaves")
    have = {tuple(r[n] for n in names): r["t"] for r in found}
    rows = {tuple(r[n] for n in names): r["n"] for r in found}
    coded = {tuple("n" if x is None else f"v{x}" for x in k): w for k, w in (weights or {}).items()}
    budgets = leaf_budgets({k: float(t) for k, t in have.items()},
                           fraction * sum(have.values()) * epochs, coded, epochs)
    plan = []
    for path, budget in budgets.items():
        full = min(epochs, int(budget // have[path])) if have[path] else 0
        rest = budget - full * have[path] if full < epochs else 0.0
        plan.append((*path, full, rest, -(-rows[path] // rows_per_bucket), budget))
    schema = ", ".join(f"{n} string" for n in names) + ", _full int, _rest double, _buckets long, _budget double"
    plan_df = scratch.keep(spark.createDataFrame(plan, schema), "plan")

    # Each epoch has an order of its own: its number goes into the hash.
    order = F.struct(seeded_md5(seed, "_full", "_id", "_salt").alias("h"), F.col("_id").alias("id"),
                     F.col("_key").alias("key"))
    part = (light.join(plan_df.where("_rest > 0"), names).withColumn("_at", order)
            .withColumn("_b", bucket_of(F.col("_at.h"), F.col("_buckets"))))
    sums = part.groupBy(*names, "_b").agg(F.sum("_tokens").alias("_t"), F.first("_rest").alias("_rest"))
    before = Window.partitionBy(*names).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    last = (sums.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0)))
            .where("_before < _rest and _before + _t >= _rest").select(*names, "_b", "_before"))
    run = Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    # Equal rows have one place: the last one taken and how many rows of it are.
    ends = (part.join(last, [*names, "_b"])
            .where("_rest > 0").withColumn("_sum", F.col("_before") + F.coalesce(F.sum("_tokens").over(run), F.lit(0)))
            .where("_sum < _rest").groupBy(*names, "_at").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(*names).agg(F.max(F.struct("_at", "_n")).alias("_x"))
            .select(*names, F.col("_x._at").alias("_end"), F.col("_x._n").alias("_take")))
    plan_df = scratch.keep(plan_df.join(ends, names, "left"), "ends")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    placed = (keyed.join(F.broadcast(plan_df) if len(plan) <= BROADCAST_LEAVES else plan_df, names)
              .withColumn("_id", F.col(doc_id)).withColumn("_place", order))
    chosen = (placed.withColumn("_epochs", F.col("_full") + F.when(F.col("_place") < F.col("_end"), 1).otherwise(0))
              .where("_epochs > 0").withColumn("_epoch", F.explode(F.expr("sequence(0, _epochs - 1)"))))
    # One of the equal rows at a leaf's last place stands for those of them that are taken.
    edge = (placed.where(F.col("_place") == F.col("_end")).dropDuplicates(names)
            .withColumn("_epoch", F.explode(F.expr("array_repeat(_full, cast(_take as int))"))))
    return chosen.select(*columns, "_epoch", "_tokens", "_budget").union(edge.select(*columns, "_epoch", "_tokens", "_budget"))
