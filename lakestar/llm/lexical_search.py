"""Ranked lexical search of all documents for each item of a query set.

Bag deduplication: a document counts for a query only through the terms it
shares with the items and through its length class m. Documents are
restricted to the items' vocabulary, those with the same term frequencies
and m form a class (found by a hash, told apart by the whole vector), each
class is scored once, and the winning classes are expanded to their members
in ascending order of doc_id.

An item's first k documents are in its first k classes, by score and then by
a class's least doc_id: a class before another one has a member before all
of the other's. So a task keeps k classes an item, and a class k members.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship
from .grams import runs

#: Bytes outside terms become spaces, A-Z become a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
LAST_ID = (1 << 63) - 1  # a null doc_id's place in the order
PAIRS = 4_000_000  # scores that a task computes at a time
LEAST = 64  # terms that an item takes up in a block at least, so a block's items are bounded, too


def terms(raw: bytes | None) -> Iterator[list[bytes]]:
    """The text's terms, a run at a time."""
    for run in runs(raw or b"", GAP):
        yield run.translate(FOLD).split()


# -- the query set --------------------------------------------------------------

class Block:
    """Items of the query set with their vocabulary and postings (item numbers by term)."""

    def __init__(self, items: list[tuple], bags: list[set]):
        self.items = items
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*bags)))}
        pairs = sorted((self.vocabulary[t], q) for q, bag in enumerate(bags) for t in bag)
        self.starts = np.searchsorted([p[0] for p in pairs], np.arange(len(self.vocabulary) + 1))
        self.postings = np.array([p[1] for p in pairs], np.int64)


def blocks(items: DataFrame, item_id: str, text: str, terms_per_block: int) -> Iterator[Block]:
    """The different items that have a term, in blocks of a bounded vocabulary; the driver holds one."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").cast("binary").alias("text")).distinct()
    found, bags, size = [], [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        bag = {t for run in terms(r["text"]) for t in run}
        if not bag:
            continue
        if found and size + max(len(bag), LEAST) > terms_per_block:
            yield Block(found, bags)
            found, bags, size = [], [], 0
        found.append(r["item_id"])
        bags.append(bag)
        size += max(len(bag), LEAST)
    if found:
        yield Block(found, bags)


# -- documents as bags of the vocabulary ------------------------------------------

def bag_maker(vocabulary):
    """(doc_id, n, terms, tfs) of every document that has a term."""
    def run(batches):
        known = vocabulary.value
        for b in batches:
            ids, sizes, places, counts = [], [], [], []
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("text")):
                bag, n = Counter(), 0
                for words in terms(raw.as_py()):
                    n += len(words)
                    bag.update(words)
                if n:
                    mine = sorted((known[t], k) for t, k in bag.items() if t in known)
                    ids.append(doc_id)
                    sizes.append(n)
                    places.append([t for t, _ in mine])
                    counts.append([k for _, k in mine])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                                              pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                                             ["doc_id", "n", "terms", "tfs"])
    return run


# -- scores of classes --------------------------------------------------------------

def flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all elements, number of elements of each row) of a list column."""
    return (column.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.diff(column.offsets.to_numpy(zero_copy_only=False)))


def best(items, scores, firsts, classes, k: int):
    """Each item's first k classes by score, then by their least doc_id."""
    order = np.lexsort((classes, firsts, -scores, items))
    items = items[order]
    start = np.flatnonzero(np.r_[True, items[1:] != items[:-1]])
    place = np.arange(len(items)) - np.repeat(start, np.diff(np.r_[start, len(items)]))
    keep = order[place < k]
    return keep


def class_scorer(shared, k: int):
    """A task's k first classes of each item: (item, score, first, cls)."""
    def run(batches):
        starts, postings, weights, n_items = shared.value
        length = np.diff(starts)
        held = [np.zeros(0, np.int64) for _ in range(4)]
        floor = np.zeros(n_items, np.int64)  # the least score that can still be among the first k
        rows_at_once = max(1, PAIRS // max(1, n_items))
        for b in batches:
            for i in range(0, b.num_rows, rows_at_once):
                part = b.slice(i, rows_at_once)
                t, sizes = flat(part.column("terms"))
                tf, _ = flat(part.column("tfs"))
                m = np.repeat(part.column("m").to_numpy(), sizes)
                worth = weights[t] * ((1_000_000_000 * tf) // (1_000 * tf + 20 * m))
                row = np.repeat(np.arange(part.num_rows), sizes)
                totals = np.zeros(part.num_rows * n_items, np.int64)
                # Postings of all terms, a bounded number of pairs at a time.
                edges = np.cumsum(length[t])
                at = 0
                while at < len(t):
                    end = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + PAIRS, "right")))
                    many = length[t[at:end]]
                    place = np.repeat(starts[t[at:end]] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
                    np.add.at(totals, np.repeat(row[at:end], many) * n_items + postings[place], np.repeat(worth[at:end], many))
                    at = end
                hit = np.flatnonzero((totals > 0) & (totals >= np.tile(floor, part.num_rows)))
                new = (hit % n_items, totals[hit], part.column("first").to_numpy()[hit // n_items], part.column("cls").to_numpy()[hit // n_items])
                held = [np.concatenate(x) for x in zip(held, new)]
                if len(held[0]) > 4 * k * n_items:
                    held = [x[best(*held, k)] for x in held]
                    floor = floors(held, n_items, k)
        if len(held[0]):
            keep = best(*held, k)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep], t) for x, t in zip(held, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                             ["item", "score", "first", "cls"])
    return run


def floors(held, n_items: int, k: int) -> np.ndarray:
    """Each item's k-th score, 0 if it has fewer classes (``held`` is in order)."""
    items, scores = held[0], held[1]
    out = np.zeros(n_items, np.int64)
    ends = np.searchsorted(items, np.arange(n_items), "right")
    full = np.bincount(items, minlength=n_items) >= k
    out[full] = scores[ends[full] - 1]
    return out


def search(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = 50, terms_per_block: int = 200_000) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above 0.

    Equal scores rank by ascending doc_id, null ids last. Every row of
    ``docs`` is a document, repeated ones, too (rows with equal ids and
    texts follow each other); null and empty texts have no term and don't
    count for the statistics. Repeated items count once, items without a
    term have no rows; different texts of one item id are ranked each.
    Extra columns are ignored; empty tables give an empty result.

    The items come in blocks of at most ``terms_per_block`` terms (an item
    with more is a block of its own), which bounds what is broadcast: a
    block's vocabulary and postings, and its winning classes' hashes.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "search")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    item_type = items.schema[item_id].dataType.simpleString()
    out = None
    for no, block in enumerate(blocks(items, item_id, item_text, terms_per_block)):
        found = search_block(texts, block, scratch, f"{no}-{uuid.uuid4().hex[:8]}", top, item_type)
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    return out


def search_block(texts: DataFrame, block: Block, scratch: Scratch, name: str, top: int, item_type: str) -> DataFrame:
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    bags = scratch.keep(texts.mapInArrow(bag_maker(share(block.vocabulary)), "doc_id long, n long, terms array<int>, tfs array<int>"), f"bags{name}")
    size = bags.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    total, length = size["docs"], size["terms"] or 1
    m = F.expr(f"cast(50 + (cast(50 * n as decimal(38, 0)) * {total}) div {length} as bigint)")
    bags = (bags.where(F.size("terms") > 0).withColumn("m", m).withColumn("h", F.xxhash64("m", "terms", "tfs"))
            .withColumn("place", F.coalesce("doc_id", F.lit(LAST_ID))))
    same = ["h", "m", "terms", "tfs"]
    classes = bags.groupBy(*same).agg(F.count(F.lit(1)).alias("members"), F.min("place").alias("first"))
    classes = scratch.keep(classes.withColumn("cls", F.monotonically_increasing_id()), f"classes{name}")

    # One row a term of the block's vocabulary.
    df = np.zeros(len(block.vocabulary), np.int64)
    for r in classes.select(F.explode("terms").alias("t"), "members").groupBy("t").agg(F.sum("members").alias("df")).collect():
        df[r["t"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    postings = share((block.starts, block.postings, weights, len(block.items)))
    scored = classes.select("cls", "first", "m", "terms", "tfs").mapInArrow(
        class_scorer(postings, top), "item int, score long, first long, cls long")
    by_rank = Window.partitionBy("item").orderBy(F.desc("score"), "first", "cls")
    winners = scored.withColumn("r", F.row_number().over(by_rank)).where(F.col("r") <= top).drop("r", "first")
    winners = scratch.keep(winners, f"winners{name}")  # at most ``top`` rows an item

    # Expansion: the winners' first members, found by the hash, told apart by the whole vector.
    won = classes.join(F.broadcast(winners.select("cls").distinct()), "cls", "left_semi").select(*same, "cls")
    near = bags.join(F.broadcast(won.select("h").distinct()), "h", "left_semi")
    in_order = Window.partitionBy(*same).orderBy("place")
    members = near.withColumn("r", F.row_number().over(in_order)).where(F.col("r") <= top).drop("r")
    members = members.join(won, same).select("cls", "doc_id", "place")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), "place")
    ranked = (winners.join(members, "cls").withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top))
    ids = spark.createDataFrame(list(enumerate(block.items)), f"item int, item_id {item_type}")
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
