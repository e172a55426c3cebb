"""Benchmark decontamination (DataFrame functions only).

Item-sized windows of a document are fingerprinted by SimHash and looked up
among the items' fingerprints by a multi-index: with RADIUS + 1 blocks, two
fingerprints at most RADIUS bits apart agree in one block at least, so the
equi-join on blocks misses none of them. The exact similarity of the
weighted shingles (weight: occurrences) then decides.

A window slid left by a word loses its last shingle only. If that is none of
an item's, the window is no better than the one slid, so the first of the
best windows ends in an item's shingle or starts the text. Of these windows,
those with as many places of items' shingles as the similarity needs are
fingerprinted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

WIDTH = 5  # words in a shingle
RADIUS = 19  # differing bits of 64: three standard deviations above what similarity 0.75 leads to
BROADCAST_ROWS = 500_000  # item shingles, or windows' places, of 28 bytes at most each, that are broadcast at most
LANES = 0x0000000100000001


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def hashed(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def shingles(ws: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` hashed words, in order."""
    return F.when(F.size(ws) >= width, F.transform(
        F.sequence(F.lit(0), F.size(ws) - width),
        lambda i: F.xxhash64(F.lit(width), *[F.get(ws, i + k) for k in range(width)])
    )).otherwise(F.array().cast("array<bigint>"))


def fingerprints(df: DataFrame, key: list[str], col: str) -> DataFrame:
    """SimHash of the shingles in array ``col``: (key..., fp). Each sum counts
    the ones at two of the 64 bit positions, in lanes of 32 bits."""
    s = F.col("_s")
    sums = [F.sum(F.shiftrightunsigned(s, b).bitwiseAND(F.lit(LANES))).alias(f"_c{b}") for b in range(32)]
    counted = df.select(*key, F.explode(col).alias("_s")).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *sums)

    def bit(b: int, lane: int) -> Column:
        ones = F.shiftrightunsigned(f"_c{b}", 32 * lane).bitwiseAND(F.lit(0xFFFFFFFF))
        value = 1 << (b + 32 * lane)
        return F.when(2 * ones > F.col("_n"), F.lit(value if value < 1 << 63 else value - (1 << 64)).cast("long")).otherwise(F.lit(0).cast("long"))

    fp = reduce(lambda x, y: x.bitwiseOR(y), [bit(b, lane) for lane in (0, 1) for b in range(32)])
    return counted.select(*key, fp.alias("fp"))


def blocks(fp: Column) -> Column:
    """The fingerprint's RADIUS + 1 blocks as (index, value)."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(*[F.struct(F.lit(i).alias("i"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << b - a) - 1)).alias("v"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def shared(a: Column, b: Column) -> Column:
    """Common weight of two bags of shingles."""
    def times(xs, x):
        return F.size(F.filter(xs, lambda y: y == x))

    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x)))


def by_width(width: Column, widths: list[int]) -> Column:
    """The window's shingles, of the width that its item's have."""
    out = None
    for k in widths:
        value = shingles(F.col("w"), k)
        out = F.when(width == k, value) if out is None else out.when(width == k, value)
    return out


def contaminated(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", percent: int = 75) -> DataFrame:
    """(doc_id, item_id, start, n_words, hamming, similarity, text_hash): each
    pair of a document and an item that it holds, at the best window.

    A window has as many words as the item (the whole text if that is
    shorter); items of fewer than five words are one shingle. Null and empty
    texts, and items without a word, match nothing; words are letters and
    digits in lower case, so case and punctuation don't matter. Repeated
    rows (equal id and text) give one result row, as do repeated items; of
    equally good windows the first counts. Extra columns are ignored; empty
    tables give an empty result.

    The documents' shingles meet the items' in a join that broadcasts these
    only if their measured number is at most ``BROADCAST_ROWS``, and else is
    a shuffle join. A text is read twice, and shuffled only to meet its
    windows' places, if these are more than that.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text"))
    known = (items.select(F.col(item_id).alias("item_id"), hashed(words(F.col(item_text).cast("string"))).alias("w"))
             .where(F.size("w") > 0).distinct())
    widths = [r[0] for r in known.select(F.least(F.size("w"), F.lit(WIDTH)).alias("k")).distinct().orderBy("k").collect()]
    schema = "doc_id long, item_id long, start int, n_words int, hamming int, similarity double, text_hash long"
    if not widths:
        return spark.createDataFrame([], schema)
    known = reduce(DataFrame.union, [
        known.where(F.least(F.size("w"), F.lit(WIDTH)) == k)
        .select("item_id", F.size("w").alias("n"), F.lit(k).alias("width"), shingles(F.col("w"), k).alias("sh")) for k in widths])
    known = scratch.keep(known.withColumn("no", F.monotonically_increasing_id()), "items")
    places = scratch.keep(known.select("n", "width", F.explode("sh").alias("s")).distinct(), "places")
    small = places.count() <= BROADCAST_ROWS

    hits = reduce(DataFrame.union, [
        texts.select("doc_id", "th", hashed(words(F.col("text"))).alias("w"))
        .select("doc_id", "th", F.size("w").alias("size"), F.posexplode(shingles(F.col("w"), k)).alias("pos", "s"))
        .join(F.broadcast(p) if small else p, "s")
        for k in widths for p in [places.where(F.col("width") == k).drop("width")]])
    reached = scratch.keep(hits.groupBy("doc_id", "th", "size", "n").agg(F.array_sort(F.collect_set("pos")).alias("at")), "reached")
    width = F.least(F.col("n"), F.lit(WIDTH))
    mine, whole = F.least("size", "n") - width + 1, F.col("n") - width + 1  # shingles of a window, of an item
    need = F.greatest(F.lit(1), F.ceil(percent * (mine + whole) / (100 + percent)).cast("int"))
    ends = F.when(F.size("at") >= need, F.filter(F.sequence(need - 1, F.size("at") - 1),
                                                 lambda j: F.get("at", j) - F.get("at", j - need + 1) < mine))
    starts = F.transform(ends, lambda j: F.greatest(F.lit(0), F.get("at", j) - mine + 1))
    spots = (reached.select("doc_id", "th", "n", F.explode(starts).alias("start"))
             .groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "n")).alias("spots")))
    spots = scratch.keep(spots, "spots")
    few = (spots.agg(F.sum(F.size("spots"))).first()[0] or 0) <= BROADCAST_ROWS

    key = ["doc_id", "th", "start", "n"]
    on = (F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))) & (F.col("a.th") == F.col("b.th"))
    cut = (texts.alias("a").join((F.broadcast(spots) if few else spots).alias("b"), on)
           .select("a.doc_id", "a.th", hashed(words(F.col("a.text"))).alias("w"), "b.spots")
           .select("doc_id", "th", F.explode(F.expr(
               "transform(spots, p -> named_struct('start', p.start, 'n', p.n, 'w', slice(w, p.start + 1, p.n)))")).alias("x"))
           .select("doc_id", "th", "x.start", "x.n", "x.w"))
    windows = cut.select(*key, by_width(width, widths).alias("sh")).where(F.size("sh") > 0).dropDuplicates(key)
    windows = scratch.keep(windows, "windows")

    theirs = fingerprints(known, ["no", "n"], "sh").select("no", "n", "fp", F.explode(blocks(F.col("fp"))).alias("b"))
    theirs = scratch.keep(theirs.select("no", "n", F.col("fp").alias("item_fp"), "b.i", "b.v"), "blocks")
    mine = (fingerprints(windows, key, "sh").withColumn("b", F.explode(blocks(F.col("fp"))))
            .select(*key, "fp", "b.i", "b.v"))
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = (mine.join(theirs, ["n", "i", "v"]).where(bits <= RADIUS)
            .select(*key, "no", bits.alias("hamming")).distinct())
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key])
    pairs = (near.alias("a").join(windows.alias("b"), same).select(*[F.col(f"a.{c}") for c in key], "no", "hamming", "sh")
             .join(known.select("no", "item_id", F.col("sh").alias("item_sh")), "no")
             .withColumn("common", shared(F.col("sh"), F.col("item_sh"))))
    whole = F.size("sh") + F.size("item_sh") - F.col("common")
    best = (pairs.withColumn("whole", whole).where(100 * F.col("common") >= percent * F.col("whole"))
            .select("doc_id", "th", "item_id", F.struct((F.col("common") / F.col("whole")).alias("similarity"), (-F.col("start")).alias("m"),
                                                  "n", (-F.col("hamming")).alias("h")).alias("x"))
            .groupBy("doc_id", "th", "item_id").agg(F.max("x").alias("x")))
    return best.select("doc_id", "item_id", (-F.col("x.m")).cast("int").alias("start"), F.col("x.n").alias("n_words"),
                       (-F.col("x.h")).cast("int").alias("hamming"), F.col("x.similarity").alias("similarity"),
                       F.col("th").alias("text_hash"))


def clean(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns pass through."""
    bad = contaminated(docs, items, doc_id=doc_id, text=text, **options).select(F.col("doc_id").alias("_bad"), "text_hash").distinct()
    bad = Scratch(docs.sparkSession, "decontam").keep(bad, "bad")
    mine = docs.withColumn("_h", F.xxhash64(F.col(text).cast("string")))
    return mine.join(bad, mine[doc_id].eqNullSafe(bad["_bad"]) & (mine["_h"] == bad["text_hash"]), "left_anti").select(docs.columns)
