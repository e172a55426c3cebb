"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are shuffled by a seeded hash within their source, ranked there, and
ordered by fractional rank (rank - 1/2) / rows of the source. That order
interleaves the sources in proportion, so any contiguous cut holds the
mixture; equal cuts make shards whose row counts are at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bucket_of, exact_rank, group_key, seeded_md5


def shard(docs: DataFrame, shards: int, *, seed: int = 17, doc_id: str = "doc_id", text: str = "text",
          stratum: str = "source", rows_per_bucket: int = 20_000) -> DataFrame:
    """Put every row of ``docs`` into one of ``shards`` shards (law ``rows``).

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``:
    size is the text's UTF-8 bytes (null: none) plus 16, slot counts from 0
    without gaps in each shard, grown_shard is null (only the law ``key``
    has it). Null texts have the checksum of the empty text; a null source
    is a source of its own; repeated rows (equal id and text) each get a
    place; extra columns are ignored; an empty table gives an empty result;
    with fewer rows than shards some shards stay empty.

    A hot source is ranked bucket by bucket (``rows_per_bucket`` rows on
    average), so no source meets in one task. Only ids, sizes and checksums
    are shuffled, never texts.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shard")
    body: Column = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        group_key(F.col(stratum)).alias("_s"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    ).withColumn("_h", seeded_md5(seed, "doc_id", "text_crc32", "size"))
    rows = scratch.keep(rows, "rows")
    strata = scratch.keep(rows.groupBy("_s").agg(F.count(F.lit(1)).alias("_n")), "strata")
    total = strata.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    if total == 0:
        return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))

    buckets = F.ceil(F.col("_n") / rows_per_bucket)
    ranked = exact_rank(
        rows.join(strata, "_s").withColumn("_b", bucket_of(F.col("_h"), buckets)),
        ["_s"], "_b", ["_h", "doc_id", "text_crc32", "size"], "_rank")
    bands = -(-total // rows_per_bucket)
    placed = (ranked.withColumn("_f", (F.col("_rank") + 0.5) / F.col("_n"))
              .withColumn("_band", F.floor(F.col("_f") * bands)).withColumn("_all", F.lit(0)))
    order = ["_f", "_s", "_h", "doc_id", "text_crc32", "size"]
    placed = exact_rank(placed, ["_all"], "_band", order, "_pos")
    placed = placed.withColumn("shard", F.expr(f"_pos * {shards}L div {total}L").cast("int"))
    first = F.expr(f"(cast(shard as long) * {total}L + {shards - 1}L) div {shards}L")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         (F.col("_pos") - first).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
