"""Order lines and the category mapping derived from the given parquet tables.

The test tables are a TPC-H-like star; these functions turn them into what
the engine ingests in production: untyped order-line text plus an ingest
ordinal (``_ord``) that stands for file order. The dirt (blank customer or
price, bad quantity or date, padded stock codes) is seeded by a fixed hash
of each line, so every scale factor carries the same kinds of defects.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS

# How a line's hash picks its defect (hash = (orderkey*31 +
# partkey*17 + linenumber) % 1000).
#   0 -> blank customer_id       1 -> blank unit_price
#   2 -> quantity "-3"           3 -> invoice_date "not-a-date"
#   4 -> quantity "x"            5 -> stock_code padded with spaces
# Category mapping leaves out parts whose key is a multiple of 50, so those
# products fall back to the default category.
DIRT_MODULUS = 1000
CATEGORY_GAP_MODULUS = 50
MOVED_COUNTRY = "NATION_MOVED"
MOVED_CUSTOMER_MODULUS = 100


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer partitions than the cluster has
    cores (a small file with few row groups); large inputs already split
    into many partitions and pass through without a shuffle."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def _text(c: Column) -> Column:
    return c.cast("string")


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines as raw text: 8 string columns + ``_ord`` (ingest order).

    Joins lineitem -> (orders -> customer) -> part -> nation. ``nation`` has a
    fixed 25 rows, so it is broadcast; the other joins are left to the
    planner (broadcast by size statistics when small, sort-merge otherwise).
    Orders meet their customers before the lines do, and products come last,
    so the lines are shuffled twice at most and without any text.
    """
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    placed = orders.join(customer, F.col("c_custkey") == F.col("o_custkey")).drop("c_custkey")
    joined = (
        li.join(placed, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(part, F.col("p_partkey") == F.col("l_partkey"))
        .join(F.broadcast(nation), F.col("n_nationkey") == F.col("c_nationkey"))
    )
    h = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber")) % DIRT_MODULUS
    partkey = _text(F.col("l_partkey"))
    price = (F.col("p_retailprice") + (F.col("l_suppkey") % 5)).cast("decimal(12,2)")
    cols = {
        "invoice_no": F.concat(F.lit("INV"), _text(F.col("l_orderkey"))),
        "stock_code": F.when(h == 5, F.concat(F.lit("  SKU-"), partkey, F.lit(" ")))
        .otherwise(F.concat(F.lit("SKU-"), partkey)),
        "description": F.col("p_name"),
        "quantity": F.when(h == 2, F.lit("-3")).when(h == 4, F.lit("x"))
        .otherwise(_text(F.col("l_quantity").cast("int"))),
        "unit_price": F.when(h == 1, F.lit("")).otherwise(_text(price)),
        "invoice_date": F.when(h == 3, F.lit("not-a-date"))
        .otherwise(_text(F.to_date(F.col("o_orderdate")))),
        "customer_id": F.when(h == 0, F.lit("")).otherwise(F.concat(F.lit("C-"), _text(F.col("o_custkey")))),
        "country": F.col("n_name"),
    }
    ordinal = F.struct(
        F.col("l_orderkey").alias("o1"),
        F.col("l_partkey").alias("o2"),
        F.col("l_shipdate").alias("o3"),
        F.col("l_linenumber").alias("o4"),
        F.col("l_suppkey").alias("o5"),
    )
    return joined.select(*[cols[c].alias(c) for c in RAW_COLUMNS], ordinal.alias("_ord"))


def category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sourced (stock_code, category) mapping; some products are missing."""
    part = read_table(spark, sf_dir, "part")
    return part.where(F.col("p_partkey") % CATEGORY_GAP_MODULUS != 0).select(
        F.concat(F.lit("SKU-"), _text(F.col("p_partkey"))).alias("stock_code"),
        F.col("p_type").alias("category"),
    )


def split_batches(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two overlapping incremental batches of bronze lines, dirt included.

    Batch 1: lines before 2000-01-01 and those without a date. Batch 2:
    lines from 1999-07-01 (half a year overlaps), where every customer whose
    number is a multiple of 100 has moved to another country.
    """
    day = F.to_date("invoice_date")
    batch1 = bronze.where(day.isNull() | (day < F.lit("2000-01-01").cast("date")))
    number = F.regexp_extract("customer_id", r"(\d+)$", 1).try_cast("bigint")
    batch2 = bronze.where(day >= F.lit("1999-07-01").cast("date")).withColumn(
        "country",
        F.when(number % MOVED_CUSTOMER_MODULUS == 0, F.lit(MOVED_COUNTRY)).otherwise(F.col("country")),
    )
    return batch1, batch2
