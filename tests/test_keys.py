from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestar.operators.keys import dense_number


def _check(spark, df, order):
    got = dense_number(df, order, "n", start=11)
    expect = df.withColumn("e", F.row_number().over(Window.orderBy(*order)) + 10)
    joined = got.df.join(expect, list(df.columns))
    assert got.rows == df.count()
    assert joined.where(F.col("n") != F.col("e")).count() == 0
    assert joined.count() == df.count()


def test_two_pass_numbering_equals_global_window(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"), F.col("id"))
    _check(spark, df, ["k", "id"])


def test_small_frames(spark):
    df = spark.range(0, 50).select((F.col("id") * 3 % 17).alias("k"), F.col("id"))
    _check(spark, df, ["k", "id"])


def test_numbering_by_struct_ordinal(spark):
    df = spark.range(0, 2000).select(F.struct((F.col("id") % 7).alias("a"), F.col("id").alias("b")).alias("o"))
    _check(spark, df, ["o"])


def test_empty_frame(spark):
    df = spark.range(0).select(F.col("id").alias("k"))
    got = dense_number(df, ["k"], "n")
    assert got.rows == 0 and got.df.count() == 0


def test_null_structs_and_null_fields_keep_their_order(spark):
    rows = [(0, (None, 2)), (1, None), (2, (1, None)), (3, (None, None)), (4, (1, 1)), (5, (0, 9))]
    df = spark.createDataFrame(rows, "id int, o struct<a:int,b:int>")
    got = dense_number(df, ["o"], "n").df.collect()
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == [1, 3, 0, 5, 2, 4]


def test_numbers_join_without_a_shuffle(spark):
    """The offsets' size is unknown to the planner; numbered rows must not be shuffled by partition."""
    got = dense_number(spark.range(0, 1000).select(F.col("id").alias("k")), ["k"], "n")
    plan = got.df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
