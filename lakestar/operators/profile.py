"""Column profile: nulls, distinct values, numeric range per column.

Unpivot to (column, value) -> aggregate per (column, value) with map-side
combine -> aggregate per column. Each stage pre-aggregates before its
shuffle, so a column with one dominant value costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import to_number


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: position, column, nulls, distinct_values, min, max.

    A value is missing when null or empty text. ``min``/``max`` are given
    only when every present value parses as a number.
    """
    cols = list(columns or df.columns)
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.col(c).cast("string").alias("value"))
        for i, c in enumerate(cols, 1)
    ])
    long = df.select(F.inline(cells)).withColumn(
        "value", F.when(F.col("value") != "", F.col("value")))
    per_value = long.groupBy("position", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    number = to_number(F.col("value"))
    per_col = per_value.groupBy("position", "column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("nulls"),
        F.count("value").cast("bigint").alias("distinct_values"),
        F.count_if(F.col("value").isNotNull() & number.isNull()).alias("_non_numeric"),
        F.min(number).alias("_min"),
        F.max(number).alias("_max"),
    )
    numeric = (F.col("_non_numeric") == 0) & (F.col("distinct_values") > 0)
    return per_col.select(
        F.col("position").cast("int").alias("position"),
        "column",
        "nulls",
        "distinct_values",
        F.when(numeric, F.col("_min")).alias("min"),
        F.when(numeric, F.col("_max")).alias("max"),
    )
