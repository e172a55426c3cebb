"""Quarantine classification: first matching reason, duplicate lines.

Duplicates are found without a window over the line grain (a hot grain
value would land in one task): a hash aggregate counts rows per hash of the
grain with map-side combine; only the (usually few) grains with more than
one row are counted exactly and joined back, broadcast when their measured
count allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import amount_out_of_range
from ..schema import LINE_GRAIN, REASONS
from .cache import hold
from .joins import maybe_broadcast, null_safe_on

REASON = "quarantine_reason"
IS_DUP = "_is_dup"


def duplicate_groups(bronze: DataFrame, grain=LINE_GRAIN, ord_col: str = "_ord") -> tuple[DataFrame, int]:
    """Grains holding more than one line, with their line counts ``_n`` and
    their first line's ordinal ``_first_ord`` (if the lines have ordinals;
    persisted; usually tiny), and how many there are.

    All lines are counted by a 64-bit hash of their grain, with map-side
    combine: a grain repeated on a third of all lines is pre-counted inside
    every task before the shuffle. Only lines whose hash comes twice are
    counted by the grain itself. The same groups answer the suite's
    uniqueness check (sum of ``_n - 1``).
    """
    grain = list(grain)
    code = F.xxhash64(*grain)
    twice = hold(bronze.groupBy(code.alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_n") > 1).select("_code"))
    twice = maybe_broadcast(twice, twice.count())
    counted = [F.count(F.lit(1)).alias("_n")]
    if ord_col in bronze.columns:
        # partial aggregation keeps even a huge group to one row per task
        counted.append(F.min(ord_col).alias("_first_ord"))
    groups = hold(
        bronze.join(twice, code == F.col("_code"), "left_semi").groupBy(*grain)
        .agg(*counted)
        .where(F.col("_n") > 1)
        .withColumnsRenamed({c: f"_g_{c}" for c in grain})
    )
    return groups, groups.count()


def duplicate_flags(bronze: DataFrame, grain=LINE_GRAIN, ord_col: str = "_ord",
                    groups: tuple[DataFrame, int] | None = None) -> DataFrame:
    """``bronze`` + ``_is_dup``: true for every line of a grain but the first.

    Null grain values compare equal (null-safe). "First" is the smallest
    ingest ordinal, computed over *all* lines, before any rejection.
    ``groups`` reuses a ``duplicate_groups`` result.
    """
    grain = list(grain)
    dup_keys, n_dup_keys = groups if groups is not None else duplicate_groups(bronze, grain, ord_col)
    if n_dup_keys == 0:
        return bronze.withColumn(IS_DUP, F.lit(False))
    gcols = [f"_g_{c}" for c in grain]
    firsts = maybe_broadcast(dup_keys.select(*gcols, "_first_ord"), n_dup_keys)
    flagged = bronze.join(firsts, null_safe_on(bronze, firsts, grain, gcols), "left")
    is_dup = F.col("_first_ord").isNotNull() & (F.col(ord_col) != F.col("_first_ord"))
    return flagged.select(*bronze.columns, is_dup.alias(IS_DUP))


def reason_expr(is_dup: Column) -> Column:
    """The first matching quarantine reason, in the fixed order; null = valid."""
    tests = {
        "missing_invoice_no": F.col("invoice_no").isNull(),
        "missing_stock_code": F.col("stock_code").isNull(),
        "missing_or_bad_date": F.col("invoice_date").isNull(),
        "missing_customer_id": F.col("customer_id").isNull(),
        "missing_unit_price": F.col("unit_price").isNull(),
        "missing_quantity": F.col("quantity").isNull(),
        "non_positive_quantity": F.coalesce(F.col("quantity"), F.lit(0)) <= 0,
        "duplicate_invoice_line": is_dup,
        "amount_out_of_range": amount_out_of_range(F.col("quantity"), F.col("unit_price")),
    }
    expr = None
    for reason in REASONS:
        expr = (F.when(tests[reason], F.lit(reason)) if expr is None
                else expr.when(tests[reason], F.lit(reason)))
    return expr


def classify(bronze: DataFrame, groups: tuple[DataFrame, int] | None = None) -> DataFrame:
    """``bronze`` + ``quarantine_reason`` (null for valid rows)."""
    flagged = duplicate_flags(bronze, groups=groups)
    return flagged.withColumn(REASON, reason_expr(F.col(IS_DUP))).drop(IS_DUP)


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNull()).drop(REASON)


def quarantine_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNotNull())
