"""Bronze stage: raw text -> typed order lines, keeping every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import na_to_null, to_iso_timestamp, to_money, to_whole_number, trim_to_null
from ..schema import RAW_COLUMNS, TRIMMED_COLUMNS

PASSTHROUGH = ("_ord", "_corrupt_record")


def with_na_tokens(raw: DataFrame) -> DataFrame:
    """Missing-value tokens -> null on the 8 raw columns (no trimming yet)."""
    extra = [c for c in PASSTHROUGH if c in raw.columns]
    return raw.select(*[na_to_null(F.col(c)).alias(c) for c in RAW_COLUMNS], *extra)


def to_bronze(raw: DataFrame) -> DataFrame:
    """Typed bronze frame; one narrow projection, no row is dropped.

    invoice_no, stock_code, description, customer_id, country: trimmed
    text, empty -> null; quantity: bigint; unit_price: decimal(12,2);
    invoice_date: timestamp_ntz. Malformed values become null and are
    reported by the data-quality checks and quarantine reasons.
    """
    nulled = with_na_tokens(raw)
    cols = []
    for c in RAW_COLUMNS:
        col = F.col(c)
        if c in TRIMMED_COLUMNS:
            col = trim_to_null(col)
        elif c == "quantity":
            col = to_whole_number(col)
        elif c == "unit_price":
            col = to_money(col)
        elif c == "invoice_date":
            col = to_iso_timestamp(col)
        cols.append(col.alias(c))
    extra = [c for c in PASSTHROUGH if c in nulled.columns]
    return nulled.select(*cols, *extra)
