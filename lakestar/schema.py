"""The declared warehouse contract: one module of StructTypes and keys.

Nothing downstream infers a type. Loads cast to these schemas (S8), the
contract checks (C1-C5) compare against them, and exports carry them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    DoubleType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's behaviour.
# ---------------------------------------------------------------------------

# Raw order-line columns, in file order.
RAW_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "unit_price",
    "invoice_date",
    "customer_id",
    "country",
)

# String columns that are whitespace-trimmed with empty -> null.
TRIMMED_COLUMNS = ("invoice_no", "stock_code", "description", "customer_id", "country")

# Tokens a CSV reader treats as missing (the pandas default set).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Quarantine reasons; the first one that matches a row wins. The last one is
# ours: a line whose revenue doesn't fit the warehouse's money type.
REASONS = (
    "missing_invoice_no",
    "missing_stock_code",
    "missing_or_bad_date",
    "missing_customer_id",
    "missing_unit_price",
    "missing_quantity",
    "non_positive_quantity",
    "duplicate_invoice_line",
    "amount_out_of_range",
)

# Grain used to detect duplicate invoice lines.
LINE_GRAIN = ("invoice_no", "stock_code", "invoice_date")

# First version of every SCD-2 customer opens at this date.
SCD_EPOCH = _dt.date(1900, 1, 1)

# Category of products missing from the category mapping.
DEFAULT_CATEGORY = "Uncategorised"

LOAD_MODES = ("replace", "append", "merge")

MONEY = DecimalType(12, 2)
REVENUE = DecimalType(14, 2)
RUN_REVENUE = DecimalType(16, 2)
SUM_MONEY = DecimalType(18, 2)

# ---------------------------------------------------------------------------
# Stage schemas
# ---------------------------------------------------------------------------

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

BRONZE_SCHEMA = StructType(
    [
        StructField("invoice_no", StringType(), True),
        StructField("stock_code", StringType(), True),
        StructField("description", StringType(), True),
        StructField("quantity", LongType(), True),
        StructField("unit_price", MONEY, True),
        StructField("invoice_date", TimestampNTZType(), True),
        StructField("customer_id", StringType(), True),
        StructField("country", StringType(), True),
    ]
)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: object
    nullable: bool = True
    max_length: int | None = None  # VARCHAR(n)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    natural_key: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c.name, c.dtype, c.nullable) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


DIM_PRODUCT = TableSpec(
    "dim_product",
    (
        ColumnSpec("product_key", LongType(), False),
        ColumnSpec("stock_code", StringType(), False, 32),
        ColumnSpec("description", StringType(), True, 256),
        ColumnSpec("category", StringType(), False, 64),
        ColumnSpec("unit_price", MONEY, False),
    ),
    primary_key=("product_key",),
    unique=(("stock_code",),),
    natural_key=("stock_code",),
)

DIM_CUSTOMER = TableSpec(
    "dim_customer",
    (
        ColumnSpec("customer_key", LongType(), False),
        ColumnSpec("customer_id", StringType(), False, 32),
        ColumnSpec("country", StringType(), False, 64),
        ColumnSpec("effective_from", DateType(), False),
        ColumnSpec("effective_to", DateType(), True),
        ColumnSpec("is_current", BooleanType(), False),
    ),
    primary_key=("customer_key",),
    unique=(("customer_id", "effective_from"),),
    natural_key=("customer_id", "effective_from"),
)

DIM_DATE = TableSpec(
    "dim_date",
    (
        ColumnSpec("date_key", IntegerType(), False),
        ColumnSpec("date", DateType(), False),
        ColumnSpec("year", IntegerType(), False),
        ColumnSpec("quarter", IntegerType(), False),
        ColumnSpec("month", IntegerType(), False),
        ColumnSpec("day", IntegerType(), False),
        ColumnSpec("weekday", StringType(), False, 16),
        ColumnSpec("is_weekend", BooleanType(), False),
    ),
    primary_key=("date_key",),
    natural_key=("date_key",),
)

FACT_SALES = TableSpec(
    "fact_sales",
    (
        ColumnSpec("sale_id", LongType(), False),
        ColumnSpec("product_key", LongType(), False),
        ColumnSpec("customer_key", LongType(), False),
        ColumnSpec("date_key", IntegerType(), False),
        ColumnSpec("invoice_no", StringType(), False, 32),
        ColumnSpec("quantity", LongType(), False),
        ColumnSpec("unit_price", MONEY, False),
        ColumnSpec("revenue", REVENUE, False),
    ),
    primary_key=("sale_id",),
    unique=(("invoice_no", "product_key", "date_key"),),
    foreign_keys={
        "product_key": ("dim_product", "product_key"),
        "customer_key": ("dim_customer", "customer_key"),
        "date_key": ("dim_date", "date_key"),
    },
    natural_key=("invoice_no", "product_key", "date_key"),
)

QUARANTINE = TableSpec(
    "quarantine",
    (
        ColumnSpec("invoice_no", StringType(), True, 32),
        ColumnSpec("stock_code", StringType(), True, 32),
        ColumnSpec("description", StringType(), True, 256),
        ColumnSpec("quantity", LongType(), True),
        ColumnSpec("unit_price", MONEY, True),
        ColumnSpec("invoice_date", DateType(), True),
        ColumnSpec("customer_id", StringType(), True, 32),
        ColumnSpec("country", StringType(), True, 64),
        ColumnSpec("quarantine_reason", StringType(), False, 64),
    ),
)

PIPELINE_RUNS = TableSpec(
    "pipeline_runs",
    (
        ColumnSpec("run_id", StringType(), False, 36),
        ColumnSpec("started_at", StringType(), False, 32),
        ColumnSpec("finished_at", StringType(), False, 32),
        ColumnSpec("load_mode", StringType(), False, 16),
        ColumnSpec("rows_extracted", LongType(), False),
        ColumnSpec("rows_loaded", LongType(), False),
        ColumnSpec("rows_quarantined", LongType(), False),
        ColumnSpec("total_revenue", RUN_REVENUE, False),
        ColumnSpec("git_sha", StringType(), False, 40),
    ),
    primary_key=("run_id",),
)

# Dimensions before the fact (FK-safe order).
STAR_TABLES = (DIM_PRODUCT, DIM_CUSTOMER, DIM_DATE, FACT_SALES)
ALL_TABLES = STAR_TABLES + (QUARANTINE, PIPELINE_RUNS)
TABLES = {t.name: t for t in ALL_TABLES}

CHECK_RESULT_SCHEMA = StructType(
    [
        StructField("position", IntegerType(), False),
        StructField("name", StringType(), False),
        StructField("passed", BooleanType(), False),
        StructField("severity", StringType(), False),
        StructField("observed", DoubleType(), True),
        StructField("threshold", DoubleType(), True),
        StructField("detail", StringType(), True),
    ]
)


def table(name: str) -> TableSpec:
    """Declared spec for ``name``; raises KeyError for unknown tables."""
    return TABLES[name]
