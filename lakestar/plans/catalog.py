"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the given tables (or data Spark derives from them) over
whole tables. Building the star is shared: within one Spark application
and data directory the classified lines and the star are built once
(checkpointed) and reused by the queries that read them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..operators import serving
from ..operators.bronze import to_bronze, with_na_tokens
from ..operators.classify import REASON, duplicate_flags, valid_rows
from ..operators.classify import classify
from ..operators.star import StarSchema, build_star_from_classified, stage_bronze
from ..schema import RAW_COLUMNS
from ..session import apply_defaults
from ..sources.tables import category_map, raw_order_lines

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# Shared, memoised builds
# ---------------------------------------------------------------------------

_CACHE: dict[tuple, object] = {}


def _memo(spark: SparkSession, sf_dir: str, what: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def bronze_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return to_bronze(raw_order_lines(spark, sf_dir))


def staged_bronze_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "staged_bronze", lambda: stage_bronze(bronze_for(spark, sf_dir)))


def classified_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "classified",
                 lambda: classify(staged_bronze_for(spark, sf_dir)))


def star_for(spark: SparkSession, sf_dir: str) -> StarSchema:
    return _memo(spark, sf_dir, "star", lambda: build_star_from_classified(
        classified_for(spark, sf_dir), category_map(spark, sf_dir)))


BRONZE_COLS = ", ".join(RAW_COLUMNS)


# ---------------------------------------------------------------------------
# Sources, bronze, classification
# ---------------------------------------------------------------------------

@register("bronze_na_tokens", O.on_bronze(f"SELECT {BRONZE_COLS} FROM na"))
def q_bronze_na_tokens(spark, sf_dir):
    apply_defaults(spark)
    return with_na_tokens(raw_order_lines(spark, sf_dir)).select(*RAW_COLUMNS)


@register("bronze_orders", O.on_bronze(f"SELECT {BRONZE_COLS} FROM bronze"))
def q_bronze_orders(spark, sf_dir):
    return bronze_for(spark, sf_dir).select(*RAW_COLUMNS)


@register("classify_rows", O.on_classified(f"SELECT {BRONZE_COLS}, quarantine_reason FROM classified"))
def q_classify_rows(spark, sf_dir):
    return classified_for(spark, sf_dir).select(*RAW_COLUMNS, REASON)


@register("duplicate_lines", O.on_bronze(
    f"SELECT {BRONZE_COLS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY invoice_no, stock_code, "
    f"invoice_date ORDER BY {O.ORD}) AS rn FROM bronze) WHERE rn > 1"))
def q_duplicate_lines(spark, sf_dir):
    flagged = duplicate_flags(bronze_for(spark, sf_dir))
    return flagged.where(F.col("_is_dup")).select(*RAW_COLUMNS)


@register("valid_rows", O.on_classified(f"SELECT {BRONZE_COLS} FROM valid"))
def q_valid_rows(spark, sf_dir):
    return valid_rows(classified_for(spark, sf_dir)).select(*RAW_COLUMNS)


@register("quarantine_rows", O.on_classified("SELECT * FROM quarantine"))
def q_quarantine_rows(spark, sf_dir):
    return star_for(spark, sf_dir).quarantine


# ---------------------------------------------------------------------------
# Star tables
# ---------------------------------------------------------------------------

@register("dim_product", O.on_star("SELECT * FROM dim_product"))
def q_dim_product(spark, sf_dir):
    return star_for(spark, sf_dir).dim_product


@register("dim_customer", O.on_star("SELECT * FROM dim_customer"))
def q_dim_customer(spark, sf_dir):
    return star_for(spark, sf_dir).dim_customer


@register("dim_date", O.on_star("SELECT * FROM dim_date"))
def q_dim_date(spark, sf_dir):
    return star_for(spark, sf_dir).dim_date


@register("fact_sales", O.on_star("SELECT * FROM fact_sales"))
def q_fact_sales(spark, sf_dir):
    return star_for(spark, sf_dir).fact_sales


# ---------------------------------------------------------------------------
# Serving queries
# ---------------------------------------------------------------------------

def _serving(name: str, sql: str, fn):
    register(name, O.on_star(sql))(lambda spark, sf_dir: fn(star_for(spark, sf_dir)))


_serving("revenue_by_category", """
SELECT p.category, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS revenue
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.category ORDER BY revenue DESC, p.category""", serving.revenue_by_category)

_serving("report_by_category", """
SELECT p.category, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS revenue
FROM fact_sales f LEFT JOIN dim_product p ON f.product_key = p.product_key
WHERE p.category IS NOT NULL
GROUP BY p.category ORDER BY revenue DESC, p.category""", serving.report_by_category)

_serving("top_products", """
SELECT p.stock_code, p.description, CAST(SUM(f.quantity) AS BIGINT) AS units
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.stock_code, p.description
ORDER BY units DESC, p.stock_code LIMIT 5""", serving.top_products)

_serving("revenue_by_country", """
SELECT c.country, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS revenue
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
WHERE c.is_current
GROUP BY c.country ORDER BY revenue DESC, c.country""", serving.revenue_by_country)

_serving("monthly_revenue", """
SELECT d.year, d.month, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS revenue
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.year, d.month ORDER BY d.year, d.month""", serving.monthly_revenue)

_serving("weekend_revenue", """
SELECT d.is_weekend, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS revenue
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.is_weekend ORDER BY d.is_weekend""", serving.weekend_revenue)

_serving("quarantine_reasons", """
SELECT quarantine_reason, CAST(COUNT(*) AS BIGINT) AS rows
FROM quarantine GROUP BY quarantine_reason ORDER BY rows DESC, quarantine_reason""",
         serving.quarantine_reasons)

_serving("daily_revenue", """
SELECT d.date, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS revenue
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.date ORDER BY d.date""", serving.daily_revenue)

_serving("daily_revenue_from_key", """
SELECT make_date(CAST(date_key // 10000 AS INTEGER), CAST((date_key // 100) % 100 AS INTEGER),
                 CAST(date_key % 100 AS INTEGER)) AS date,
       CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue
FROM fact_sales GROUP BY date_key ORDER BY date""", serving.daily_revenue_from_key)

_serving("total_revenue", """
SELECT CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(18,2)) AS revenue FROM fact_sales""",
         serving.total_revenue)

_serving("kpis", """
SELECT (SELECT CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(18,2)) FROM fact_sales) AS total_revenue,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM fact_sales) AS orders,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM quarantine) AS quarantined,
       (SELECT CAST(COUNT(DISTINCT stock_code) AS BIGINT) FROM dim_product) AS unique_products,
       (SELECT CAST(COUNT(DISTINCT customer_id) AS BIGINT) FROM dim_customer) AS unique_customers""",
         serving.kpis)

_serving("dashboard_bundle", """
SELECT 'by_category' AS panel, p.category AS label, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS value
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key GROUP BY p.category
UNION ALL
SELECT 'by_country', c.country, CAST(SUM(f.revenue) AS DECIMAL(18,2))
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key AND c.is_current
GROUP BY c.country
UNION ALL
SELECT 'daily_revenue', strftime(d.date, '%Y-%m-%d'), CAST(SUM(f.revenue) AS DECIMAL(18,2))
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.date
UNION ALL
SELECT 'kpi', 'total_revenue', CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(18,2)) FROM fact_sales
UNION ALL
SELECT 'kpi', 'orders', CAST(COUNT(*) AS DECIMAL(18,2)) FROM fact_sales
UNION ALL
SELECT 'kpi', 'quarantined', CAST(COUNT(*) AS DECIMAL(18,2)) FROM quarantine
UNION ALL
SELECT 'quarantine_reasons', quarantine_reason, CAST(COUNT(*) AS DECIMAL(18,2))
FROM quarantine GROUP BY quarantine_reason
UNION ALL
SELECT 'kpi', 'unique_products', CAST(COUNT(DISTINCT stock_code) AS DECIMAL(18,2)) FROM dim_product
UNION ALL
SELECT 'kpi', 'unique_customers', CAST(COUNT(DISTINCT customer_id) AS DECIMAL(18,2)) FROM dim_customer""",
         serving.dashboard_bundle)

_serving("preview_fact", """
SELECT f.*, (SELECT CAST(COUNT(*) AS BIGINT) FROM fact_sales) AS table_rows
FROM fact_sales f ORDER BY sale_id LIMIT 5""", serving.preview_fact)

_serving("star_row_counts", """
SELECT 'dim_product' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM dim_product
UNION ALL SELECT 'dim_customer', CAST(COUNT(*) AS BIGINT) FROM dim_customer
UNION ALL SELECT 'dim_date', CAST(COUNT(*) AS BIGINT) FROM dim_date
UNION ALL SELECT 'fact_sales', CAST(COUNT(*) AS BIGINT) FROM fact_sales
UNION ALL SELECT 'quarantine', CAST(COUNT(*) AS BIGINT) FROM quarantine""", serving.star_row_counts)


def queries() -> dict[str, QueryFn]:
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


# ---------------------------------------------------------------------------
# Data-quality checks and profile (on bronze / raw text)
# ---------------------------------------------------------------------------

from ..operators import checks as C  # noqa: E402
from ..operators.profile import column_profile  # noqa: E402
from ..sources.tables import read_table  # noqa: E402


def _suite_query(name: str, build_suite, sql: str):
    def fn(spark, sf_dir):
        return build_suite(spark, sf_dir).run(staged_bronze_for(spark, sf_dir))
    full = (O.BRONZE_CHAIN + ",\n" + sql.lstrip()) if sql.lstrip().startswith("bad AS") else O.on_bronze(sql)
    register(name, full)(fn)


def _sql_not_null(pos: int, col: str, max_frac: float, sev: str) -> str:
    return f"""
SELECT {pos} AS position, 'not_null[{col}]' AS name,
       (CASE WHEN t > 0 THEN n / t ELSE 0.0 END) <= {max_frac!r} AS passed, '{sev}' AS severity,
       CASE WHEN t > 0 THEN CAST((2 * n * 10000 + t) // (2 * t) AS DOUBLE) / 10000.0 ELSE 0.0 END AS observed,
       CAST({max_frac!r} AS DOUBLE) AS threshold,
       CAST(n AS VARCHAR) || '/' || CAST(t AS VARCHAR) || ' rows null in ''{col}''' AS detail
FROM (SELECT COUNT(*) AS t, COUNT(*) FILTER (WHERE {col} IS NULL) AS n FROM bronze)"""


def _sql_non_negative(pos: int, col: str, sev: str) -> str:
    return f"""
SELECT {pos} AS position, 'non_negative[{col}]' AS name, neg = 0 AS passed, '{sev}' AS severity,
       CAST(neg AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
       CAST(neg AS VARCHAR) || ' negative value(s) in ''{col}''' AS detail
FROM (SELECT COUNT(*) FILTER (WHERE TRY_CAST(CAST({col} AS VARCHAR) AS DOUBLE) < 0) AS neg FROM bronze)"""


def _sql_row_count(pos: int, minimum: int, sev: str) -> str:
    return f"""
SELECT {pos} AS position, 'row_count_at_least' AS name, n >= {minimum} AS passed, '{sev}' AS severity,
       CAST(n AS DOUBLE) AS observed, CAST({minimum} AS DOUBLE) AS threshold,
       'only ' || CAST(n AS VARCHAR) || ' rows (expected >= {minimum})' AS detail
FROM (SELECT COUNT(*) AS n FROM bronze)"""


def _sql_unique(pos: int, cols: tuple, sev: str) -> str:
    label = "+".join(cols)
    keys = ", ".join(cols)
    return f"""
SELECT {pos} AS position, 'unique[{label}]' AS name, d = 0 AS passed, '{sev}' AS severity,
       CAST(d AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
       CAST(d AS VARCHAR) || ' duplicate row(s) on ({label})' AS detail
FROM (SELECT COALESCE(SUM(n - 1), 0) AS d FROM (SELECT COUNT(*) AS n FROM bronze GROUP BY {keys}))"""


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


_NOT_NULL_PARAMS = [
    ("invoice_no", 0.0, C.ERROR), ("stock_code", 0.0, C.ERROR), ("description", 0.0, C.WARNING),
    ("quantity", 0.05, C.WARNING), ("unit_price", 0.05, C.WARNING), ("invoice_date", 0.0, C.WARNING),
    ("customer_id", 0.05, C.WARNING), ("country", 0.0, C.ERROR),
]

_suite_query(
    "dq_not_null",
    lambda spark, sf: C.CheckSuite("not_null", [C.not_null(c, m, s) for c, m, s in _NOT_NULL_PARAMS]),
    _union(*[_sql_not_null(i, c, m, s) for i, (c, m, s) in enumerate(_NOT_NULL_PARAMS, 1)]),
)

_suite_query(
    "dq_non_negative",
    lambda spark, sf: C.CheckSuite("non_negative", [C.non_negative("quantity"),
                                                   C.non_negative("unit_price", C.WARNING)]),
    _union(_sql_non_negative(1, "quantity", C.ERROR), _sql_non_negative(2, "unit_price", C.WARNING)),
)

_UNIQUE_PARAMS = [(("invoice_no", "stock_code", "invoice_date"), C.WARNING),
                  (("invoice_no", "stock_code"), C.WARNING),
                  (("customer_id",), C.ERROR)]

_suite_query(
    "dq_unique",
    lambda spark, sf: C.CheckSuite("unique", [C.unique(cols, s) for cols, s in _UNIQUE_PARAMS]),
    _union(*[_sql_unique(i, cols, s) for i, (cols, s) in enumerate(_UNIQUE_PARAMS, 1)]),
)

_suite_query(
    "dq_row_count",
    lambda spark, sf: C.CheckSuite("row_count", [C.row_count_at_least(100),
                                                C.row_count_at_least(1_000_000, C.WARNING)]),
    _union(_sql_row_count(1, 100, C.ERROR), _sql_row_count(2, 1_000_000, C.WARNING)),
)

_suite_query(
    "dq_suite",
    lambda spark, sf: C.build_default_suite(),
    _union(
        _sql_row_count(1, 100, C.ERROR),
        _sql_not_null(2, "invoice_no", 0.0, C.ERROR),
        _sql_not_null(3, "stock_code", 0.0, C.ERROR),
        _sql_not_null(4, "customer_id", 0.05, C.WARNING),
        _sql_not_null(5, "unit_price", 0.05, C.WARNING),
        _sql_non_negative(6, "quantity", C.WARNING),
        _sql_unique(7, ("invoice_no", "stock_code", "invoice_date"), C.WARNING),
    ),
)


def _allowed_countries(spark, sf_dir):
    """Allowed set from the given tables: nations of the first two regions."""
    return read_table(spark, sf_dir, "nation").where(F.col("n_regionkey") < 2).select("n_name")


_suite_query(
    "dq_in_set",
    lambda spark, sf: C.CheckSuite("in_set", [C.in_set("country", _allowed_countries(spark, sf), listed=True)]),
    f"""
, bad AS (SELECT DISTINCT country AS value FROM bronze
          WHERE country IS NOT NULL AND country NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 2))
SELECT 1 AS position, 'in_set[country]' AS name, u = 0 AS passed, 'warning' AS severity,
       CAST(u AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
       CASE WHEN u > 0 THEN 'unexpected values: [' || vs || ']' ELSE '' END AS detail
FROM (SELECT COUNT(*) AS u, string_agg(CASE WHEN contains(v, '''') AND NOT contains(v, '"') THEN '"' || v || '"'
               ELSE '''' || replace(v, '''', '\\''') || '''' END, ', ' ORDER BY value) AS vs
      FROM (SELECT value, replace(replace(replace(replace(value, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') AS v
            FROM bad))""".replace("\n, bad AS", "bad AS", 1),
)


def _profile_sql() -> str:
    parts = []
    for i, c in enumerate(RAW_COLUMNS, 1):
        parts.append(f"""
SELECT {i} AS position, '{c}' AS column,
       CAST(COUNT(*) FILTER (WHERE v IS NULL) AS BIGINT) AS nulls,
       CAST(COUNT(DISTINCT v) AS BIGINT) AS distinct_values,
       CASE WHEN COUNT(*) FILTER (WHERE v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL) = 0
                 AND COUNT(v) > 0 THEN MIN(TRY_CAST(v AS DOUBLE)) END AS min,
       CASE WHEN COUNT(*) FILTER (WHERE v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL) = 0
                 AND COUNT(v) > 0 THEN MAX(TRY_CAST(v AS DOUBLE)) END AS max
FROM (SELECT NULLIF({c}, '') AS v FROM raw)""")
    return "WITH " + O.RAW + "\n" + "\nUNION ALL\n".join(parts)


@register("column_profile", _profile_sql())
def q_column_profile(spark, sf_dir):
    apply_defaults(spark)
    return column_profile(raw_order_lines(spark, sf_dir).select(*RAW_COLUMNS))


# ---------------------------------------------------------------------------
# Loads: replace, append (watermark), merge (upsert + SCD-2), contracts,
# reconciliation, staging and export round trips
# ---------------------------------------------------------------------------

import datetime as _dt  # noqa: E402
import uuid as _uuid  # noqa: E402

from ..operators import contracts as K  # noqa: E402
from ..operators.recon import reconcile  # noqa: E402
from ..operators.star import build_star  # noqa: E402
from ..schema import FACT_SALES, TABLES  # noqa: E402
from ..session import ensure_checkpoint_dir  # noqa: E402
from ..sources.staging import export_star, read_bronze, read_export, write_bronze  # noqa: E402
from ..sources.tables import split_batches  # noqa: E402
from .loads import load_star, rekey, watermark_frame  # noqa: E402
from .warehouse import Warehouse  # noqa: E402

RUN_DATE_1 = _dt.date(2025, 1, 1)
RUN_DATE_2 = _dt.date(2025, 2, 1)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh directory in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestar-{tag}-{_uuid.uuid4().hex}"


def replace_flow(spark, sf_dir):
    def build():
        wh = Warehouse(spark, scratch_path(spark, "wh-replace"))
        return wh, load_star(wh, star_for(spark, sf_dir), "replace")
    return _memo(spark, sf_dir, "replace_flow", build)


def batch_stars(spark, sf_dir):
    def build():
        b1, b2 = split_batches(staged_bronze_for(spark, sf_dir))
        cats = category_map(spark, sf_dir)
        return build_star(b1, cats, staged=True), build_star(b2, cats, staged=True)
    return _memo(spark, sf_dir, "batch_stars", build)


def merge_flow(spark, sf_dir):
    def build():
        s1, s2 = batch_stars(spark, sf_dir)
        wh = Warehouse(spark, scratch_path(spark, "wh-merge"))
        r1 = load_star(wh, s1, "merge", RUN_DATE_1)
        r2 = load_star(wh, s2, "merge", RUN_DATE_2)
        return wh, r1, r2
    return _memo(spark, sf_dir, "merge_flow", build)


def append_flow(spark, sf_dir):
    def build():
        s1, s2 = batch_stars(spark, sf_dir)
        wh = Warehouse(spark, scratch_path(spark, "wh-append"))
        r1 = load_star(wh, s1, "append", RUN_DATE_1)
        r2 = load_star(wh, s2, "append", RUN_DATE_2)
        return wh, r1, r2
    return _memo(spark, sf_dir, "append_flow", build)


def _stored_star(wh: Warehouse) -> StarSchema:
    return wh.star()


@register("load_replace", O.on_star("SELECT * FROM fact_sales"))
def q_load_replace(spark, sf_dir):
    wh, _ = replace_flow(spark, sf_dir)
    return wh.read("fact_sales")


@register("load_quarantine", O.on_star("SELECT * FROM quarantine"))
def q_load_quarantine(spark, sf_dir):
    wh, _ = replace_flow(spark, sf_dir)
    return wh.read("quarantine")


_RECON_CTE = """
o AS (
  SELECT (SELECT COUNT(*) FROM fact_sales f WHERE NOT EXISTS (SELECT 1 FROM dim_product p WHERE p.product_key = f.product_key)) AS op,
         (SELECT COUNT(*) FROM fact_sales f WHERE NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_key = f.customer_key)) AS oc,
         (SELECT COUNT(*) FROM fact_sales f WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)) AS od,
         (SELECT COUNT(*) FROM fact_sales) AS n,
         (SELECT CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(18,2)) FROM fact_sales) AS rev,
         (SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM quarantine) AS expected
)"""

_RECON_SELECT = """
SELECT 1 AS position, 'recon_no_orphan_fks' AS name, op + oc + od = 0 AS passed, 'error' AS severity,
       CAST(op + oc + od AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
       CAST(op AS VARCHAR) || ' product / ' || CAST(oc AS VARCHAR) || ' customer / ' || CAST(od AS VARCHAR) || ' date orphan FK(s)' AS detail
FROM o
UNION ALL
SELECT 2, 'recon_row_counts', n = expected, 'error', CAST(n AS DOUBLE), CAST(expected AS DOUBLE),
       'fact=' || CAST(n AS VARCHAR) || ', expected extract-quarantine=' || CAST(expected AS VARCHAR) FROM o
UNION ALL
SELECT 3, 'recon_revenue', TRUE, 'error', CAST(rev AS DOUBLE), CAST(rev AS DOUBLE),
       'db=' || CAST(rev AS VARCHAR) || ' vs source=' || CAST(rev AS VARCHAR) FROM o"""


@register("recon", O.on_star(_RECON_SELECT, _RECON_CTE))
def q_recon(spark, sf_dir):
    wh, _ = replace_flow(spark, sf_dir)
    star = star_for(spark, sf_dir)
    classified = classified_for(spark, sf_dir)
    totals = classified.agg(F.count(F.lit(1)).alias("n"),
                            F.count_if(F.col(REASON).isNotNull()).alias("q")).first()
    revenue = star.total_revenue().first()[0]
    return reconcile(spark, wh.read_all(), load_mode="replace", rows_extracted=totals["n"],
                     rows_quarantined=totals["q"], source_revenue=revenue)


@register("watermark", O.on_batches("SELECT CAST(watermark AS INTEGER) AS watermark FROM wm"))
def q_watermark(spark, sf_dir):
    wh, _, _ = append_flow(spark, sf_dir)
    return watermark_frame(wh, wh.entries(1))


@register("load_append_fact", O.on_batches("SELECT * FROM fa"))
def q_load_append_fact(spark, sf_dir):
    wh, _, _ = append_flow(spark, sf_dir)
    return wh.read("fact_sales")


@register("upsert_product", O.on_batches("SELECT * FROM p2"))
def q_upsert_product(spark, sf_dir):
    wh, _, _ = append_flow(spark, sf_dir)
    return wh.read("dim_product")


@register("append_customer", O.on_batches("SELECT * FROM ca"))
def q_append_customer(spark, sf_dir):
    wh, _, _ = append_flow(spark, sf_dir)
    return wh.read("dim_customer")


@register("scd2_customer", O.on_batches("SELECT * FROM c2"))
def q_scd2_customer(spark, sf_dir):
    wh, _, _ = merge_flow(spark, sf_dir)
    return wh.read("dim_customer")


@register("scd2_changes", O.on_batches("SELECT * FROM decisions"))
def q_scd2_changes(spark, sf_dir):
    _, _, r2 = merge_flow(spark, sf_dir)
    return r2.scd2_decisions


@register("scd2_history", O.on_batches(
    "SELECT customer_id, country, effective_from, effective_to, is_current FROM c2 "
    "ORDER BY customer_id, effective_from"))
def q_scd2_history(spark, sf_dir):
    wh, _, _ = merge_flow(spark, sf_dir)
    return serving.scd2_history(_stored_star(wh))


@register("keys_continue", O.on_batches(
    "SELECT * FROM c2 WHERE customer_key > (SELECT MAX(customer_key) FROM c1)"))
def q_keys_continue(spark, sf_dir):
    wh, _, _ = merge_flow(spark, sf_dir)
    before = wh.read("dim_customer", wh.entries(1)).select("customer_key")
    return wh.read("dim_customer").join(before, "customer_key", "left_anti")


@register("load_merge_fact", O.on_batches("SELECT * FROM fm"))
def q_load_merge_fact(spark, sf_dir):
    wh, _, _ = merge_flow(spark, sf_dir)
    return wh.read("fact_sales")


@register("fact_rekeyed", O.on_batches(
    "SELECT product_key, customer_key, date_key, invoice_no, quantity, unit_price, revenue FROM r2"))
def q_fact_rekeyed(spark, sf_dir):
    wh, _, _ = merge_flow(spark, sf_dir)
    _, s2 = batch_stars(spark, sf_dir)
    entries = wh.entries(2)
    lines = rekey(s2.lines, wh.read("dim_product", entries), wh.read("dim_customer", entries))
    return lines.drop("_ord")


@register("merged_revenue_by_country", O.on_batches("""
SELECT c.country, CAST(SUM(f.revenue) AS DECIMAL(18,2)) AS revenue
FROM fm f JOIN c2 c ON f.customer_key = c.customer_key
WHERE c.is_current GROUP BY c.country ORDER BY revenue DESC, c.country"""))
def q_merged_revenue_by_country(spark, sf_dir):
    wh, _, _ = merge_flow(spark, sf_dir)
    return serving.revenue_by_country(_stored_star(wh))


# Contracts over the merged warehouse (Type-2 history included).
_MERGED_CTE = {"dim_product": "p2", "dim_customer": "c2", "dim_date": "d2",
               "fact_sales": "fm", "quarantine": "q2"}


def _contract_sql(kind: str) -> str:
    parts = []
    for name in sorted(_MERGED_CTE):
        spec, src = TABLES[name], _MERGED_CTE[name]
        if kind == "unique":
            keys = ([("pk", spec.primary_key)] if spec.primary_key else []) + [("unique", u) for u in spec.unique]
            for k, cols in keys:
                parts.append(f"SELECT '{name}' AS table_name, '{k}({','.join(cols)})' AS constraint_name, "
                             f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS violations "
                             f"FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {', '.join(cols)})")
            if name == "dim_customer":
                parts.append(f"SELECT '{name}', 'one_current(customer_id)', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
                             f"FROM (SELECT COUNT(*) AS n FROM {src} WHERE is_current GROUP BY customer_id)")
        elif kind == "not_null":
            for c in spec.columns:
                if not c.nullable:
                    parts.append(f"SELECT '{name}' AS table_name, 'not_null({c.name})' AS constraint_name, "
                                 f"CAST(COUNT(*) FILTER (WHERE {c.name} IS NULL) AS BIGINT) AS violations FROM {src}")
        else:
            for c in spec.columns:
                if c.max_length:
                    parts.append(f"SELECT '{name}' AS table_name, 'max_length({c.name},{c.max_length})' "
                                 f"AS constraint_name, CAST(COUNT(*) FILTER (WHERE length({c.name}) > "
                                 f"{c.max_length}) AS BIGINT) AS violations FROM {src}")
    return O.on_batches("\nUNION ALL\n".join(parts))


def _merged_tables(spark, sf_dir):
    wh, _, _ = merge_flow(spark, sf_dir)
    return wh.read_all()


def _contract_frames(spark, sf_dir, fn):
    tables = _merged_tables(spark, sf_dir)
    frames = [f for f in (fn(df, TABLES[n]) for n, df in sorted(tables.items())) if f is not None]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("contract_unique", _contract_sql("unique"))
def q_contract_unique(spark, sf_dir):
    return _contract_frames(spark, sf_dir, lambda df, spec: K.unique_violations(df, spec)
                            if (spec.primary_key or spec.unique) else None)


@register("contract_not_null", _contract_sql("not_null"))
def q_contract_not_null(spark, sf_dir):
    return _contract_frames(spark, sf_dir, K.not_null_violations)


@register("contract_length", _contract_sql("length"))
def q_contract_length(spark, sf_dir):
    return _contract_frames(spark, sf_dir, K.length_violations)


@register("orphan_fks", O.on_batches("""
SELECT 'product_key' AS foreign_key, 'dim_product' AS dimension,
       CAST(COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM p2 WHERE p2.product_key = fm.product_key)) AS BIGINT) AS orphans FROM fm
UNION ALL
SELECT 'customer_key', 'dim_customer',
       CAST(COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM c2 WHERE c2.customer_key = fm.customer_key)) AS BIGINT) FROM fm
UNION ALL
SELECT 'date_key', 'dim_date',
       CAST(COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM d2 WHERE d2.date_key = fm.date_key)) AS BIGINT) FROM fm"""))
def q_orphan_fks(spark, sf_dir):
    t = _merged_tables(spark, sf_dir)
    return K.orphan_counts(t["fact_sales"], t)


@register("bronze_roundtrip", O.on_bronze(f"SELECT {BRONZE_COLS} FROM bronze"))
def q_bronze_roundtrip(spark, sf_dir):
    path = write_bronze(bronze_for(spark, sf_dir), scratch_path(spark, "bronze"))
    return read_bronze(spark, path).select(*RAW_COLUMNS)


@register("export_roundtrip", O.on_star("SELECT * FROM fact_sales"))
def q_export_roundtrip(spark, sf_dir):
    out = export_star(star_for(spark, sf_dir).tables(), scratch_path(spark, "export"))
    return read_export(spark, out["fact_sales"], FACT_SALES)


from . import catalog_runs  # noqa: E402,F401  registers the queries of whole runs
