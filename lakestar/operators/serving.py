"""Serving queries: the roll-ups a sales dashboard asks of the star.

Every query is a fact-side aggregation with dimension lookups. Dimensions
are joined with ``maybe_broadcast`` (measured row count), so the fact is
scanned once per query with map-side partial aggregation and never
shuffled whole. Money sums are decimal(18,2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import key_to_date
from ..functions.money import money_sum, money_total
from .joins import maybe_broadcast
from .star import StarSchema


def _rows(star: StarSchema, name: str) -> int | None:
    """Known row count of a dimension (from building or the manifest); a
    bound for its filtered/projected forms, so no count job is needed."""
    return (star.known_rows or {}).get(name)


def _dim(star: StarSchema, name: str, *cols: str) -> DataFrame:
    return maybe_broadcast(getattr(star, name).select(*cols), _rows(star, name))


def _current_customers(star: StarSchema, *cols: str) -> DataFrame:
    return maybe_broadcast(star.dim_customer.where(F.col("is_current")).select(*cols),
                           _rows(star, "dim_customer"))


def revenue_by_category(star: StarSchema) -> DataFrame:
    """Revenue by product category, highest first."""
    prod = _dim(star, "dim_product", "product_key", "category")
    return (
        star.fact_sales.join(prod, "product_key")
        .groupBy("category")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def report_by_category(star: StarSchema) -> DataFrame:
    """CLI report: fact left-joined to products, revenue per category."""
    prod = _dim(star, "dim_product", "product_key", "category")
    return (
        star.fact_sales.join(prod, "product_key", "left")
        .where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def top_products(star: StarSchema, k: int = 5) -> DataFrame:
    """Top-k products by units sold (ties broken by stock_code)."""
    units = (
        star.fact_sales.groupBy("product_key")
        .agg(F.sum("quantity").cast("bigint").alias("units"))
    )
    prod = _dim(star, "dim_product", "product_key", "stock_code", "description")
    return (
        units.join(prod, "product_key")
        .groupBy("stock_code", "description")
        .agg(F.sum("units").cast("bigint").alias("units"))
        .orderBy(F.desc("units"), "stock_code")
        .limit(k)
    )


def revenue_by_country(star: StarSchema) -> DataFrame:
    """Revenue by country over *current* customer versions only."""
    cust = _current_customers(star, "customer_key", "country")
    return (
        star.fact_sales.join(cust, "customer_key")
        .groupBy("country")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy(F.desc("revenue"), "country")
    )


def monthly_revenue(star: StarSchema) -> DataFrame:
    dates = _dim(star, "dim_date", "date_key", "year", "month")
    return (
        star.fact_sales.join(dates, "date_key")
        .groupBy("year", "month")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy("year", "month")
    )


def weekend_revenue(star: StarSchema) -> DataFrame:
    dates = _dim(star, "dim_date", "date_key", "is_weekend")
    return (
        star.fact_sales.join(dates, "date_key")
        .groupBy("is_weekend")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy("is_weekend")
    )


def quarantine_reasons(star: StarSchema) -> DataFrame:
    return (
        star.quarantine.groupBy("quarantine_reason")
        .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
        .orderBy(F.desc("rows"), "quarantine_reason")
    )


def scd2_history(star: StarSchema) -> DataFrame:
    return star.dim_customer.select(
        "customer_id", "country", "effective_from", "effective_to", "is_current"
    ).orderBy("customer_id", "effective_from")


def daily_revenue(star: StarSchema) -> DataFrame:
    """Revenue per calendar day via the date dimension."""
    dates = _dim(star, "dim_date", "date_key", "date")
    return (
        star.fact_sales.join(dates, "date_key")
        .groupBy("date")
        .agg(money_sum(F.col("revenue")).alias("revenue"))
        .orderBy("date")
    )


def daily_revenue_from_key(star: StarSchema) -> DataFrame:
    """Revenue per day straight from the fact's yyyymmdd key (no join)."""
    return (
        star.fact_sales.groupBy("date_key")
        .agg(F.sum("revenue").alias("_rev"))
        .select(key_to_date(F.col("date_key")).alias("date"),
                F.col("_rev").cast("decimal(18,2)").alias("revenue"))
        .orderBy("date")
    )


def total_revenue(star: StarSchema) -> DataFrame:
    """COALESCE(SUM(revenue), 0) -- one row even for an empty fact."""
    return star.fact_sales.agg(money_total(F.col("revenue")).alias("revenue"))


def kpis(star: StarSchema) -> DataFrame:
    """Headline numbers in one row; each table is aggregated map-side in one
    scan, and the one-row results are stacked and folded into columns."""
    wide = "decimal(20,2)"

    def number(name: str, value):
        return F.struct(F.lit(name).alias("k"), value.cast(wide).alias("v"))

    fact = star.fact_sales.agg(money_total(F.col("revenue")).alias("rev"), F.count(F.lit(1)).alias("n"))
    parts = [
        fact.select(F.inline(F.array(number("total_revenue", F.col("rev")), number("orders", F.col("n"))))),
        star.quarantine.agg(F.count(F.lit(1)).cast(wide).alias("v"))
        .select(F.lit("quarantined").alias("k"), "v"),
        star.dim_product.agg(F.count_distinct("stock_code").cast(wide).alias("v"))
        .select(F.lit("unique_products").alias("k"), "v"),
        star.dim_customer.agg(F.count_distinct("customer_id").cast(wide).alias("v"))
        .select(F.lit("unique_customers").alias("k"), "v"),
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)

    def pick(name: str, dtype: str):
        return F.max(F.when(F.col("k") == name, F.col("v"))).cast(dtype).alias(name)

    return stacked.agg(
        pick("total_revenue", "decimal(18,2)"),
        pick("orders", "bigint"),
        pick("quarantined", "bigint"),
        pick("unique_products", "bigint"),
        pick("unique_customers", "bigint"),
    )


def dashboard_bundle(star: StarSchema) -> DataFrame:
    """Tidy (panel, label, value) rows: KPIs, by category, by country, daily
    revenue and quarantine reasons.

    The three fact roll-ups plus the revenue total come from ONE scan of the
    fact via grouping sets (one Expand + one partial/final aggregation).
    """
    prod = _dim(star, "dim_product", "product_key", "category")
    cust = _current_customers(star, "customer_key", "country")
    dates = _dim(star, "dim_date", "date_key", "date")
    joined = (
        star.fact_sales.select("product_key", "customer_key", "date_key", "revenue")
        .join(prod, "product_key", "left")
        .join(cust, "customer_key", "left")
        .join(dates, "date_key", "left")
    )
    rolled = joined.groupingSets(
        [["category"], ["country"], ["date"], []], "category", "country", "date"
    ).agg(
        F.sum("revenue").alias("_rev"),
        F.count(F.lit(1)).alias("_n"),
        F.grouping_id().alias("_gid"),
    )
    # grouping_id bits: category=4, country=2, date=1 (1 = not grouped).
    gid = F.col("_gid")
    panel = (
        F.when(gid == 3, F.lit("by_category"))
        .when(gid == 5, F.lit("by_country"))
        .when(gid == 6, F.lit("daily_revenue"))
        .otherwise(F.lit("total"))
    )
    label = (
        F.when(gid == 3, F.col("category"))
        .when(gid == 5, F.col("country"))
        .when(gid == 6, F.date_format("date", "yyyy-MM-dd"))
    )
    money = "decimal(18,2)"

    def row(panel, label, value):
        return F.struct(panel.alias("panel"), label.alias("label"), value.cast(money).alias("value"))

    # Each rolled row is unpivoted in place, so the fact is read once. Groups
    # with a null key are dropped, as in the dashboard's group-bys.
    kpi = F.lit("kpi")
    unpivoted = F.when(panel == "total", F.array(
        row(kpi, F.lit("total_revenue"), F.coalesce(F.col("_rev"), F.lit(0))), row(kpi, F.lit("orders"), F.col("_n"))
    )).otherwise(F.array(row(panel, label, F.col("_rev"))))
    fact_rows = rolled.select(F.inline(unpivoted)).where(F.col("label").isNotNull())
    q = star.quarantine
    q_total = q.agg(F.count(F.lit(1)).cast(money).alias("value")).select(
        F.lit("kpi").alias("panel"), F.lit("quarantined").alias("label"), "value")
    q_reasons = q.groupBy("quarantine_reason").agg(F.count(F.lit(1)).cast(money).alias("value")).select(
        F.lit("quarantine_reasons").alias("panel"), F.col("quarantine_reason").alias("label"), "value")
    prods = star.dim_product.agg(F.count_distinct("stock_code").cast(money).alias("value")).select(
        F.lit("kpi").alias("panel"), F.lit("unique_products").alias("label"), "value")
    custs = star.dim_customer.agg(F.count_distinct("customer_id").cast(money).alias("value")).select(
        F.lit("kpi").alias("panel"), F.lit("unique_customers").alias("label"), "value")
    return (
        fact_rows.unionByName(q_total).unionByName(q_reasons)
        .unionByName(prods).unionByName(custs)
    )


def preview_fact(star: StarSchema, n: int = 5) -> DataFrame:
    """Table preview: first ``n`` fact rows by sale_id plus the table's size."""
    total = (star.known_rows or {}).get("fact_sales")
    if total is None:
        total = star.fact_sales.count()
    return (
        star.fact_sales.orderBy("sale_id").limit(n)
        .withColumn("table_rows", F.lit(total).cast("bigint"))
    )


def star_row_counts(star: StarSchema) -> DataFrame:
    return star.row_counts()
