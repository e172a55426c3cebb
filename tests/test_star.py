from decimal import Decimal

import pytest
from conftest import SF_SMALL, line, raw_rows
from pyspark.sql import functions as F

from lakestar.operators.bronze import to_bronze
from lakestar.operators.star import build_star
from lakestar.sources.tables import category_map, raw_order_lines


@pytest.fixture(scope="module")
def star(spark):
    return build_star(to_bronze(raw_order_lines(spark, SF_SMALL)), category_map(spark, SF_SMALL))


def test_golden_counts_sf0001(star):
    counts = {r.table_name: r.row_count for r in star.row_counts().collect()}
    assert counts == {"dim_product": 200, "dim_customer": 150, "dim_date": 1084,
                      "fact_sales": 5913, "quarantine": 87}
    reasons = {r.quarantine_reason: r["count"] for r in star.quarantine.groupBy("quarantine_reason").count().collect()}
    assert reasons == {"duplicate_invoice_line": 57, "missing_customer_id": 5, "missing_or_bad_date": 12,
                       "missing_quantity": 5, "missing_unit_price": 5, "non_positive_quantity": 3}
    assert star.total_revenue().first()[0] == Decimal("136713306.20")


def test_keys_unique_and_dense(star):
    for df, key in ((star.dim_product, "product_key"), (star.dim_customer, "customer_key"),
                    (star.fact_sales, "sale_id")):
        agg = df.agg(F.count(key), F.count_distinct(key), F.min(key), F.max(key)).first()
        assert agg[0] == agg[1] == agg[3] and agg[2] == 1


def test_business_keys_unique(star):
    assert star.dim_product.groupBy("stock_code").count().where("count > 1").count() == 0
    assert star.dim_customer.groupBy("customer_id").count().where("count > 1").count() == 0


def test_fact_foreign_keys_resolve(star):
    f = star.fact_sales
    assert f.where(F.col("product_key").isNull() | F.col("customer_key").isNull()).count() == 0
    for dim, key in ((star.dim_product, "product_key"), (star.dim_customer, "customer_key"),
                     (star.dim_date, "date_key")):
        assert f.join(dim, key, "left_anti").count() == 0


def test_revenue_is_quantity_times_price(star):
    bad = star.fact_sales.where(F.col("revenue") != F.col("quantity") * F.col("unit_price"))
    assert bad.count() == 0


def test_weekend_flags(star):
    d = star.dim_date
    assert d.where(F.col("is_weekend") != F.col("weekday").isin("Saturday", "Sunday")).count() == 0


def test_uncategorised_default(star):
    cats = {r.category for r in star.dim_product.select("category").distinct().collect()}
    assert "Uncategorised" in cats and len(cats) == 7


def test_first_valid_row_sets_dimension_attributes(spark):
    # Product price/description come from the first *valid* row.
    rows = [line(stock="SKU-1", desc="first-invalid", price="1.00", cust=""),
            line(invoice="INV2", stock="SKU-1", desc="first-valid", price="2.00"),
            line(invoice="INV3", stock="SKU-1", desc="later", price="3.00")]
    s = build_star(to_bronze(raw_rows(spark, rows)))
    p = s.dim_product.first()
    assert (p.description, p.unit_price, p.category) == ("first-valid", Decimal("2.00"), "Uncategorised")
    # the fact keeps each line's own price
    assert sorted(r.unit_price for r in s.fact_sales.collect()) == [Decimal("2.00"), Decimal("3.00")]


def test_dates_are_staged_once(star):
    assert star.dim_date.inputFiles() and all("/dates-" in f for f in star.dim_date.inputFiles())


def test_lines_are_not_shuffled_by_customer(spark):
    """Orders meet their customers first: no line, and no text, crosses that join's shuffle."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = raw_order_lines(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = next(i for i, x in enumerate(plan) if "Exchange hashpartitioning(o_custkey" in x)
    depth = plan[at].index("Exchange")
    below = [x for x in plan[at + 1:at + 8] if len(x) - len(x.lstrip(" :+-")) > depth]
    assert below and not any("l_orderkey" in x for x in below)


def test_lines_are_sorted_by_numbers_only(spark):
    """First lines and file measures must not sort all lines: their minima are of longs, or of a task's few files."""
    from lakestar.operators.star import first_rows

    s = build_star(to_bronze(raw_rows(spark, [line(), line(invoice="INV2", desc="Y", price="2.00")])))
    assert dict(s.lines.dtypes)["_ord"] == "bigint" and "fact_sales" not in vars(s)
    plan = first_rows(s.lines, "stock_code", ["description", "unit_price"])._jdf.queryExecution().executedPlan().toString()
    lowest = [x for x in plan.split("\n") if "Aggregate(" in x][-1]
    assert "HashAggregate(" in lowest and "partial_min(_ord" in lowest and "struct" not in lowest
    assert s.total_revenue().first()[0] == s.fact_sales.selectExpr("sum(revenue)").first()[0] == Decimal("12.00")


def test_first_line_among_equal_ordinals(spark):
    """Lines of one ordinal: the least attributes win, as in a minimum over (ordinal, attributes)."""
    raw = raw_rows(spark, [line(invoice="A", desc="y", country="UK"), line(invoice="B", desc="x", country="FR")])
    s = build_star(to_bronze(raw.withColumn("_ord", F.lit("same"))))
    assert s.dim_product.first().description == "x" and s.dim_customer.first().country == "FR"
    assert s.fact_sales.count() == 2


def test_a_code_with_two_categories_has_two_products(spark):
    """Its lines come once for each product, with numbers, rows and revenue of their own."""
    categories = spark.createDataFrame([("SKU-1", "a"), ("SKU-1", "b")], "stock_code string, category string")
    s = build_star(to_bronze(raw_rows(spark, [line(), line(invoice="INV2", stock="SKU-2", price="5.00")])), categories)
    assert sorted(r.sale_id for r in s.fact_sales.collect()) == [1, 2, 3] and s.known_rows["fact_sales"] == 3
    assert s.total_revenue().first()[0] == Decimal("25.00")
