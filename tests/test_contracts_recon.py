import datetime as dt
from decimal import Decimal

import pytest
from conftest import line, raw_rows
from pyspark.sql import functions as F

from lakestar.operators import contracts as K
from lakestar.operators.bronze import to_bronze
from lakestar.operators.recon import reconcile
from lakestar.operators.star import build_star, typed
from lakestar.plans.loads import load_star
from lakestar.plans.warehouse import Warehouse
from lakestar.schema import DIM_PRODUCT, FACT_SALES, PIPELINE_RUNS, TABLES


def _star(spark):
    rows = [line(invoice="INV1", stock="SKU-1", date="2025-01-01"),
            line(invoice="INV2", stock="SKU-2", date="2025-01-02", cust="C-2"),
            line(invoice="INV3", stock="", date="2025-01-03")]
    return build_star(to_bronze(raw_rows(spark, rows)))


def _loaded(spark, scratch):
    wh = Warehouse(spark, scratch)
    star = _star(spark)
    load_star(wh, star, "replace")
    return wh, star


def test_recon_passes_on_clean_load(spark, scratch):
    wh, star = _loaded(spark, scratch)
    res = {r.name: r for r in reconcile(spark, wh.read_all(), load_mode="replace", rows_extracted=3,
                                        rows_quarantined=1, source_revenue=Decimal("20.00")).collect()}
    assert all(r.passed for r in res.values())
    assert res["recon_row_counts"].observed == 2.0


def test_recon_fails_on_planted_orphan(spark, scratch):
    wh, star = _loaded(spark, scratch)
    tables = wh.read_all()
    planted = tables["fact_sales"].withColumn("product_key", F.when(F.col("sale_id") == 1, F.lit(999))
                                              .otherwise(F.col("product_key")))
    tables["fact_sales"] = planted
    res = {r.name: r for r in reconcile(spark, tables, load_mode="replace", rows_extracted=3,
                                        rows_quarantined=1, source_revenue=Decimal("20.00")).collect()}
    assert not res["recon_no_orphan_fks"].passed
    assert res["recon_no_orphan_fks"].detail == "1 product / 0 customer / 0 date orphan FK(s)"


def test_recon_revenue_and_counts_mismatch(spark, scratch):
    wh, _ = _loaded(spark, scratch)
    res = {r.name: r for r in reconcile(spark, wh.read_all(), load_mode="replace", rows_extracted=4,
                                        rows_quarantined=1, source_revenue=Decimal("21.00")).collect()}
    assert not res["recon_row_counts"].passed and not res["recon_revenue"].passed
    inc = {r.name: r for r in reconcile(spark, wh.read_all(), load_mode="merge", rows_extracted=2,
                                        rows_quarantined=1, source_revenue=Decimal("10.00")).collect()}
    assert inc["recon_row_counts"].passed and inc["recon_revenue"].passed


def test_contracts_catch_planted_faults(spark, scratch):
    wh, _ = _loaded(spark, scratch)
    t = wh.read_all()
    dup_pk = t["dim_product"].unionByName(t["dim_product"].limit(1))
    long_code = t["dim_product"].withColumn("stock_code", F.lit("S" * 40))
    with pytest.raises(K.ContractViolation, match="pk\\(product_key\\)"):
        K.enforce({"dim_product": dup_pk})
    with pytest.raises(K.ContractViolation, match="max_length\\(stock_code,32\\)"):
        K.enforce({"dim_product": long_code})
    nulls = t["dim_customer"].withColumn("country", F.lit(None).cast("string"))
    with pytest.raises(K.ContractViolation, match="not_null\\(country\\)"):
        K.enforce({"dim_customer": nulls})
    two_current = t["dim_customer"].unionByName(
        t["dim_customer"].withColumn("customer_key", F.col("customer_key") + 100)
        .withColumn("effective_from", F.lit(dt.date(2025, 1, 1))))
    with pytest.raises(K.ContractViolation, match="one_current"):
        K.enforce({"dim_customer": two_current})
    orphan = dict(t)
    orphan["fact_sales"] = t["fact_sales"].withColumn("date_key", F.lit(19000101))
    with pytest.raises(K.ContractViolation, match="fk\\(date_key->dim_date\\)"):
        K.enforce(orphan)


def test_declared_equals_stored_schema(spark, scratch):
    # What is stored has exactly the declared columns and types.
    wh, _ = _loaded(spark, scratch)
    for e in wh.entries():
        stored = spark.read.parquet(e.path).schema
        declared = TABLES[e.table_name].schema
        got = [(f.name, f.dataType) for f in stored.fields]
        want = [(f.name, f.dataType) for f in declared.fields]
        assert got == want, e.table_name


def test_typed_drops_undeclared_columns(spark):
    df = spark.createDataFrame([(1, "S", "d", "c", "1.50", "extra")],
                               "product_key long, stock_code string, description string, category string, "
                               "unit_price string, junk string")
    out = typed(df, DIM_PRODUCT)
    assert out.columns == DIM_PRODUCT.column_names
    assert out.schema == DIM_PRODUCT.schema or [f.dataType for f in out.schema] == [
        f.dataType for f in DIM_PRODUCT.schema]


def test_failed_load_does_not_block_the_next(spark, scratch):
    """A load that breaks a contract leaves its files behind; the next one
    takes the same version number and succeeds."""
    from dataclasses import replace

    good = _star(spark)
    bad = replace(good, dim_product=good.dim_product.union(good.dim_product))
    wh = Warehouse(spark, scratch)
    with pytest.raises(K.ContractViolation):
        load_star(wh, bad, "replace")
    assert wh.version() == 0
    assert load_star(wh, good, "replace").version == 1
    assert wh.read("fact_sales").count() == 2


def test_keys_of_several_columns_are_counted_by_a_hash(spark):
    from lakestar.operators.contracts import unique_violations
    from lakestar.schema import FACT_SALES

    rows = [(i, p, inv, day) for i, (p, inv, day) in enumerate(
        [(1, "a", 20310101)] * 3 + [(1, "a", 20310102), (None, "a", 20310101), (None, "a", 20310101), (2, None, 20310101)])]
    df = spark.createDataFrame(rows + [(0, 9, "z", 20310101)], "sale_id long, product_key long, invoice_no string, date_key int")
    found = {r.constraint_name: r.violations for r in unique_violations(df, FACT_SALES).collect()}
    assert found == {"pk(sale_id)": 1, "unique(invoice_no,product_key,date_key)": 3}
    assert "xxhash64" in unique_violations(df, FACT_SALES)._jdf.queryExecution().toString()
