from decimal import Decimal
import datetime as dt

from conftest import line, raw_rows

from lakestar.operators.bronze import to_bronze, with_na_tokens


def _one(spark, **kw):
    return to_bronze(raw_rows(spark, [line(**kw)])).first()


def test_na_tokens_become_null_before_trimming(spark):
    rows = [line(desc="NA"), line(desc=" NA "), line(desc="null"), line(desc="n/a"), line(desc="")]
    out = [r.description for r in with_na_tokens(raw_rows(spark, rows)).collect()]
    assert out == [None, " NA ", None, None, None]


def test_unicode_whitespace_trim_and_empty_to_null(spark):
    r = _one(spark, stock="  SKU-9　\t", cust="   ", country=" ")
    assert r.stock_code == "SKU-9"
    assert r.customer_id is None and r.country is None


def test_quantity_coercion(spark):
    vals = ["7", " 7 ", "-3", "1e3", "2.5", "x", "inf", "", "99999999999999999999"]
    rows = [line(qty=v) for v in vals]
    got = [r.quantity for r in to_bronze(raw_rows(spark, rows)).collect()]
    assert got == [7, 7, -3, 1000, None, None, None, None, None]


def test_price_is_exact_decimal(spark):
    vals = ["8.50", "0.125", "", "abc", "1e2"]
    got = [r.unit_price for r in to_bronze(raw_rows(spark, [line(price=v) for v in vals])).collect()]
    assert got == [Decimal("8.50"), Decimal("0.13"), None, None, Decimal("100.00")]


def test_date_policy_iso_only(spark):
    vals = ["2025-01-01", "2025-01-01 10:30", "2025-01-01T10:30:05", "2025", "2025-02-30",
            "01/02/2025", "not-a-date"]
    got = [r.invoice_date for r in to_bronze(raw_rows(spark, [line(date=v) for v in vals])).collect()]
    assert got == [dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 10, 30),
                   dt.datetime(2025, 1, 1, 10, 30, 5), None, None, None, None]


def test_no_row_is_dropped(spark):
    rows = [line(qty="x", price="", date="bad", cust="", invoice="")] * 5
    assert to_bronze(raw_rows(spark, rows)).count() == 5


def test_number_and_zone_text(spark):
    from pyspark.sql import functions as F

    from lakestar.functions.coerce import to_iso_timestamp, to_whole_number

    df = spark.createDataFrame([(x,) for x in ("5d", "7f", "1e3", "5.0", "5.5", "9223372036854775807", "1e40", "Infinity", "3000000000")], "v string")
    got = [r[0] for r in df.select(to_whole_number(F.col("v"))).collect()]
    assert got == [None, None, 1000, 5, None, 9223372036854775807, None, None, 3000000000]
    dates = spark.createDataFrame([("2025-01-02T03:04:05Z",), ("2025-01-02 03:04+02:00",), ("2025-01-02",), ("2025-01-02Z",)], "v string")
    assert [str(r[0]) for r in dates.select(to_iso_timestamp(F.col("v"))).collect()] == [
        "2025-01-02 03:04:05", "2025-01-02 03:04:00", "2025-01-02 00:00:00", "None"]


def test_short_ways_of_coercion_equal_the_long_ones(spark):
    """Texts that need no stripping and bare dates skip the scan and the pattern; nothing else may."""
    from pyspark.sql import functions as F

    from lakestar.functions import coerce

    texts = ["", " ", "a", "a ", " a", "a　", "　", "é", "é ", " é", "~a!", "\u007f", "2025-01-02", "2025-1-002",
             "2025-01-2 ", " 2025-01-2", "2025-01-1T", "2025-01-T1", "+025-01-02", "-025-01-02", "2025-02-30", "2025-01-0٣", "20a5-01-02",
             "2025- 1-02", "2025-01-+2", "9999-12-31", "0000-01-01", " 2025-01-02 ", "2025-01-02T03:04", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    trim = F.btrim("t", F.lit(coerce.UNICODE_WHITESPACE))
    got = df.select("t", trim.eqNullSafe(coerce.unicode_trim(F.col("t"))).alias("a"),
                    F.nullif(trim, F.lit("")).eqNullSafe(coerce.trim_to_null(F.col("t"))).alias("b"),
                    coerce._patterned_timestamp(F.col("t")).eqNullSafe(coerce.to_iso_timestamp(F.col("t"))).alias("c")).collect()
    assert [r.t for r in got if not (r.a and r.b and r.c)] == []


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    from lakestar.session import apply_defaults

    apply_defaults(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
