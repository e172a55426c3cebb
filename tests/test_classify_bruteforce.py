"""Randomised check of classification against a row-by-row Python model."""

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from conftest import raw_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakestar.operators.bronze import to_bronze
from lakestar.operators.classify import REASON, classify
from lakestar.schema import NA_TOKENS, REASONS

_ISO = re.compile(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$")


def _text(v):
    if v is None or v in NA_TOKENS:
        return None
    v = v.strip()
    return v or None


def _qty(v):
    if v is None or v in NA_TOKENS:
        return None
    try:
        return int(v.strip())
    except ValueError:
        return None


def _price(v):
    if v is None or v in NA_TOKENS:
        return None
    try:
        return Decimal(v.strip()).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None


def _date(v):
    if v is None or v in NA_TOKENS or not _ISO.match(v.strip()):
        return None
    try:
        return dt.datetime.fromisoformat(v.strip())
    except ValueError:
        return None


def model(rows):
    """First-match reasons; duplicates over all rows in file order."""
    seen, out = set(), []
    for inv, stock, _desc, qty, price, date, cust, _country in rows:
        inv, stock, cust = _text(inv), _text(stock), _text(cust)
        q, p, d = _qty(qty), _price(price), _date(date)
        grain = (inv, stock, d)
        dup = grain in seen
        seen.add(grain)
        tests = [inv is None, stock is None, d is None, cust is None, p is None, q is None,
                 (q or 0) <= 0, dup]
        out.append(next((r for r, hit in zip(REASONS, tests) if hit), None))
    return out


field = st.sampled_from
row = st.tuples(
    field(["INV1", "INV2", " INV1 ", "", "NA"]),
    field(["SKU-1", "SKU-2", "  SKU-1", "", "null"]),
    field(["mug"]),
    field(["1", "2", "-3", "0", "x", "", "12"]),
    field(["1.00", "2.50", "", "abc", "0.125"]),
    field(["2025-01-01", "2025-01-02", "2025-01-01 10:00", "bad", "2025", "2025-02-30"]),
    field(["C-1", "C-2", "", " C-1"]),
    field(["UK"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25))
def test_classify_matches_row_model(spark, rows):
    got = [r[REASON] for r in classify(to_bronze(raw_rows(spark, rows))).orderBy("_ord").collect()]
    assert got == model(rows)
