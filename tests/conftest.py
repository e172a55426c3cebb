from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType, StructField, StructType  # noqa: E402

from lakestar.schema import RAW_COLUMNS  # noqa: E402
from lakestar.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app_name="lakestar-tests")
    yield session
    session.stop()


RAW_SCHEMA_WITH_ORD = StructType(
    [StructField(c, StringType(), True) for c in RAW_COLUMNS]
    + [StructField("_ord", StringType(), True)]
)


def raw_rows(spark, rows):
    """Raw text lines; ``_ord`` is the position in ``rows`` (file order)."""
    data = [tuple(r) + (f"{i:08d}",) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, RAW_SCHEMA_WITH_ORD)


def line(invoice="INV1", stock="SKU-1", desc="X", qty="1", price="10.00", date="2025-01-01",
         cust="C-1", country="UK"):
    return (invoice, stock, desc, qty, price, date, cust, country)


@pytest.fixture(autouse=True)
def _release_engine_caches():
    yield
    from lakestar.operators.cache import release
    release()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


__all__ = ["raw_rows", "line", "F", "SF_SMALL", "d"]
