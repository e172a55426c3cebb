"""Calendar expressions for the date dimension and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """Integer yyyymmdd key of a date or timestamp."""
    day = F.to_date(d)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(date_key_col: Column) -> Column:
    """Integer yyyymm of a yyyymmdd key (the fact's storage partition)."""
    return F.floor(date_key_col / 100).cast("int")


def key_to_date(date_key_col: Column) -> Column:
    """yyyymmdd integer -> DATE."""
    k = date_key_col.cast("int")
    return F.make_date(F.floor(k / 10000).cast("int"),
                       (F.floor(k / 100) % 100).cast("int"),
                       (k % 100).cast("int"))


def weekday_name(d: Column) -> Column:
    """Full English day name ("Saturday"), independent of session locale."""
    return F.date_format(d, "EEEE")


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday (Monday = 0 numbering, weekday >= 5)."""
    return F.weekday(d) >= 5


def date_attributes(d: Column) -> dict[str, Column]:
    """All dim_date attribute columns of a DATE column, in declared order."""
    return {
        "date_key": date_key(d),
        "date": d,
        "year": F.year(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        "weekday": weekday_name(d),
        "is_weekend": is_weekend(d),
    }
