"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from .calendar import date_attributes, date_key, is_weekend, key_to_date, month_key, weekday_name
from .coerce import na_to_null, to_iso_timestamp, to_money, to_whole_number, trim_to_null
from .money import line_revenue, money_sum, money_total

__all__ = [
    "date_attributes", "date_key", "is_weekend", "key_to_date", "month_key", "weekday_name",
    "na_to_null", "to_iso_timestamp", "to_money", "to_whole_number", "trim_to_null",
    "line_revenue", "money_sum", "money_total",
]
