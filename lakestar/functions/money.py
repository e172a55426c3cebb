"""Exact money arithmetic on decimals (never floats)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import REVENUE, SUM_MONEY


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """quantity x price, exact for every bigint and decimal(12,2)."""
    return quantity.cast("bigint").cast("decimal(19,0)") * unit_price


def line_revenue(quantity: Column, unit_price: Column) -> Column:
    """The amount as stored money; null if it doesn't fit."""
    return line_amount(quantity, unit_price).try_cast(REVENUE)


def amount_out_of_range(quantity: Column, unit_price: Column) -> Column:
    """Whether the amount doesn't fit as stored money.

    Revenue has two digits more than a price, so a quantity of one or two
    digits always fits: most lines need no decimal product.
    """
    return F.when(quantity.between(-99, 99), unit_price.isNull()).otherwise(line_revenue(quantity, unit_price).isNull())


def money_sum(c: Column) -> Column:
    """Sum of money as decimal(18,2); empty input sums to null."""
    return F.sum(c).cast(SUM_MONEY)


def money_total(c: Column) -> Column:
    """COALESCE(SUM(x), 0) as decimal(18,2)."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(SUM_MONEY)
