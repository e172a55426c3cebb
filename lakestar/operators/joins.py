"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side (rows) that may be broadcast. A session can lower or raise
# it with ``spark.lakestar.broadcastMaxRows``.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000


def broadcast_max_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get("spark.lakestar.broadcastMaxRows", None)
    return int(value) if value else DEFAULT_BROADCAST_MAX_ROWS


def maybe_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` if its row count is within the bound, else leave it.

    ``rows`` is the already-known count (e.g. from a checkpointed frame);
    otherwise the frame is counted. Beyond the bound the join stays a
    shuffle join, where AQE's skew-join handling splits hot keys.
    """
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= broadcast_max_rows(df) else df


def null_safe_on(left: DataFrame, right: DataFrame, left_cols, right_cols) -> Column:
    """Conjunction of null-safe equalities (null matches null)."""
    conds = [left[a].eqNullSafe(right[b]) for a, b in zip(left_cols, right_cols)]
    return reduce(lambda x, y: x & y, conds)
