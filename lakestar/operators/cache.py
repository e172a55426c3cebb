"""Session-cache bookkeeping for the engine's own intermediate frames.

Intermediate results (duplicate groups, numbering inputs, SCD-2 changes)
are persisted while a build or load needs them. Every cached plan makes
Spark's analysis of each new query slower (plans are matched against the
cache), and executors keep the blocks, so a run releases what it cached
when it finishes. Releasing never changes results: a released frame is
recomputed from its (deterministic) lineage or its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_HELD: list[DataFrame] = []


def hold(df: DataFrame) -> DataFrame:
    """``df.persist()`` and remember it for ``release``."""
    out = df.persist()
    _HELD.append(out)
    return out


def release() -> int:
    """Unpersist every frame held so far; returns how many."""
    n = len(_HELD)
    while _HELD:
        _HELD.pop().unpersist()
    return n
