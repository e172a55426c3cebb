"""Dense surrogate numbering without a single-partition window.

A global ``row_number()`` plans ``Exchange SinglePartition``: every row
through one task. Instead (two passes, like ``zipWithIndex``):

1. range-partition by the ordering, sort inside each partition and write
   the rows with their partition and position as Parquet to the shared
   folder (a lost executor re-reads files and numbers never change),
2. count rows per partition -> running offsets (one row per partition is
   the only thing that reaches the driver),
3. number = partition offset + position, by a broadcast join with the small
   table of offsets (Spark doesn't know its size, and would shuffle the rows).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id: partition id above bit 33


PLACE = "_at"  # where a row stands: its partition above bit 33, its position in it below


@dataclass(frozen=True)
class Numbered:
    df: DataFrame
    rows: int


@dataclass(frozen=True)
class Placed:
    """Rows in order, written once: ``df`` has their places (``PLACE``), ``sizes`` the rows of each partition."""

    df: DataFrame
    sizes: list[tuple[int, int]]

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.sizes)

    def numbered(self, name: str, start: int = 1, dtype: str = "long") -> DataFrame:
        """``df`` + ``name`` = start, start+1, ... in the rows' order."""
        return self.number(self.df, PLACE, name, start, dtype)

    def number(self, df: DataFrame, at: str, name: str, start: int = 1, dtype: str = "long") -> DataFrame:
        """The same for ``df``, which has each of these rows once, its place in column ``at``."""
        before = accumulate([start] + [n for _, n in self.sizes])
        offsets = df.sparkSession.createDataFrame(
            [(pid, n) for (pid, _), n in zip(self.sizes, before)], "_pid int, _before long")
        position = F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        return (df.withColumn("_pid", F.shiftright(at, _ROW_BITS).cast("int")).join(F.broadcast(offsets), "_pid")
                .withColumn(name, (F.col("_before") + position).cast(dtype)).drop("_pid", "_before"))


def _leaves(df: DataFrame, name: str) -> list:
    """The order of a column by its plain fields: Spark sorts numbers by
    their bits, structs by a comparison of whole structs for each pair."""
    def fields(c, dtype):
        if not isinstance(dtype, StructType) or not dtype.fields:
            return [c]
        return [x for f in dtype.fields for x in fields(c.getField(f.name), f.dataType)] + [c.isNotNull()]
    return fields(F.col(name), df.schema[name].dataType)


def place(df: DataFrame, order_by: list, ties: tuple = (), drop: tuple = ()) -> Placed:
    """Rows of ``df`` by ``order_by`` (and ``ties``), written without the columns of ``drop``.

    A place is a long, equal on any later read, so what needs the order
    after this compares places, not ``order_by``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/numbered-{uuid.uuid4().hex}"
    order = [x for name in order_by for x in _leaves(df, name)]
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order, *ties)
              .withColumn(PLACE, F.monotonically_increasing_id()).drop(*drop))
    placed.write.parquet(path)
    ranged = spark.read.schema(placed.schema).parquet(path)
    counts = (ranged.groupBy(F.shiftright(PLACE, _ROW_BITS).cast("int").alias("_pid"))
              .agg(F.count(F.lit(1)).alias("n")).collect())  # one row a partition
    return Placed(ranged, sorted((r["_pid"], r["n"]) for r in counts))


def dense_number(df: DataFrame, order_by: list, name: str, *, start: int = 1,
                 dtype: str = "long") -> Numbered:
    """Append ``name`` = start, start+1, ... in ``order_by`` order.

    ``order_by`` must be a total order (unique), so the numbering is the
    same on any recomputation. Returns the numbered frame and its row count.
    """
    placed = place(df, order_by)
    return Numbered(placed.numbered(name, start, dtype).drop(PLACE), placed.rows)


def continue_numbering(new_members: DataFrame, order_by: list, name: str,
                       current_max: int, dtype: str = "long") -> Numbered:
    """Number new members max+1, max+2, ... in natural-key order (K-6)."""
    return dense_number(new_members, order_by, name, start=int(current_max) + 1, dtype=dtype)
