"""Shared helpers: tables in the shared folder, hash buckets, exact ranks."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import SHUFFLE_CLEANUP, ensure_checkpoint_dir


PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def open_fs(uri: str):
    """(filesystem, path) of a folder; ``file:/x`` as Hadoop prints it, too."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, once an application.

    The sources go to the shared folder and from there to the workers, as
    with ``--py-files``; an installed package does no harm.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    folder = f"{ensure_checkpoint_dir(spark)}/package"
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{PACKAGE.name}.zip") as out:
        out.write(packed.getvalue())
    sc.addPyFile(f"{folder}/{PACKAGE.name}.zip")
    _shipped.add(sc.applicationId)


class Scratch:
    """Tables of one operator run, in the folder that all executors share.

    ``keep`` writes a table as Parquet and reads it back: later steps start
    from files, so a lost executor costs no recomputation of earlier ones,
    and Spark knows the table's size when it chooses a join. ``drop`` frees
    tables that no later step reads. Shuffle files go when a table is written
    (unless the caller chose otherwise), not when the driver collects garbage.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        if spark.conf.get(SHUFFLE_CLEANUP, None) is None:
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def seeded(seed: int, *cols) -> Column:
    """A 32-bit seeded hash in a long: uniform over [0, 2**32)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 32)


def seeded_md5(seed: int, *cols) -> Column:
    """A 32-bit seeded hash in a long, of md5 over the values' text: any SQL
    engine computes the same (null values count as absent)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *cols)), 1, 8), 16, 10).cast("long")


def bucket_of(hash32: Column, buckets: Column) -> Column:
    """Order-preserving bucket of a 32-bit hash among ``buckets`` (< 2**31)."""
    return F.shiftrightunsigned(hash32 * buckets, 32)


def group_key(col: Column) -> Column:
    """A column as a join key that keeps null apart from every value."""
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), col.cast("string")))


def exact_rank(df: DataFrame, group: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the row's 0-based place in its group's order.

    ``bucket`` rises with the order and holds a bounded number of rows, so
    the rows are sorted bucket by bucket; only the bucket counts, one row a
    bucket, meet in a running sum. No group of rows meets in one task.
    """
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*group, bucket, F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order))
    return (df.join(before, [*group, bucket])
            .withColumn(name, F.col("_before") + place - 1).drop("_before"))


def doubles(col: str) -> Column:
    return F.transform(F.col(col), lambda x: x.cast("double"))
