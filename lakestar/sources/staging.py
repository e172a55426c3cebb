"""Bronze hand-off between job steps, and star exports.

Steps that run as separate jobs exchange data through a written table in
shared storage (never a driver-side object): the bronze frame is staged
as Parquet keyed by run id, and read back by the next step. A CSV variant
exists for consumers without Parquet; on read-back its typed columns are
re-parsed from text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BRONZE_SCHEMA, STAR_TABLES, TableSpec

_ORD_NAME = "_ord"


def write_bronze(bronze: DataFrame, path: str, fmt: str = "parquet") -> str:
    cols = [f.name for f in BRONZE_SCHEMA.fields] + ([_ORD_NAME] if _ORD_NAME in bronze.columns else [])
    df = bronze.select(*cols)
    if fmt == "parquet":
        df.write.mode("errorifexists").parquet(path)
    elif fmt == "csv":
        # CSV cannot hold a struct ordinal: flatten it to JSON text.
        if _ORD_NAME in df.columns:
            df = df.withColumn(_ORD_NAME, F.to_json(F.col(_ORD_NAME)))
        df.write.mode("errorifexists").option("header", True).csv(path)
    else:
        raise ValueError(f"unknown staging format {fmt!r}")
    return path


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet", ord_schema=None) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    text = spark.read.option("header", True).csv(path)  # every column as text
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields]
    if _ORD_NAME in text.columns and ord_schema is not None:
        cols.append(F.from_json(F.col(_ORD_NAME), ord_schema).alias(_ORD_NAME))
    return text.select(*cols)


def export_star(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each warehouse table to ``out_dir/<name>.<fmt>``; returns paths."""
    out = {}
    for spec in STAR_TABLES:
        path = f"{out_dir.rstrip('/')}/{spec.name}.{fmt}"
        df = tables[spec.name].select(*spec.column_names)
        if fmt == "parquet":
            df.write.mode("overwrite").parquet(path)
        elif fmt == "csv":
            df.write.mode("overwrite").option("header", True).csv(path)
        else:
            raise ValueError(f"unknown export format {fmt!r}")
        out[spec.name] = path
    return out


def read_export(spark: SparkSession, path: str, spec: TableSpec, fmt: str = "parquet") -> DataFrame:
    if fmt == "parquet":
        df = spark.read.schema(spec.schema).parquet(path)
    else:
        df = spark.read.option("header", True).csv(path)
    return df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in spec.columns])
