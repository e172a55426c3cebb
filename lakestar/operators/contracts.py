"""Declared-constraint checks Spark's Parquet tables do not enforce.

Spark accepts NULL into a NOT NULL column and has no PK/UNIQUE/FK
enforcement on built-in tables, so loads run these before publishing:
C1 primary key / unique (+ at most one current version per customer),
C2 foreign keys (anti joins), C3 not null, C4 varchar lengths. Each
returns a DataFrame of (table_name, constraint_name, violations).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..schema import TableSpec, table
from .classify import duplicate_groups
from .joins import maybe_broadcast


def _row(df: DataFrame, table_name: str, constraint: str, violations) -> DataFrame:
    return df.select(F.lit(table_name).alias("table_name"), F.lit(constraint).alias("constraint_name"),
                     violations.cast("bigint").alias("violations"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def unique_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows beyond the first per primary key and per UNIQUE key.

    Grouping is map-side combined, so a key repeated a million times is
    pre-counted inside each task before the shuffle. Keys of several columns
    are counted by a hash first; usually no hash comes twice.
    """
    keys = []
    if spec.primary_key:
        keys.append(("pk", spec.primary_key))
    keys.extend(("unique", u) for u in spec.unique)
    frames = []
    for kind, cols in keys:
        per_key = (duplicate_groups(df, cols)[0] if len(cols) > 1
                   else df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")))
        frames.append(_row(per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_v")),
                           spec.name, f"{kind}({','.join(cols)})", F.col("_v")))
    if spec.name == "dim_customer":
        per_cust = df.where(F.col("is_current")).groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
        frames.append(_row(per_cust.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_v")),
                           spec.name, "one_current(customer_id)", F.col("_v")))
    return _union(frames)


def not_null_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Null count per NOT NULL column, all in one aggregate pass."""
    cols = [c.name for c in spec.columns if not c.nullable]
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    cells = F.array(*[F.struct(F.lit(f"not_null({c})").alias("k"), F.col(c).alias("v")) for c in cols])
    return agg.select(F.inline(cells)).select(
        F.lit(spec.name).alias("table_name"), F.col("k").alias("constraint_name"),
        F.col("v").cast("bigint").alias("violations"))


def length_violations(df: DataFrame, spec: TableSpec) -> DataFrame | None:
    """C4: values longer than VARCHAR(n), one aggregate pass."""
    cols = [c for c in spec.columns if c.max_length and isinstance(c.dtype, StringType)]
    if not cols:
        return None
    agg = df.agg(*[F.count_if(F.char_length(c.name) > c.max_length).alias(c.name) for c in cols])
    cells = F.array(*[F.struct(F.lit(f"max_length({c.name},{c.max_length})").alias("k"),
                               F.col(c.name).alias("v")) for c in cols])
    return agg.select(F.inline(cells)).select(
        F.lit(spec.name).alias("table_name"), F.col("k").alias("constraint_name"),
        F.col("v").cast("bigint").alias("violations"))


def orphan_counts(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose FK has no dimension row, per FK.

    One pass over the fact: each dimension's key set is left-joined
    (broadcast when its measured size allows) and misses are counted in a
    single aggregate. Null FKs count as orphans.
    """
    spec = table("fact_sales")
    joined = fact
    misses = []
    for fk, (dim_name, dim_key) in spec.foreign_keys.items():
        keys = dims[dim_name].select(F.col(dim_key).alias(f"_k_{fk}")).distinct()
        keys = keys.withColumn(f"_hit_{fk}", F.lit(True))
        joined = joined.join(maybe_broadcast(keys), F.col(fk) == F.col(f"_k_{fk}"), "left")
        misses.append((fk, dim_name, F.count_if(F.col(f"_hit_{fk}").isNull()).alias(fk)))
    agg = joined.agg(*[m[2] for m in misses])
    cells = F.array(*[F.struct(F.lit(fk).alias("fk"), F.lit(d).alias("dim"), F.col(fk).alias("v"))
                      for fk, d, _ in misses])
    return agg.select(F.inline(cells)).select(
        F.col("fk").alias("foreign_key"), F.col("dim").alias("dimension"),
        F.col("v").cast("bigint").alias("orphans"))


def scalar_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """C3 + C4 of one table fused into a single aggregate pass."""
    checks = [(f"not_null({c.name})", F.col(c.name).isNull()) for c in spec.columns if not c.nullable]
    checks += [(f"max_length({c.name},{c.max_length})", F.char_length(c.name) > c.max_length)
               for c in spec.columns if c.max_length and isinstance(c.dtype, StringType)]
    agg = df.agg(*[F.count_if(cond).alias(f"_v{i}") for i, (_, cond) in enumerate(checks)])
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_v{i}").alias("v"))
                      for i, (k, _) in enumerate(checks)])
    return agg.select(F.inline(cells)).select(
        F.lit(spec.name).alias("table_name"), F.col("k").alias("constraint_name"),
        F.col("v").cast("bigint").alias("violations"))


def table_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """C1 + C3 + C4 for every given table, plus C2 when the star is whole."""
    frames = []
    for name, df in tables.items():
        spec = table(name)
        if spec.primary_key or spec.unique:
            frames.append(unique_violations(df, spec))
        frames.append(scalar_violations(df, spec))
    if all(n in tables for n in ("fact_sales", "dim_product", "dim_customer", "dim_date")):
        orphans = orphan_counts(tables["fact_sales"], tables)
        frames.append(orphans.select(
            F.lit("fact_sales").alias("table_name"),
            F.concat(F.lit("fk("), F.col("foreign_key"), F.lit("->"), F.col("dimension"), F.lit(")"))
            .alias("constraint_name"),
            F.col("orphans").alias("violations")))
    return _union(frames)


class ContractViolation(RuntimeError):
    """Raised when a load would break a declared constraint."""


def enforce(tables: dict[str, DataFrame]) -> list:
    """Raise ``ContractViolation`` listing every violated constraint."""
    rows = table_violations(tables).collect()  # a few rows per table
    bad = [r for r in rows if r.violations > 0]
    if bad:
        detail = ", ".join(f"{r.table_name}.{r.constraint_name}={r.violations}" for r in bad)
        raise ContractViolation(f"constraint violation(s): {detail}")
    return rows
