"""Star-schema transform: valid lines -> 3 dimensions + 1 fact.

Shuffles (all on the cluster, nothing through the driver but counts):
* valid lines in ingest order: one range shuffle, written once; a line's
  place (a long) is its ordinal from there on, and numbers its sale_id;
* first row per product / customer: the first place of each distinct set of
  attributes (hash aggregate, map-side combined, so a product that owns a
  third of the lines costs few rows per map task), then the first of these;
* dense keys: range partition + checkpoint (``keys.dense_number``);
* fact lookups: dimensions broadcast when their measured row count allows,
  otherwise sort-merge joins with AQE skew splitting; only loads and reads
  that need the new fact compute it (an incremental load re-keys the lines).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_attributes, date_key
from ..functions.money import line_revenue, money_total
from ..schema import (
    DEFAULT_CATEGORY,
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_PRODUCT,
    FACT_SALES,
    QUARANTINE,
    RAW_COLUMNS,
    SCD_EPOCH,
    TableSpec,
)
from ..concurrent import run_together
from ..session import ensure_checkpoint_dir
from .classify import REASON, classify, quarantine_rows, valid_rows
from .joins import maybe_broadcast
from .keys import PLACE, Placed, dense_number, place


@dataclass(frozen=True)
class StarSchema:
    """The four warehouse tables plus the quarantined rows (all lazy)."""

    dim_product: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    # The fact, or how to make it when it is first asked for.
    fact: DataFrame | Callable[[], DataFrame]
    quarantine: DataFrame
    # Valid lines in ingest order (``_ord``: their places); incremental loads
    # re-key these straight against the stored dimensions.
    lines: DataFrame | None = None
    # Row counts already known from building (no extra job to ask again).
    known_rows: dict | None = None
    # Numbers ``lines`` by their places, if a load finds them all new.
    placed: Placed | None = None

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self.fact() if callable(self.fact) else self.fact

    def tables(self) -> dict[str, DataFrame]:
        """Warehouse tables only (no quarantine), dimensions first."""
        return {
            "dim_product": self.dim_product,
            "dim_customer": self.dim_customer,
            "dim_date": self.dim_date,
            "fact_sales": self.fact_sales,
        }

    def all_tables(self) -> dict[str, DataFrame]:
        out = self.tables()
        out["quarantine"] = self.quarantine
        return out

    def row_counts(self) -> DataFrame:
        """(table_name, row_count) for the 4 tables and quarantine."""
        frames = [
            df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
            .select(F.lit(name).alias("table_name"), "row_count")
            for name, df in self.all_tables().items()
        ]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def total_revenue(self) -> DataFrame:
        """Revenue of all fact lines; the valid lines of a fact not made yet have it without their keys."""
        if callable(self.fact):
            revenue = line_revenue(F.col("quantity"), F.col("unit_price"))
            return self.lines.agg(money_total(revenue).alias("total_revenue"))
        return self.fact_sales.agg(money_total(F.col("revenue")).alias("total_revenue"))


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns only, in declared order, cast to declared types."""
    return df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in spec.columns])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the cluster's shared
    checkpoint folder and continue from the written table.

    The write runs the upstream plan once; every later consumer is a
    columnar, pruned scan, and a lost executor resumes from the files.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestar-stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the staged files that ``frames`` read: tables of a step's own that nobody reads any more."""
    for df in frames:
        root = ensure_checkpoint_dir(df.sparkSession).rstrip("/").split(":", 1)[-1].lstrip("/")
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        conf = df.sparkSession._jsc.hadoopConfiguration()
        own = tuple(f"{root}/{name}" for name in ("lakestar-stage/", "numbered-", "merged-"))
        for folder in folders:
            if folder.split(":", 1)[-1].lstrip("/").startswith(own):
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def first_rows(valid: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Attributes of the first valid line (ingest order) per ``key`` value.

    A minimum over structs or texts sorts its input, so all lines only meet
    the minimum of a long, by key and attributes; what is sorted are the
    distinct attributes of a key.
    """
    first = F.min(F.struct(F.col("_ord"), *[F.col(a) for a in attrs])).alias("_first")
    return (
        valid.where(F.col(key).isNotNull())
        .groupBy(key, *attrs).agg(F.min("_ord").alias("_ord"))
        .groupBy(key)
        .agg(first)
        .select(key, *[F.col(f"_first.{a}").alias(a) for a in attrs])
    )


def build_dim_product(valid: DataFrame, categories: DataFrame | None):
    """The dimension, its rows, and whether a code comes twice (as it does in ``categories``)."""
    # Staged: numbering reads them twice, once to choose its ranges.
    firsts = stage(first_rows(valid, "stock_code", ["description", "unit_price"]), "products")
    n_codes = firsts.count()
    if categories is not None:
        cats = categories.select(
            F.col("stock_code").alias("_cat_code"), F.col("category").alias("_category"))
        firsts = firsts.join(cats, F.col("stock_code") == F.col("_cat_code"), "left")
        category = F.coalesce(F.col("_category"), F.lit(DEFAULT_CATEGORY))
    else:
        category = F.lit(DEFAULT_CATEGORY)
    firsts = firsts.select("stock_code", "description", category.alias("category"), "unit_price")
    numbered = dense_number(firsts, ["stock_code"], "product_key")
    return typed(numbered.df, DIM_PRODUCT), numbered.rows, numbered.rows > n_codes


def build_dim_customer(valid: DataFrame):
    firsts = stage(first_rows(valid, "customer_id", ["country"]), "customers")
    numbered = dense_number(firsts, ["customer_id"], "customer_key")
    dim = numbered.df.select(
        "customer_key",
        "customer_id",
        "country",
        F.lit(SCD_EPOCH).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    return typed(dim, DIM_CUSTOMER), numbered.rows


def build_dim_date(valid: DataFrame) -> DataFrame:
    days = valid.select(F.to_date("invoice_date").alias("date")).where(F.col("date").isNotNull()).distinct()
    attrs = date_attributes(F.col("date"))
    return typed(days.select(*[v.alias(k) for k, v in attrs.items()]), DIM_DATE)


def resolve_keys(valid: DataFrame, products: DataFrame, n_products: int,
                 customers: DataFrame, n_current_customers: int) -> DataFrame:
    """Fact lines with product_key (by stock_code) and the *current*
    customer_key (by customer_id); left joins, like the source."""
    prod = products.select(F.col("stock_code").alias("_p_code"), "product_key")
    cust = customers.where(F.col("is_current")).select(
        F.col("customer_id").alias("_c_id"), "customer_key")
    return (
        valid.join(maybe_broadcast(prod, n_products), F.col("stock_code") == F.col("_p_code"), "left")
        .join(maybe_broadcast(cust, n_current_customers), F.col("customer_id") == F.col("_c_id"), "left")
        .drop("_p_code", "_c_id")
    )


def fact_columns(lines: DataFrame, row: str = "_ord") -> DataFrame:
    """Fact measures of key-resolved lines (keeps ``row``, their ordinal or number)."""
    return lines.select(
        row,
        "product_key",
        "customer_key",
        date_key(F.col("invoice_date")).alias("date_key"),
        "invoice_no",
        "quantity",
        "unit_price",
        line_revenue(F.col("quantity"), F.col("unit_price")).alias("revenue"),
    )


def place_lines(valid: DataFrame) -> tuple[DataFrame, Placed]:
    """Valid lines in ingest order, staged with their places as ``_ord``, and
    the same as ``Placed``. Lines of one ordinal stand in the order in which
    ``first_rows`` prefers them."""
    placed = place(valid.select(*RAW_COLUMNS, "_ord"), ["_ord"], ("description", "unit_price", "country"), drop=("_ord",))
    return placed.df.withColumnRenamed(PLACE, "_ord"), placed


def build_fact(placed: Placed, dim_product: DataFrame, n_products: int,
               dim_customer: DataFrame, n_customers: int) -> DataFrame:
    """The fact, staged: a load reads it twice, once to choose its files' ranges."""
    keyed = resolve_keys(placed.numbered("sale_id"), dim_product, n_products, dim_customer, n_customers)
    return stage(typed(fact_columns(keyed, "sale_id"), FACT_SALES), "fact")


def build_repeated_fact(valid: DataFrame, dim_product: DataFrame, n_products: int,
                        dim_customer: DataFrame, n_customers: int):
    """The fact when a code has several products: a line comes once for each, numbered one by one."""
    keyed = fact_columns(resolve_keys(valid, dim_product, n_products, dim_customer, n_customers))
    numbered = dense_number(keyed, ["_ord"], "sale_id")
    return typed(numbered.df, FACT_SALES), numbered.rows


def quarantine_table(classified: DataFrame) -> DataFrame:
    q = quarantine_rows(classified).withColumn("invoice_date", F.to_date("invoice_date"))
    return typed(q, QUARANTINE)


def stage_bronze(bronze: DataFrame) -> DataFrame:
    """Bronze written once (the expensive text coercion runs once)."""
    return stage(bronze, "bronze")


def classify_staged(bronze: DataFrame) -> DataFrame:
    """Classified lines over bronze staged once as Parquet.

    Bronze (text coercion of every line) is the expensive projection; it is
    written once and the duplicate detection, quarantine, dimensions and
    fact all scan the staged copy. Classification itself is narrow work
    plus a join against the (small, measured) set of duplicated grains.
    """
    return classify(stage_bronze(bronze))


def build_star(bronze: DataFrame, categories: DataFrame | None = None, *,
               staged: bool = False) -> StarSchema:
    """Turn bronze lines (with ``_ord``) into a validated star schema.

    ``staged=True`` says ``bronze`` is already a cheap scan of written data
    (e.g. a batch carved out of staged bronze), so it is not written again.
    """
    classified = classify(bronze) if staged else classify_staged(bronze)
    return build_star_from_classified(classified, categories)


def build_star_from_classified(classified: DataFrame,
                               categories: DataFrame | None = None) -> StarSchema:
    valid = valid_rows(classified)
    lines, placed = place_lines(valid)
    # The dates are few, and a load reads them several times: staged, not
    # derived from all lines each time.
    (dim_product, n_products, repeated), (dim_customer, n_customers), dim_date = run_together(
        lambda: build_dim_product(lines, categories), lambda: build_dim_customer(lines),
        lambda: stage(build_dim_date(lines), "dates"))
    dims = (dim_product, n_products, dim_customer, n_customers)
    fact, n_fact = (build_repeated_fact(valid, *dims) if repeated else (lambda: build_fact(placed, *dims), placed.rows))
    return StarSchema(
        dim_product=dim_product,
        dim_customer=dim_customer,
        dim_date=dim_date,
        fact=fact,
        quarantine=quarantine_table(classified),
        lines=lines,
        known_rows={"dim_product": n_products, "dim_customer": n_customers, "fact_sales": n_fact},
        placed=placed,
    )


__all__ = ["StarSchema", "build_star", "build_star_from_classified", "classify_staged", "typed", "REASON"]
