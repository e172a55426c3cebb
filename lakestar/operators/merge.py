"""Join-based upsert and Type-2 history (no row loops, no MERGE statement).

Plain Parquet has no UPDATE; each operation computes the table's next
contents as a DataFrame (stored rows with updates applied, plus inserted
rows) which the warehouse writes as a new version. All joins here are
dimension-sized or restricted to the affected fact months.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SCD_EPOCH
from ..session import ensure_checkpoint_dir
from .cache import hold
from .joins import maybe_broadcast
from .keys import continue_numbering


def max_key(df: DataFrame, key: str) -> int:
    """Largest surrogate (0 for an empty table) -- a single scalar."""
    value = df.agg(F.max(key)).first()[0]
    return int(value) if value is not None else 0


def upsert(stored: DataFrame, incoming: DataFrame, natural_key: list[str],
           surrogate: str | None = None, columns: list[str] | None = None,
           incoming_rows: int | None = None, current_max: int | None = None):
    """Insert-or-update on ``natural_key``.

    Matched rows take every supplied non-key, non-surrogate column from
    ``incoming`` and keep their surrogate; unmatched incoming rows are
    inserted, numbered max+1.. in natural-key order. ``incoming`` must be
    unique on the natural key (dimensions are). Returns (next table
    contents, inserted count, updated count); ``incoming_rows``, when known,
    saves counting.
    """
    columns = columns or stored.columns
    supplied = [c for c in incoming.columns if c in columns and c not in natural_key and c != surrogate]
    inc = incoming.select(*natural_key, *[F.col(c).alias(f"_in_{c}") for c in supplied],
                          F.lit(True).alias("_hit"))
    updated = stored.join(inc, natural_key, "left").select(
        *[F.when(F.col("_hit"), F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c) if c in supplied
          else F.col(c) for c in columns],
        F.coalesce(F.col("_hit"), F.lit(False)).alias("_hit"),
    )
    new = incoming.join(stored.select(*natural_key), natural_key, "left_anti")
    updated = updated.drop("_hit")
    if surrogate is not None:
        top = max_key(stored, surrogate) if current_max is None else current_max
        numbered = continue_numbering(new, list(natural_key), surrogate, top)
        new_rows, n_new = numbered.df, numbered.rows
    else:
        new_rows, n_new = new, new.count()
    n_in = incoming.count() if incoming_rows is None else incoming_rows
    n_updated = n_in - n_new
    new_rows = new_rows.select(*[F.col(c) if c in new_rows.columns else F.lit(None).alias(c)
                                 for c in columns])
    return updated.unionByName(new_rows), n_new, n_updated


def scd2_decisions(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per customer in the batch or currently stored:
    (customer_id, action, customer_key, old_country, new_country) with
    action new | changed | unchanged | absent."""
    current = stored.where(F.col("is_current")).select(
        "customer_id", "customer_key", F.col("country").alias("old_country"))
    inc = incoming.select("customer_id", F.col("country").alias("new_country"), F.lit(True).alias("_in"))
    j = current.join(inc, "customer_id", "full_outer")
    action = (
        F.when(F.col("_in").isNull(), F.lit("absent"))
        .when(F.col("customer_key").isNull(), F.lit("new"))
        .when(~F.col("old_country").eqNullSafe(F.col("new_country")), F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    return j.select("customer_id", action.alias("action"), "customer_key", "old_country", "new_country")


def apply_scd2(stored: DataFrame, incoming: DataFrame, run_date: dt.date,
               current_max: int | None = None):
    """Type-2 history on (customer_id -> country).

    New customer: open a version at the epoch. Changed country: close the
    current version (effective_to = run_date, not current) and open a new
    one from run_date. Unchanged or absent: untouched. New versions get
    keys max+1.. in customer_id order. Returns (next contents, decisions,
    number of versions opened).
    """
    decisions = scd2_decisions(stored, incoming)
    changes = hold(decisions.where(F.col("action").isin("new", "changed")))
    to_close = changes.where(F.col("action") == "changed").select(
        F.col("customer_key").alias("_close_key"))
    n_changes = changes.count()
    run_day = F.lit(run_date).cast("date")
    closed = stored.join(maybe_broadcast(to_close, n_changes),
                         F.col("customer_key") == F.col("_close_key"), "left")
    hit = F.col("_close_key").isNotNull()
    kept = closed.select(
        "customer_key", "customer_id", "country", "effective_from",
        F.when(hit, run_day).otherwise(F.col("effective_to")).alias("effective_to"),
        F.when(hit, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
    )
    opened = changes.select(
        "customer_id",
        F.col("new_country").alias("country"),
        F.when(F.col("action") == "new", F.lit(SCD_EPOCH)).otherwise(run_day).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    top = max_key(stored, "customer_key") if current_max is None else current_max
    numbered = continue_numbering(opened, ["customer_id"], "customer_key", top)
    result = kept.unionByName(numbered.df.select(*kept.columns))
    return result, decisions, n_changes


def overwrite_current(stored: DataFrame, incoming: DataFrame, current_max: int | None = None):
    """Append-mode customers: Type-1 update of the *current* version's
    country (history stays closed), new customers open at the epoch."""
    inc = incoming.select("customer_id", F.col("country").alias("_in_country"), F.lit(True).alias("_hit"))
    j = stored.join(inc, "customer_id", "left")
    hit = F.col("_hit").isNotNull() & F.col("is_current")
    updated = j.select(
        "customer_key", "customer_id",
        F.when(hit, F.col("_in_country")).otherwise(F.col("country")).alias("country"),
        "effective_from", "effective_to", "is_current",
    )
    new = incoming.join(stored.select("customer_id"), "customer_id", "left_anti").select(
        "customer_id", "country",
        F.lit(SCD_EPOCH).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    top = max_key(stored, "customer_key") if current_max is None else current_max
    numbered = continue_numbering(new, ["customer_id"], "customer_key", top)
    return updated.unionByName(numbered.df.select(*updated.columns)), numbered.rows


def merge_facts(stored: DataFrame, batch: DataFrame, natural_key: list[str], max_sale_id: int,
                batch_rows: int | None = None):
    """Upsert fact lines on the natural key within the files that can hold them.

    Matched stored rows keep sale_id and take the batch's customer_key,
    quantity, unit_price and revenue (re-pointing re-seen lines at the
    current customer version). New lines get sale_id max+1.. in ingest
    order. Returns (next contents of those files, inserted, updated).

    One full outer join, written once: the stored rows are read a single
    time, and only the new lines are opened again to be numbered.
    """
    measures = ["customer_key", "quantity", "unit_price", "revenue"]
    cols = ["sale_id", "product_key", "customer_key", "date_key", "invoice_no", "quantity", "unit_price", "revenue"]
    b = batch.select(*natural_key, "_ord", *[F.col(c).alias(f"_b_{c}") for c in measures], F.lit(True).alias("_hit"))
    joined = stored.join(b, natural_key, "full_outer").select(
        *[F.when(F.col("_hit"), F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) if c in measures else F.col(c) for c in cols],
        "_ord", F.col("sale_id").isNull().alias("_new"))
    spark = batch.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/merged-{uuid.uuid4().hex}"
    joined.write.parquet(path)  # not by _new: that would sort every task's rows once more
    merged = spark.read.schema(joined.schema).parquet(path)
    numbered = continue_numbering(merged.where("_new").drop("_new", "sale_id"), ["_ord"], "sale_id", max_sale_id)
    # The batch is unique on the natural key: every line either matched or is new.
    n_updated = (batch.count() if batch_rows is None else batch_rows) - numbered.rows
    return (merged.where("not _new").select(*cols).unionByName(numbered.df.select(*cols)), numbered.rows, n_updated)
