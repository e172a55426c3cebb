"""Load modes: replace | append (watermark) | merge (upsert + SCD-2).

Every mode writes changed tables as a new warehouse version, validates
what was written (declared contracts), then publishes the manifest -- the
whole load becomes visible at once or not at all. Incremental modes touch
only what changed: dimensions (dimension-sized joins) and, for the fact,
new rows (append) or the files that can hold a line of the batch (merge).

A load that finds its version taken when it publishes was overtaken by
another one. A replace doesn't depend on what was stored, so it publishes as
the next version; an incremental load is computed again from the version
that won.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_key
from ..operators import contracts
from ..operators.keys import Numbered, continue_numbering
from ..operators.merge import apply_scd2, max_key, merge_facts, overwrite_current, upsert
from ..operators.star import StarSchema, discard, fact_columns, resolve_keys, stage, typed
from ..schema import FACT_SALES, LOAD_MODES, PIPELINE_RUNS, TABLES
from ..concurrent import run_together
from .warehouse import Conflict, Entry, Warehouse


@dataclass
class LoadResult:
    version: int
    mode: str
    # Rows handed to each table (upserts: rows submitted; SCD-2: versions
    # opened), the figure the run history records.
    rows_written: dict[str, int] = field(default_factory=dict)
    inserted: dict[str, int] = field(default_factory=dict)
    updated: dict[str, int] = field(default_factory=dict)
    # Fact lines at or before the watermark that append mode skipped.
    late_rows_skipped: int = 0
    watermark: int = 0
    scd2_decisions: DataFrame | None = None
    # Violations found in what the load wrote (all 0, or it isn't published).
    contract_rows: list = field(default_factory=list)
    # Fact files that the load read and replaced, of how many.
    files_read: int = 0
    files_before: int = 0
    attempts: int = 1


# Makes the run-history record of a load that is about to be published.
Recorder = Callable[[LoadResult], DataFrame]


class UnresolvedKeys(RuntimeError):
    """Fact lines whose business key has no live dimension row."""


def check_mode(mode: str) -> None:
    if mode not in LOAD_MODES:
        raise ValueError(f"Unknown load mode {mode!r}; expected one of {LOAD_MODES}")


def watermark_frame(wh: Warehouse, entries: list[Entry] | None = None) -> DataFrame:
    """One row: highest stored fact date_key, 0 if none. Reads only the
    latest month's files (the manifest knows which months exist)."""
    entries = wh.entries() if entries is None else entries
    months = wh.fact_months(entries)
    latest = wh.read(FACT_SALES.name, entries, months={months[-1]} if months else set())
    return latest.agg(F.coalesce(F.max("date_key"), F.lit(0)).cast("int").alias("watermark"))


def watermark(wh: Warehouse, entries: list[Entry] | None = None) -> int:
    return int(watermark_frame(wh, entries).first()[0])


def rekey(lines: DataFrame, dim_product: DataFrame, dim_customer: DataFrame,
          with_count: bool = False, product_rows: int | None = None,
          customer_rows: int | None = None):
    """Fact lines keyed against the *stored* dimensions (keeps ``_ord``).

    Fails loudly when a product or customer does not resolve: loading such
    a line would break referential integrity. The lines are staged as
    Parquet, not cached: a load reads them several times, and blocks of a
    whole batch would take the memory that its joins and sorts need.
    Dimension sizes (for the broadcast decision) come from the manifest when
    known; the customer bound counts all versions, an upper bound of the
    current ones.
    """
    n_prod = dim_product.count() if product_rows is None else product_rows
    n_cust = dim_customer.where(F.col("is_current")).count() if customer_rows is None else customer_rows
    out = stage(fact_columns(resolve_keys(lines, dim_product, n_prod, dim_customer, n_cust)), "rekeyed")
    stats = out.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(F.col("product_key").isNull() | F.col("customer_key").isNull()).alias("bad")).first()
    if stats["bad"]:
        raise UnresolvedKeys("Fact rows could not be re-keyed to live dimensions "
                             "(unresolved product/customer business key)")
    return (out, int(stats["n"])) if with_count else out


def _validate(wh: Warehouse, entries: list[Entry]) -> list:
    """Contracts over what was just written (read back from storage)."""
    names = sorted({e.table_name for e in entries})
    return contracts.enforce({n: wh.read(n, entries) for n in names})


def _publish(wh: Warehouse, result: LoadResult, entries: list[Entry], base: list[Entry],
             record: Recorder | None, run_id: str | None) -> None:
    """Publish the load, with its run record if there is one."""
    entries = entries + [e for e in base if e.table_name == PIPELINE_RUNS.name]
    if record is not None:
        entries = wh.with_run(entries, record(result), result.version, run_id)
    wh.publish(result.version, entries, result.mode, run_id)


def _write(wh: Warehouse, name: str, df: DataFrame, version: int, rows=None, max_key=None) -> list[Entry]:
    return wh.write(name, typed(df, TABLES[name]), version, rows=rows, max_key=max_key)


def _count_written(wh: Warehouse, entries: list[Entry]) -> list[Entry]:
    """Fill in the row count of freshly written single-file-set tables
    (a Parquet footer count)."""
    out = []
    for e in entries:
        if e.row_count is None and e.month_key is None:
            n = wh.read(e.table_name, [e]).count()
            e = replace(e, row_count=n)
        out.append(e)
    return out


def load_replace(wh: Warehouse, star: StarSchema, record: Recorder | None = None,
                 run_id: str | None = None) -> LoadResult:
    version = wh.version() + 1
    known = star.known_rows or {}
    # Dense keys 1..N: the largest key equals the row count.
    n_prod, n_cust = (known.get(k) for k in ("dim_product", "dim_customer"))
    written = run_together(
        lambda: _write(wh, "dim_product", star.dim_product, version, n_prod, n_prod),
        lambda: _write(wh, "dim_customer", star.dim_customer, version, n_cust, n_cust),
        lambda: _write(wh, "dim_date", star.dim_date, version),
        lambda: _write(wh, "fact_sales", star.fact_sales, version),
        lambda: _write(wh, "quarantine", star.quarantine, version),
    )
    entries = _count_written(wh, [e for part in written for e in part])
    result = LoadResult(version, "replace", contract_rows=_validate(wh, entries))
    counts = {n: wh.stats(n, entries)[0] for n in star.all_tables()}
    result.rows_written, result.inserted = counts, dict(counts)
    while True:
        base = wh.version()
        result.version = base + 1
        try:
            _publish(wh, result, entries, wh.entries(base), record, run_id)
            return result
        except Conflict:
            result.attempts += 1


def _known_or_scan(wh: Warehouse, name: str, entries: list[Entry], key: str) -> tuple[int | None, int]:
    rows, top = wh.stats(name, entries)
    if top is None:
        top = max_key(wh.read(name, entries), key)
    return rows, top


def files_hit(wh: Warehouse, lines: DataFrame, entries: list[Entry]) -> list[Entry]:
    """The fact files whose range of invoice numbers holds a line's, in its month.

    One sorted pass over the batch's invoices and the files' lower ends: the
    next invoice of the month from there up must not lie beyond the file's
    upper end. Only the batch's own keys are shuffled.
    """
    mine = [e for e in entries if e.table_name == FACT_SALES.name]
    if not mine:
        return []
    files = wh.spark.createDataFrame([(i, e.month_key, e.low, e.high) for i, e in enumerate(mine)],
                                     "file int, m int, invoice string, high string")
    keys = lines.select(month_key(F.col("date_key")).alias("m"), F.col("invoice_no").alias("invoice")).distinct()
    both = keys.select(F.lit(None).cast("int").alias("file"), "m", "invoice", F.lit(None).cast("string").alias("high")).union(files)
    downwards = Window.partitionBy("m").orderBy(F.desc("invoice"), F.asc_nulls_first("file"))
    following = F.last(F.when(F.col("file").isNull(), F.col("invoice")), ignorenulls=True).over(downwards)
    hit = (both.withColumn("next", following).where(F.col("file").isNotNull() & (F.col("next") <= F.col("high")))
           .select("file").collect())  # one row a file that is rewritten
    return [mine[i] for i in sorted(r["file"] for r in hit)]


def number_all_new(star: StarSchema, lines: DataFrame, n_lines: int, f_max: int) -> Numbered | None:
    """Lines of a batch of which none is stored, numbered f_max+1, ... by their places: no join, no shuffle.

    None if a line comes more than once (by a repeated product): then its place isn't its own.
    """
    if star.placed is None or star.placed.rows != n_lines:
        return None
    return Numbered(star.placed.number(lines, "_ord", "sale_id", f_max + 1), n_lines)


def load_incremental(wh: Warehouse, star: StarSchema, mode: str, run_date: dt.date,
                     record: Recorder | None = None, run_id: str | None = None) -> LoadResult:
    if star.lines is None:
        raise ValueError("incremental loads need the star's valid lines")
    version = wh.version() + 1
    old = wh.entries(version - 1)
    result = LoadResult(version, mode)
    known = star.known_rows or {}
    stored = {n: wh.read(n, old) for n in ("dim_product", "dim_customer", "dim_date")}
    p_rows, p_max = _known_or_scan(wh, "dim_product", old, "product_key")
    c_rows, c_max = _known_or_scan(wh, "dim_customer", old, "customer_key")
    d_rows, _ = wh.stats("dim_date", old)
    _, f_max = _known_or_scan(wh, FACT_SALES.name, old, "sale_id")

    # Dimensions: upsert products and dates; customers by SCD-2 (merge) or
    # a Type-1 update of the current version (append).
    products, p_new, p_upd = upsert(stored["dim_product"], star.dim_product.drop("product_key"),
                                    ["stock_code"], "product_key",
                                    incoming_rows=known.get("dim_product"), current_max=p_max)
    dates, d_new, d_upd = upsert(stored["dim_date"], star.dim_date, ["date_key"])
    cust_in = star.dim_customer.select("customer_id", "country")
    if mode == "merge":
        customers, decisions, c_new = apply_scd2(stored["dim_customer"], cust_in, run_date, current_max=c_max)
        result.scd2_decisions = decisions
        result.rows_written["dim_customer"] = c_new
    else:
        customers, c_new = overwrite_current(stored["dim_customer"], cust_in, current_max=c_max)
        result.rows_written["dim_customer"] = known.get("dim_customer") or star.dim_customer.count()
    result.inserted["dim_customer"] = c_new
    result.rows_written["dim_product"] = p_new + p_upd
    result.inserted["dim_product"], result.updated["dim_product"] = p_new, p_upd
    result.rows_written["dim_date"] = d_new + d_upd
    result.inserted["dim_date"], result.updated["dim_date"] = d_new, d_upd

    plus = lambda a, b: None if a is None else a + b
    written = run_together(
        lambda: _write(wh, "dim_product", products, version, plus(p_rows, p_new), p_max + p_new),
        lambda: _write(wh, "dim_customer", customers, version, plus(c_rows, c_new), c_max + c_new),
        lambda: _write(wh, "dim_date", dates, version, plus(d_rows, d_new)),
    )
    entries = _count_written(wh, [e for part in written for e in part])
    live = {n: wh.read(n, entries) for n in ("dim_product", "dim_customer")}
    lines, n_lines = rekey(star.lines, live["dim_product"], live["dim_customer"], with_count=True,
                           product_rows=plus(p_rows, p_new), customer_rows=plus(c_rows, c_new))

    kept_fact = [e for e in old if e.table_name == FACT_SALES.name]
    if mode == "append":
        mark = watermark(wh, old)
        result.watermark = mark
        fresh = lines.where(F.col("date_key") > mark)
        # Into an empty fact all lines go (no date_key is below 1).
        numbered = None if kept_fact else number_all_new(star, lines, n_lines, f_max)
        numbered = numbered or continue_numbering(fresh, ["_ord"], "sale_id", f_max)
        result.late_rows_skipped = n_lines - numbered.rows
        new_fact = _write(wh, FACT_SALES.name, numbered.df, version)
        discard(numbered.df, lines)
        fact_entries = kept_fact + new_fact
        result.rows_written["fact_sales"] = numbered.rows
        result.inserted["fact_sales"] = numbered.rows
    else:
        hit = files_hit(wh, lines, kept_fact)
        result.files_read, result.files_before = len(hit), len(kept_fact)
        numbered = None if hit else number_all_new(star, lines, n_lines, f_max)
        if numbered:
            merged, n_new, n_upd = numbered.df, numbered.rows, 0
        else:
            merged, n_new, n_upd = merge_facts(wh.read(FACT_SALES.name, hit), lines, list(FACT_SALES.natural_key), f_max,
                                               batch_rows=n_lines)
            discard(lines)  # they are in ``merged``, which is written
        new_fact = _write(wh, FACT_SALES.name, merged, version)
        discard(merged)
        replaced = {e.path for e in hit}
        fact_entries = [e for e in kept_fact if e.path not in replaced] + new_fact
        result.rows_written["fact_sales"] = n_new + n_upd
        result.inserted["fact_sales"], result.updated["fact_sales"] = n_new, n_upd

    q_entries = _count_written(wh, _write(wh, "quarantine", star.quarantine, version))
    result.rows_written["quarantine"] = q_entries[0].row_count

    # Validate dimensions whole, of the fact what this load wrote: new
    # sale_ids are above every stored id, and a stored line of equal natural
    # key would lie in a file that was rewritten.
    result.contract_rows = _validate(wh, entries + new_fact + q_entries)
    _publish(wh, result, entries + fact_entries + q_entries, old, record, run_id)
    return result


def load_star(wh: Warehouse, star: StarSchema, mode: str = "replace",
              run_date: dt.date | None = None, record: Recorder | None = None,
              run_id: str | None = None, retries: int = 20) -> LoadResult:
    """Write the star with the given mode; raises ValueError on a bad mode.

    With ``record`` and ``run_id`` the run's record is part of the commit.
    An incremental load that was overtaken is computed again from the new
    version, ``retries`` times at most (then ``Conflict`` is raised).
    """
    check_mode(mode)
    if mode == "replace":
        return load_replace(wh, star, record, run_id)
    run_date = run_date or dt.datetime.now(dt.timezone.utc).date()
    for attempt in range(retries):
        try:
            result = load_incremental(wh, star, mode, run_date, record, run_id)
            result.attempts = attempt + 1
            return result
        except Conflict:
            if attempt + 1 == retries:
                raise
    raise ValueError("retries must be at least 1")
