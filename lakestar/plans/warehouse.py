"""Versioned Parquet warehouse: commits are manifests, published by compare-and-swap.

Layout under ``root`` (any Hadoop-compatible path)::

    _manifest/v0000000007.json         one commit: a line for it, a line for each entry
    <table>/v7-<attempt>/...           parquet written by one attempt at version 7
    fact_sales/v7-<attempt>/month_key=YYYYMM/  fact by month, files in ranges of invoice_no

A load writes every changed table to directories of its own attempt,
validates the written data (contracts) and then publishes the next manifest,
which names them. The manifest file is created only if it is absent
(``commit.py``), so of two loads that started from the same version one
publishes; the other gets ``Conflict`` and is run again from the version that
won (``loads.load_star``). Readers resolve tables through the latest
manifest: a failed, half-written or beaten load is never visible.

The entries carry what was measured when their files were written and read
back: rows, the largest surrogate key and, for each fact file, its revenue
and its range of invoice numbers. Reconciliation adds these up instead of
reading the fact, and a merge opens only files whose range holds a line of
the batch. Unchanged entries go from version to version.

The run history is a table of the manifest like any other. A run's record is
published in the commit of its load, so both exist or neither, and a run id
that has been committed is refused (``DuplicateRun``).
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import asdict, dataclass, replace
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.calendar import month_key
from ..schema import FACT_SALES, PIPELINE_RUNS, SUM_MONEY, TableSpec, table
from .commit import create_if_absent, delete, listed

MANIFEST_DIR = "_manifest"
RUN_FILES = 20  # files of the run history in a manifest before they become one
_VERSION_FILE = re.compile(r"^v(\d{10})\.json$")


class Conflict(RuntimeError):
    """Another load has published this version."""


class DuplicateRun(RuntimeError):
    """A run of this id has been committed."""


@dataclass(frozen=True)
class Entry:
    """Files of a table: a directory or, for the fact, one file."""

    table_name: str
    month_key: int | None
    path: str
    row_count: int | None = None
    max_key: int | None = None
    revenue: str | None = None  # decimal text
    low: str | None = None  # least and largest invoice_no of a fact file
    high: str | None = None

    def measure(self) -> tuple[int, Decimal]:
        return self.row_count or 0, Decimal(self.revenue or "0")


@dataclass(frozen=True)
class Commit:
    version: int
    mode: str | None = None
    run_id: str | None = None


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._manifests: dict[int, tuple[Commit, list[Entry]]] = {}

    # -- manifest ---------------------------------------------------------
    def versions(self) -> list[int]:
        """Published versions (a listing, no job)."""
        names = (name for name, _, _ in listed(self.spark, f"{self.root}/{MANIFEST_DIR}"))
        return sorted(int(m.group(1)) for n in names if (m := _VERSION_FILE.match(n)))

    def version(self) -> int:
        """Latest published version; 0 for an empty warehouse."""
        return max(self.versions(), default=0)

    def _manifest(self, version: int) -> tuple[Commit, list[Entry]]:
        """A published manifest never changes, so it is read once."""
        if version not in self._manifests:
            path = f"{self.root}/{MANIFEST_DIR}/v{version:010d}.json"
            lines = [json.loads(r[0]) for r in self.spark.read.text(path).collect()]
            head = next(x for x in lines if "version" in x)
            self._manifests[version] = (Commit(**head), [Entry(**{"month_key": None, **x}) for x in lines if "path" in x])
        return self._manifests[version]

    def entries(self, version: int | None = None) -> list[Entry]:
        """Manifest rows of a version (default: the latest)."""
        v = self.version() if version is None else version
        return list(self._manifest(v)[1]) if v else []

    def commit(self, version: int) -> Commit:
        return self._manifest(version)[0]

    def publish(self, version: int, entries: list[Entry], mode: str | None = None, run_id: str | None = None) -> None:
        """Make ``entries`` version ``version``, or raise ``Conflict`` if it exists."""
        lines = [asdict(Commit(version, mode, run_id)), *map(asdict, entries)]
        text = "\n".join(json.dumps({k: v for k, v in x.items() if v is not None}) for x in lines)
        if not create_if_absent(self.spark, f"{self.root}/{MANIFEST_DIR}", f"v{version:010d}.json", text):
            raise Conflict(f"version {version} was published by another load")

    # -- tables -----------------------------------------------------------
    def empty(self, spec: TableSpec) -> DataFrame:
        return self.spark.createDataFrame([], spec.schema)

    def read(self, name: str, entries: list[Entry] | None = None,
             months: set[int] | None = None) -> DataFrame:
        """Current contents of ``name`` (typed; empty if never loaded).

        For the fact, ``months`` restricts the scan to those months' files
        (pruning by manifest, before any file is opened).
        """
        spec = table(name)
        entries = self.entries() if entries is None else entries
        paths = [e.path for e in entries if e.table_name == name
                 and (months is None or e.month_key in months)]
        if not paths:
            return self.empty(spec)
        df = self.spark.read.schema(spec.schema).parquet(*paths)
        return df.select(*[F.col(c.name).cast(c.dtype) for c in spec.columns])

    def star(self, entries: list[Entry] | None = None):
        """The published tables as a StarSchema, with the manifest's row
        counts as known sizes (broadcast decisions need no count job)."""
        from ..operators.star import StarSchema

        entries = self.entries() if entries is None else entries
        t = {n: self.read(n, entries) for n in ("dim_product", "dim_customer", "dim_date", "fact_sales", "quarantine")}
        known = {n: self.stats(n, entries)[0] for n in ("dim_product", "dim_customer", "dim_date", "fact_sales")}
        return StarSchema(t["dim_product"], t["dim_customer"], t["dim_date"], t["fact_sales"], t["quarantine"],
                          known_rows={k: v for k, v in known.items() if v is not None})

    def read_all(self, names=("dim_product", "dim_customer", "dim_date", "fact_sales", "quarantine")):
        entries = self.entries()
        return {n: self.read(n, entries) for n in names}

    def fact_months(self, entries: list[Entry] | None = None) -> list[int]:
        entries = self.entries() if entries is None else entries
        return sorted({e.month_key for e in entries if e.table_name == FACT_SALES.name})

    def stats(self, name: str, entries: list[Entry] | None = None) -> tuple[int | None, int | None]:
        """(row count, max surrogate) recorded for ``name``; (0, 0) if the
        table has never been written, None where a figure is unknown."""
        entries = self.entries() if entries is None else entries
        mine = [e for e in entries if e.table_name == name]
        if not mine:
            return 0, 0
        rows = None if any(e.row_count is None for e in mine) else sum(e.row_count for e in mine)
        keys = [e.max_key for e in mine]
        return rows, (None if any(k is None for k in keys) else max(keys))

    def fact_totals(self, entries: list[Entry] | None = None) -> tuple[int, Decimal]:
        """(rows, revenue) of the stored fact: the files' measures added up, no scan."""
        entries = self.entries() if entries is None else entries
        mine = [e.measure() for e in entries if e.table_name == FACT_SALES.name]
        return sum(n for n, _ in mine), sum((r for _, r in mine), Decimal("0.00"))

    def write(self, name: str, df: DataFrame, version: int, *, rows: int | None = None,
              max_key: int | None = None) -> list[Entry]:
        """Write ``df`` (already typed) to a directory of this attempt at
        ``version``; the given statistics are recorded with the entries."""
        path = f"{self.root}/{name}/v{version}-{uuid.uuid4().hex}"
        if name != FACT_SALES.name:
            df.write.mode("errorifexists").parquet(path)
            return [Entry(name, None, path, rows, max_key)]
        # Fact: a directory a month, files in ranges of the natural key's
        # first column, so a merge can tell which files its lines can be in.
        written = Observation()
        with_month = df.withColumn("month_key", month_key(F.col("date_key")))
        (with_month.repartitionByRange("month_key", "invoice_no")
         .observe(written, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("revenue"), F.lit(0)).cast(SUM_MONEY).alias("revenue"))
         .write.mode("errorifexists").partitionBy("month_key").parquet(path))
        entries = self._measure_fact(path)
        if self.fact_totals(entries) != (written.get["n"], written.get["revenue"]):
            raise RuntimeError(f"{path}: wrote {written.get}, read back {self.fact_totals(entries)}")
        return entries

    def _measure_fact(self, path: str) -> list[Entry]:
        """An entry for each fact file under ``path``, read back from storage.

        A file lies in one month. Collecting its months (instead of grouping
        by them) has Spark keep the minima of texts in a hash table of the few
        files of a task; without it, all rows are sorted by their file's path.
        """
        schema = StructType(FACT_SALES.schema.fields + [StructField("month_key", IntegerType(), True)])
        stored = self.spark.read.schema(schema).parquet(path)
        found = (stored.groupBy(F.col("_metadata.file_path").alias("path"))
                 .agg(F.collect_set("month_key").alias("months"), F.count(F.lit(1)).alias("n"), F.max("sale_id").alias("top"),
                      F.coalesce(F.sum("revenue"), F.lit(0)).cast(SUM_MONEY).cast("string").alias("revenue"),
                      F.min("invoice_no").alias("low"), F.max("invoice_no").alias("high")).collect())  # one row a file
        return [Entry(FACT_SALES.name, next(iter(r["months"]), None), r["path"], r["n"], r["top"], r["revenue"], r["low"], r["high"])
                for r in sorted(found, key=lambda r: r["path"])]

    # -- run history --------------------------------------------------------
    def with_run(self, entries: list[Entry], record: DataFrame, version: int, run_id: str) -> list[Entry]:
        """``entries`` with the record of a run, refused if the id is known."""
        if self.has_run(run_id, entries):
            raise DuplicateRun(f"run {run_id} has been committed")
        mine = [e for e in entries if e.table_name == PIPELINE_RUNS.name]
        others = [e for e in entries if e.table_name != PIPELINE_RUNS.name]
        if len(mine) >= RUN_FILES:
            record, rows, mine = self.read(PIPELINE_RUNS.name, mine).unionByName(record), 1 + sum(e.row_count for e in mine), []
        else:
            rows = 1
        new = self.write(PIPELINE_RUNS.name, record.coalesce(1), version)
        return others + mine + [replace(e, row_count=rows) for e in new]

    def has_run(self, run_id: str, entries: list[Entry] | None = None) -> bool:
        return bool(self.read(PIPELINE_RUNS.name, entries).where(F.col("run_id") == run_id).limit(1).collect())

    def append_run(self, record: DataFrame) -> None:
        """Record a run without a load, as a version of its own."""
        run_id = record.first()["run_id"]
        while True:
            base = self.version()
            try:
                return self.publish(base + 1, self.with_run(self.entries(base), record, base + 1, run_id), "record", run_id)
            except Conflict:
                continue

    def run_history(self) -> DataFrame:
        return self.read(PIPELINE_RUNS.name)

    def recent_runs(self, limit: int = 10) -> DataFrame:
        """Newest first (a top-k report; the limit is the feature)."""
        return (
            self.run_history()
            .orderBy(F.desc("started_at"), F.desc("finished_at"), "run_id")
            .limit(limit)
            .select("started_at", "load_mode", "rows_extracted", "rows_loaded",
                    "rows_quarantined", "total_revenue", "git_sha")
        )

    # -- retention ------------------------------------------------------------
    def vacuum(self, keep_versions: int = 10, older_than: float = 7 * 24 * 3600) -> list[str]:
        """Delete what no version to be kept names; the deleted paths.

        Mark: the attempts that the latest ``keep_versions`` manifests name.
        Sweep: older manifests, then attempts that aren't marked and were
        last changed ``older_than`` seconds ago. A running load's attempt is
        younger than that, so the grace period must exceed the longest load.
        """
        versions, old = self.versions(), time.time() - older_than
        kept = versions[-max(1, keep_versions):]
        live = {self._attempt(e.path) for v in kept for e in self.entries(v)}
        gone = []
        for v in versions:
            if v not in kept:
                gone.append(f"{self.root}/{MANIFEST_DIR}/v{v:010d}.json")
                self._manifests.pop(v, None)
        for name in ("dim_product", "dim_customer", "dim_date", "fact_sales", "quarantine", "pipeline_runs"):
            for attempt, changed, folder in listed(self.spark, f"{self.root}/{name}"):
                if folder and f"{name}/{attempt}" not in live and changed / 1000 <= old:
                    gone.append(f"{self.root}/{name}/{attempt}")
        for path in gone:
            delete(self.spark, path)
        return gone

    def _attempt(self, path: str) -> str:
        """``table/attempt`` of an entry's path."""
        found = re.search(r"([a-z_]+/v\d+-[0-9a-f]{32})(/|$)", path)
        return found.group(1) if found else path
