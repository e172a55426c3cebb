"""Registered queries of whole runs, races, planted faults and edge values.

Faults are planted by rules over keys, so every scale factor has them and
the DuckDB side can plant the same ones.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import oracle as O
from ..operators import checks as C
from ..operators import contracts as K
from ..operators import serving
from ..operators.bronze import to_bronze
from ..operators.classify import REASON, classify
from ..operators.recon import reconcile, reconcile_load
from ..operators.star import build_star, resolve_keys
from ..schema import RAW_COLUMNS, TABLES
from ..session import apply_defaults
from ..sources.csv import read_raw_csv
from ..sources.tables import category_map, raw_order_lines
from .catalog import (
    RUN_DATE_1,
    RUN_DATE_2,
    _memo,
    append_flow,
    batch_stars,
    merge_flow,
    register,
    scratch_path,
    staged_bronze_for,
    star_for,
)
from .job import Config, run
from .loads import load_star
from .warehouse import Warehouse


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------------------
# Edge values: numbers as text, amounts beyond the money type
# ---------------------------------------------------------------------------

#: How a line's quantity is written, by its hash modulo the number of forms,
#: and what it is then ({q} stands for the quantity).
NUMBER_FORMS = (
    ("{q}.0", "{q}"),
    ("{q}.0000000001", None),
    ("{q}e2", "{q} * 100"),
    ("1e-10", None),
    ("{q}00e-2", "{q}"),
    ("{q}00000000000000000000", None),
    ("  {q} ", "{q}"),
    ("+{q}.000e1", "{q} * 10"),
    (".{q}", None),
    ("{q}.5", None),
    ("0.0e-400", "0"),
    ("-{q}E+0", "-{q}"),
    ("{q}d", None),
    ("9223372036854775807", "9223372036854775807"),
    ("9223372036854775808", None),
    ("Infinity", None),
)


def _number_sql(form: int) -> str:
    def pick(i: int) -> str:
        rows = []
        for n, (text, value) in enumerate(NUMBER_FORMS):
            if i:
                v = "NULL" if value is None else f"CAST({value.format(q='CAST(l_quantity AS BIGINT)')} AS BIGINT)"
            else:
                v = "concat('" + text.replace("{q}", "', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), '") + "')"
            rows.append(f"WHEN {n} THEN {v}")
        return f"CASE (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % {len(NUMBER_FORMS)} {' '.join(rows)} END"
    return pick(form)


@register("coerce_edge", f"""
SELECT text, quantity, CAST(COUNT(*) AS BIGINT) AS lines
FROM (SELECT {_number_sql(0)} AS text, {_number_sql(1)} AS quantity FROM lineitem)
GROUP BY text, quantity""")
def q_coerce_edge(spark, sf_dir):
    """P2 on texts that a cast to double or decimal gets wrong."""
    from ..functions.coerce import to_whole_number
    from ..sources.tables import read_table

    apply_defaults(spark)
    q = F.col("l_quantity").cast("bigint").cast("string")
    which = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber")) % len(NUMBER_FORMS)
    text = reduce(lambda c, nf: c.when(which == nf[0], F.format_string(nf[1][0].replace("{q}", "%1$s"), q)),
                  enumerate(NUMBER_FORMS), F.when(F.lit(False), F.lit("")))
    return (read_table(spark, sf_dir, "lineitem").select(text.alias("text"))
            .withColumn("quantity", to_whole_number(F.col("text")))
            .groupBy("text", "quantity").agg(F.count(F.lit(1)).alias("lines")))


@register("amounts_out_of_range", O.on_bronze(f"""
SELECT quarantine_reason, CAST(COUNT(*) AS BIGINT) AS lines,
       CAST(SUM(CASE WHEN quarantine_reason IS NULL THEN CAST(quantity * unit_price AS DECIMAL(14,2)) END) AS DECIMAL(38,2)) AS revenue
FROM (SELECT * EXCLUDE (q), q AS quantity, CASE
        WHEN invoice_no IS NULL THEN 'missing_invoice_no' WHEN stock_code IS NULL THEN 'missing_stock_code'
        WHEN invoice_date IS NULL THEN 'missing_or_bad_date' WHEN customer_id IS NULL THEN 'missing_customer_id'
        WHEN unit_price IS NULL THEN 'missing_unit_price' WHEN q IS NULL THEN 'missing_quantity'
        WHEN q <= 0 THEN 'non_positive_quantity'
        WHEN ROW_NUMBER() OVER (PARTITION BY invoice_no, stock_code, invoice_date ORDER BY {O.ORD}) > 1 THEN 'duplicate_invoice_line'
        WHEN CAST(q AS DECIMAL(19,0)) * unit_price >= 1000000000000 THEN 'amount_out_of_range' END AS quarantine_reason
      FROM (SELECT * EXCLUDE (quantity), quantity * CASE o1 % 3 WHEN 0 THEN 1 WHEN 1 THEN 100000000 ELSE 10000000000 END AS q FROM bronze))
GROUP BY quarantine_reason"""))
def q_amounts_out_of_range(spark, sf_dir):
    """Quantities beyond 32 bits load; a line whose revenue doesn't fit is set aside, the run goes on."""
    third = F.col("_ord.o1") % 3
    factor = F.when(third == 0, 1).when(third == 1, 100_000_000).otherwise(10_000_000_000).cast("bigint")
    bronze = staged_bronze_for(spark, sf_dir).withColumn("quantity", F.col("quantity") * factor)
    from ..functions.money import line_revenue

    revenue = F.when(F.col(REASON).isNull(), line_revenue(F.col("quantity"), F.col("unit_price")))
    return (classify(bronze).withColumn("r", revenue).groupBy(REASON)
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("r").cast("decimal(38,2)").alias("revenue")))


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------

@register("csv_scan", "WITH " + O.RAW + f"""
SELECT {', '.join(f"NULLIF({c}, '') AS {c}" for c in RAW_COLUMNS)} FROM raw""")
def q_csv_scan(spark, sf_dir):
    """Files whose headers differ in case, spaces, order and surplus columns, read by name."""
    apply_defaults(spark)
    raw = raw_order_lines(spark, sf_dir).withColumn("_odd", F.col("_ord.o1") % 2 == 1)
    out = scratch_path(spark, "csv")
    plain = raw.where("not _odd").select(*RAW_COLUMNS)
    shuffled = raw.where("_odd").select(
        F.lit("x").alias("Remark"), *[F.col(c).alias(" " + c.replace("_", " ").title()) for c in reversed(RAW_COLUMNS)])
    for name, frame in (("plain", plain), ("shuffled", shuffled)):
        (frame.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{out}/{name}"))
    return read_raw_csv(spark, [f"{out}/plain", f"{out}/shuffled"]).select(*RAW_COLUMNS)


# ---------------------------------------------------------------------------
# Checks that block, checks of a user's own
# ---------------------------------------------------------------------------

@register("dq_blocking", O.on_bronze("""
SELECT 'not_null[invoice_no]' AS name, 'error' AS severity,
       CAST((2 * n * 10000 + t) // (2 * t) AS DOUBLE) / 10000.0 AS observed
FROM (SELECT COUNT(*) AS t, COUNT(*) FILTER (WHERE invoice_no IS NULL OR o2 % 7 = 0) AS n FROM bronze)"""))
def q_dq_blocking(spark, sf_dir):
    """Q8: the failed ERROR checks of the default suite when part of the invoice numbers is gone."""
    bad = staged_bronze_for(spark, sf_dir).withColumn(
        "invoice_no", F.when(F.col("_ord.o2") % 7 != 0, F.col("invoice_no")))
    return C.blocking(C.build_default_suite().run(bad)).select("name", "severity", "observed")


@register("dq_custom", O.on_bronze("""
SELECT CAST(1 AS INTEGER) AS position, 'median_price' AS name, TRUE AS passed, 'warning' AS severity,
       CAST(COUNT(DISTINCT country) AS DOUBLE) AS observed, CAST(1000 AS DOUBLE) AS threshold,
       'countries' AS detail FROM bronze
UNION ALL
SELECT 2, 'big_lines', COUNT(*) FILTER (WHERE quantity > 45) = 0, 'error',
       CAST(COUNT(*) FILTER (WHERE quantity > 45) AS DOUBLE), CAST(0 AS DOUBLE), '' FROM bronze""".replace("median_price", "few_countries")))
def q_dq_custom(spark, sf_dir):
    """Q10: a user's checks, one returning a mapping, one a frame."""
    def few_countries(df):
        n = df.select("country").where("country is not null").distinct().count()
        return {"name": "few_countries", "passed": n < 1000, "observed": float(n), "threshold": 1000.0, "detail": "countries"}

    def big_lines(df):
        n = F.count_if(F.col("quantity") > 45)
        return df.agg((n == 0).alias("passed"), n.cast("double").alias("observed")).select(
            F.lit("big_lines").alias("name"), "passed", F.lit("error").alias("severity"), "observed",
            F.lit(0.0).alias("threshold"), F.lit("").alias("detail"))

    return C.CheckSuite("own", [few_countries, big_lines]).run(staged_bronze_for(spark, sf_dir))


# ---------------------------------------------------------------------------
# Quarantine of incremental loads, lines without a live dimension row
# ---------------------------------------------------------------------------

@register("merge_quarantine", O.on_batches("SELECT * FROM q2"))
def q_merge_quarantine(spark, sf_dir):
    """M7: the second batch's rejects replace the first one's."""
    return merge_flow(spark, sf_dir)[0].read("quarantine")


@register("append_quarantine", O.on_batches("SELECT 1 AS version, q1.* FROM q1 UNION ALL SELECT 2, q2.* FROM q2"))
def q_append_quarantine(spark, sf_dir):
    wh, _, _ = append_flow(spark, sf_dir)
    return _union([wh.read("quarantine", wh.entries(v)).select(F.lit(v).alias("version"), "*") for v in (1, 2)])


@register("unresolved_lines", O.on_batches("""
SELECT b2.invoice_no, b2.stock_code, b2.customer_id, p1.product_key, c1.customer_key
FROM b2 LEFT JOIN p1 USING (stock_code) LEFT JOIN c1 USING (customer_id)
WHERE p1.product_key IS NULL OR c1.customer_key IS NULL"""))
def q_unresolved_lines(spark, sf_dir):
    """Lines of the second batch that the first batch's dimensions can't key (``rekey`` refuses them)."""
    wh, _, _ = merge_flow(spark, sf_dir)
    first = wh.star(wh.entries(1))
    _, s2 = batch_stars(spark, sf_dir)
    keyed = resolve_keys(s2.lines, first.dim_product, first.known_rows["dim_product"],
                         first.dim_customer, first.known_rows["dim_customer"])
    return keyed.where("product_key is null or customer_key is null").select(
        "invoice_no", "stock_code", "customer_id", "product_key", "customer_key")


# ---------------------------------------------------------------------------
# Planted faults
# ---------------------------------------------------------------------------

#: The merged tables with faults: repeated products, a second current version
#: of some customers without a country, long invoice numbers and lost
#: products in the fact, rejects without a reason.
FAULTY = """
p2x AS (SELECT * FROM p2 UNION ALL SELECT * FROM p2 WHERE product_key % 7 = 0),
c2x AS (SELECT * FROM c2 UNION ALL
        SELECT customer_key + 1000000, customer_id, CAST(NULL AS VARCHAR), effective_from, effective_to, is_current
        FROM c2 WHERE customer_key % 11 = 0),
fmx AS (SELECT sale_id, CASE WHEN sale_id % 13 = 0 THEN -product_key ELSE product_key END AS product_key,
               CASE WHEN sale_id % 17 = 0 THEN NULL ELSE customer_key END AS customer_key,
               CASE WHEN sale_id % 19 = 0 THEN 19000101 ELSE date_key END AS date_key,
               CASE WHEN sale_id % 23 = 0 THEN repeat(invoice_no, 8) ELSE invoice_no END AS invoice_no,
               quantity, unit_price, revenue FROM fm),
q2x AS (SELECT * REPLACE (CASE WHEN quarantine_reason = 'missing_quantity' THEN NULL ELSE quarantine_reason END AS quarantine_reason) FROM q2)"""
_FAULTY_CTE = {"dim_product": "p2x", "dim_customer": "c2x", "dim_date": "d2", "fact_sales": "fmx", "quarantine": "q2x"}


def _faulty_tables(spark, sf_dir) -> dict[str, DataFrame]:
    t = merge_flow(spark, sf_dir)[0].read_all()
    again = t["dim_customer"].where("customer_key % 11 = 0").withColumns(
        {"customer_key": F.col("customer_key") + 1_000_000, "country": F.lit(None).cast("string")})
    every = lambda n: F.col("sale_id") % n == 0
    return t | {
        "dim_product": t["dim_product"].union(t["dim_product"].where("product_key % 7 = 0")),
        "dim_customer": t["dim_customer"].union(again),
        "fact_sales": t["fact_sales"].withColumns({
            "product_key": F.when(every(13), -F.col("product_key")).otherwise(F.col("product_key")),
            "customer_key": F.when(~every(17), F.col("customer_key")),
            "date_key": F.when(every(19), F.lit(19000101)).otherwise(F.col("date_key")),
            "invoice_no": F.when(every(23), F.repeat("invoice_no", F.lit(8))).otherwise(F.col("invoice_no"))}),
        "quarantine": t["quarantine"].withColumn(
            "quarantine_reason", F.when(F.col("quarantine_reason") != "missing_quantity", F.col("quarantine_reason")))}


def _violations_sql() -> str:
    parts = []
    for name, src in sorted(_FAULTY_CTE.items()):
        spec = TABLES[name]
        keys = ([("pk", spec.primary_key)] if spec.primary_key else []) + [("unique", u) for u in spec.unique]
        for kind, cols in keys:
            parts.append(f"SELECT '{name}' AS table_name, '{kind}({','.join(cols)})' AS constraint_name, "
                         f"CAST(SUM(n - 1) AS BIGINT) AS violations FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {', '.join(cols)})")
        if name == "dim_customer":
            parts.append(f"SELECT '{name}', 'one_current(customer_id)', CAST(SUM(n - 1) AS BIGINT) "
                         f"FROM (SELECT COUNT(*) AS n FROM {src} WHERE is_current GROUP BY customer_id)")
        for c in spec.columns:
            if not c.nullable:
                parts.append(f"SELECT '{name}', 'not_null({c.name})', CAST(COUNT(*) - COUNT({c.name}) AS BIGINT) FROM {src}")
            if c.max_length:
                parts.append(f"SELECT '{name}', 'max_length({c.name},{c.max_length})', "
                             f"CAST(COALESCE(SUM(CASE WHEN length({c.name}) > {c.max_length} THEN 1 END), 0) AS BIGINT) FROM {src}")
    for fk, (dim, key) in TABLES["fact_sales"].foreign_keys.items():
        parts.append(f"SELECT 'fact_sales', 'fk({fk}->{dim})', CAST(COUNT(*) AS BIGINT) FROM fmx "
                     f"WHERE {fk} IS NULL OR {fk} NOT IN (SELECT {key} FROM {_FAULTY_CTE[dim]})")
    return O.on_star("\nUNION ALL\n".join(parts), O.BATCHES + "," + FAULTY)


@register("contract_faults", _violations_sql())
def q_contract_faults(spark, sf_dir):
    """Violations of every declared constraint in tables with planted faults."""
    return K.table_violations(_faulty_tables(spark, sf_dir))


_RECON_FAULTS = """
x AS (SELECT m.mode, (SELECT COUNT(*) FROM fmx WHERE product_key NOT IN (SELECT product_key FROM p2)) AS op,
             (SELECT COUNT(*) FROM fmx WHERE customer_key IS NULL OR customer_key NOT IN (SELECT customer_key FROM c2)) AS oc,
             (SELECT COUNT(*) FROM fmx WHERE date_key NOT IN (SELECT date_key FROM d2)) AS od,
             (SELECT COUNT(*) FROM fmx) AS n, (SELECT SUM(revenue) FROM fmx) AS rev,
             (SELECT COUNT(*) FROM raw) AS extracted, (SELECT CAST(SUM(quantity * unit_price) AS DECIMAL(18,2)) FROM valid) + 1 AS src
      FROM (SELECT UNNEST(['replace', 'append', 'merge']) AS mode) m)"""


@register("recon_faults", O.on_star("""
SELECT mode, 1 AS position, op + oc + od = 0 AS passed, CAST(op + oc + od AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold FROM x
UNION ALL SELECT mode, 2, CASE mode WHEN 'replace' THEN n = extracted ELSE n >= extracted END, CAST(n AS DOUBLE), CAST(extracted AS DOUBLE) FROM x
UNION ALL SELECT mode, 3, CASE mode WHEN 'replace' THEN abs(rev - src) < 0.01 ELSE rev >= src - 0.01 END, CAST(rev AS DOUBLE), CAST(src AS DOUBLE) FROM x""",
    O.BATCHES + "," + FAULTY + "," + _RECON_FAULTS))
def q_recon_faults(spark, sf_dir):
    """R1-R3 in the three modes where all of them must fail: orphans, a source that has the rejects as rows, one more in revenue."""
    t = _faulty_tables(spark, sf_dir) | {k: v for k, v in merge_flow(spark, sf_dir)[0].read_all().items() if k.startswith("dim_")}
    rows = staged_bronze_for(spark, sf_dir).count()
    revenue = star_for(spark, sf_dir).total_revenue().first()[0] + 1
    return _union([reconcile(spark, t, load_mode=m, rows_extracted=rows, rows_quarantined=0, source_revenue=revenue)
                  .select(F.lit(m).alias("mode"), "position", "passed", "observed", "threshold")
                   for m in ("replace", "append", "merge")])


# ---------------------------------------------------------------------------
# Whole runs, the run history, reconciliation without a scan
# ---------------------------------------------------------------------------

def job_flow(spark, sf_dir):
    """Two runs, each submitted twice under its id."""
    def build():
        apply_defaults(spark)
        wh = Warehouse(spark, scratch_path(spark, "wh-job"))
        done = []
        for run_id, mode, date in (("run-1", "replace", RUN_DATE_1), ("run-2", "merge", RUN_DATE_2)):
            for _ in range(2):
                cfg = Config(warehouse=wh.root, load_mode=mode, run_date=date, git_sha="0" * 7, run_id=run_id)
                done.append(run(spark, raw_order_lines(spark, sf_dir), cfg, categories=category_map(spark, sf_dir)))
        return wh, done
    return _memo(spark, sf_dir, "job_flow", build)


@register("job_fact", O.on_star("SELECT * FROM fact_sales"))
def q_job_fact(spark, sf_dir):
    """L1: what ``job.run`` stored, after a merge of the same lines and two replays."""
    return job_flow(spark, sf_dir)[0].read("fact_sales")


@register("job_report", O.on_star("""
SELECT p.category, CAST(SUM(v.quantity * v.unit_price) AS DECIMAL(18,2)) AS revenue
FROM valid v JOIN (SELECT stock_code, category FROM dim_product) p USING (stock_code)
GROUP BY p.category ORDER BY revenue DESC, p.category"""))
def q_job_report(spark, sf_dir):
    return serving.revenue_by_category(job_flow(spark, sf_dir)[0].star())


@register("run_history", O.on_star("""
SELECT run_id, load_mode, CAST((SELECT COUNT(*) FROM raw) AS BIGINT) AS rows_extracted,
       CAST((SELECT COUNT(*) FROM valid) AS BIGINT) AS rows_loaded, CAST((SELECT COUNT(*) FROM quarantine) AS BIGINT) AS rows_quarantined,
       CAST((SELECT SUM(quantity * unit_price) FROM valid) AS DECIMAL(16,2)) AS total_revenue, '0000000' AS git_sha
FROM (VALUES ('run-1', 'replace'), ('run-2', 'merge')) r(run_id, load_mode)"""))
def q_run_history(spark, sf_dir):
    """One record a run, though each was submitted twice."""
    return job_flow(spark, sf_dir)[0].run_history().drop("started_at", "finished_at")


@register("recent_runs", O.on_star("""
SELECT load_mode, CAST((SELECT COUNT(*) FROM raw) AS BIGINT) AS rows_extracted,
       CAST((SELECT COUNT(*) FROM valid) AS BIGINT) AS rows_loaded, CAST((SELECT COUNT(*) FROM quarantine) AS BIGINT) AS rows_quarantined,
       CAST((SELECT SUM(quantity * unit_price) FROM valid) AS DECIMAL(16,2)) AS total_revenue, '0000000' AS git_sha
FROM (VALUES ('merge')) r(load_mode)"""))
def q_recent_runs(spark, sf_dir):
    """The newest run."""
    return job_flow(spark, sf_dir)[0].recent_runs(1).drop("started_at")


_RECON_ROWS = """
SELECT {mode} AS mode, 1 AS position, TRUE AS passed, CAST(0 AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
       '0 product / 0 customer / 0 date orphan FK(s)' AS detail
UNION ALL SELECT {mode}, 2, n >= expected, CAST(n AS DOUBLE), CAST(expected AS DOUBLE),
       'fact=' || n || ' >= this-run valid=' || expected || ' (incremental: fact may hold prior runs)' FROM {src}
UNION ALL SELECT {mode}, 3, rev >= src - 0.01, CAST(rev AS DOUBLE), CAST(src AS DOUBLE), 'db=' || rev || ' >= this-run source=' || src FROM {src}"""
_RECON_SRC = """
y AS (SELECT (SELECT COUNT(*) FROM {f}) AS n, (SELECT CAST(SUM(revenue) AS DECIMAL(18,2)) FROM {f}) AS rev,
             (SELECT COUNT(*) FROM b2) AS expected, (SELECT CAST(SUM(quantity * unit_price) AS DECIMAL(18,2)) FROM b2) AS src)"""


@register("recon_incremental", O.on_star(
    " UNION ALL ".join(f"SELECT * FROM ({_RECON_ROWS.format(mode=repr(m), src=s)})" for m, s in (("merge", "y"), ("append", "z"))),
    O.BATCHES + "," + _RECON_SRC.format(f="fm") + "," + _RECON_SRC.format(f="fa").replace("y AS", "z AS", 1)))
def q_recon_incremental(spark, sf_dir):
    """R1-R3 of the second batch from the manifest's sums: no file of the fact is opened."""
    _, s2 = batch_stars(spark, sf_dir)
    revenue = s2.total_revenue().first()[0]
    valid = s2.known_rows["fact_sales"]
    out = []
    for mode, flow in (("merge", merge_flow), ("append", append_flow)):
        wh, _, loaded = flow(spark, sf_dir)
        out.append(reconcile_load(spark, *wh.fact_totals(), loaded.contract_rows, load_mode=mode, rows_extracted=valid,
                                  rows_quarantined=0, source_revenue=revenue)
                   .select(F.lit(mode).alias("mode"), "position", "passed", "observed", "threshold", "detail"))
    return _union(out)


@register("manifest_months", O.on_batches("""
SELECT date_key // 100 AS month, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue,
       CAST(MAX(sale_id) AS BIGINT) AS max_key FROM fm GROUP BY 1"""))
def q_manifest_months(spark, sf_dir):
    """The fact's measures by month as the manifest of a merged warehouse keeps them."""
    entries = [e for e in merge_flow(spark, sf_dir)[0].entries() if e.table_name == "fact_sales"]
    kept = spark.createDataFrame([(e.month_key, e.row_count, e.revenue, e.max_key) for e in entries],
                                 "month int, rows long, revenue string, max_key long")
    return kept.groupBy("month").agg(F.sum("rows").alias("rows"), F.sum(F.col("revenue").cast("decimal(18,2)")).cast("decimal(18,2)")
                                     .alias("revenue"), F.max("max_key").alias("max_key"))


# ---------------------------------------------------------------------------
# Races, empty batches, stored types
# ---------------------------------------------------------------------------

@register("concurrent_loads", O.on_batches("""
SELECT p2.stock_code, fm.date_key, fm.invoice_no, fm.quantity, fm.unit_price, fm.revenue
FROM fm JOIN p2 USING (product_key)"""))
def q_concurrent_loads(spark, sf_dir):
    """M8: two merges that start from the same version at once; one is overtaken and done again, no line is lost or doubled."""
    stars = batch_stars(spark, sf_dir)
    root = scratch_path(spark, "wh-race")
    start = threading.Barrier(len(stars))
    errors: list[Exception] = []

    def one(star):
        wh = Warehouse(spark, root)
        publish, waited = wh.publish, []

        def together(*args, **kwargs):  # both have read version 0 when the first one publishes
            if not waited:
                waited.append(start.wait(600))
            return publish(*args, **kwargs)

        wh.publish = together
        try:
            load_star(wh, star, "merge", RUN_DATE_1)
        except Exception as exc:  # noqa: BLE001
            errors.append(exc)
            start.abort()

    threads = [threading.Thread(target=one, args=(s,)) for s in stars]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    wh = Warehouse(spark, root)
    codes = wh.read("dim_product").select("product_key", "stock_code")
    return wh.read("fact_sales").join(codes, "product_key").select(
        "stock_code", "date_key", "invoice_no", "quantity", "unit_price", "revenue")


@register("empty_batch", O.on_batches("""
SELECT m.mode, t.table_name, t.row_count
FROM (SELECT UNNEST(['append', 'merge']) AS mode) m,
     (SELECT 'dim_product' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM p1
      UNION ALL SELECT 'dim_customer', CAST(COUNT(*) AS BIGINT) FROM c1 UNION ALL SELECT 'dim_date', CAST(COUNT(*) AS BIGINT) FROM d1
      UNION ALL SELECT 'fact_sales', CAST(COUNT(*) AS BIGINT) FROM f1 UNION ALL SELECT 'quarantine', CAST(0 AS BIGINT)) t"""))
def q_empty_batch(spark, sf_dir):
    """M9: an empty batch after the first one changes nothing but the quarantine, which it replaces."""
    s1, _ = batch_stars(spark, sf_dir)
    nothing = build_star(staged_bronze_for(spark, sf_dir).where("false"), staged=True)
    out = []
    for mode in ("append", "merge"):
        wh = Warehouse(spark, scratch_path(spark, f"wh-empty-{mode}"))
        load_star(wh, s1, mode, RUN_DATE_1)
        load_star(wh, nothing, mode, RUN_DATE_2)
        out.append(serving.star_row_counts(wh.star()).select(F.lit(mode).alias("mode"), "table_name", "row_count"))
    return _union(out)


#: The stored types.
STORED_TYPES = {
    "dim_product": "product_key bigint, stock_code string, description string, category string, unit_price decimal(12,2)",
    "dim_customer": "customer_key bigint, customer_id string, country string, effective_from date, effective_to date, is_current boolean",
    "dim_date": "date_key int, date date, year int, quarter int, month int, day int, weekday string, is_weekend boolean",
    "fact_sales": ("sale_id bigint, product_key bigint, customer_key bigint, date_key int, invoice_no string, quantity bigint, "
                   "unit_price decimal(12,2), revenue decimal(14,2)"),
    "quarantine": ("invoice_no string, stock_code string, description string, quantity bigint, unit_price decimal(12,2), "
                   "invoice_date date, customer_id string, country string, quarantine_reason string"),
}


@register("stored_types", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c.split()[0]}' AS column_name, '{c.split()[1]}' AS type"
    for t, cols in STORED_TYPES.items() for c in cols.split(", ")))
def q_stored_types(spark, sf_dir):
    """The types in the files of a merged warehouse."""
    wh, _, _ = merge_flow(spark, sf_dir)
    rows = set()
    for name in STORED_TYPES:
        stored = spark.read.parquet(*[e.path for e in wh.entries() if e.table_name == name]).schema
        rows |= {(name, f.name, f.dataType.simpleString()) for f in stored.fields}
    return spark.createDataFrame(sorted(rows), "table_name string, column_name string, type string")
