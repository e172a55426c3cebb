"""Benchmark: the ELT job and the dashboard queries at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8). Prints ONE JSON line:
{"metric": "...", "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Headline ("value"): elt_replace, the whole job. Timed steps (each from a
cold plan, JVM already started):
  bronze_classify    raw lines -> coerce (staged once as Parquet) ->
                     duplicate flags + reasons -> persist -> count (the step
  elt_replace        raw lines -> checks -> classify -> star -> replace load
                     -> reconcile -> run record (the whole job)
  elt_merge_batches  batch 1 then batch 2 through merge mode (upsert+SCD-2)
  elt_append_batch   batch 1 then batch 2 through append mode (watermark)
  dq_suite           default data-quality suite on bronze
  column_profile     profile of the raw text columns
  <serving queries>  each read from the published warehouse
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from lakestar.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app_name="lakestar-bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM / codegen warm-up

    from lakestar.operators import serving
    from lakestar.operators.bronze import to_bronze
    from lakestar.operators.checks import build_default_suite
    from lakestar.operators.profile import column_profile
    from lakestar.operators.classify import classify
    from lakestar.operators.star import StarSchema, build_star, stage_bronze
    from lakestar.plans.catalog import scratch_path
    from lakestar.plans.job import Config, run
    from lakestar.plans.loads import load_star
    from lakestar.plans.warehouse import Warehouse
    from lakestar.schema import RAW_COLUMNS
    from lakestar.sources.tables import category_map, raw_order_lines, split_batches

    times: dict[str, float] = {}

    from lakestar.operators.cache import release

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        release()  # each step starts without the previous step's caches
        return out

    def elt_replace():
        raw = raw_order_lines(spark, sf_dir)
        cfg = Config(warehouse=scratch_path(spark, "bench-wh"), load_mode="replace",
                     run_date=dt.date(2025, 1, 1), git_sha="bench")
        result = run(spark, raw, cfg, categories=category_map(spark, sf_dir))
        assert result.recon_passed
        return cfg.warehouse

    def bronze_classify():
        # bronze is staged once (the production path), then classified
        classified = classify(stage_bronze(to_bronze(raw_order_lines(spark, sf_dir)))).persist()
        n = classified.count()
        classified.unpersist()
        return n

    timed("bronze_classify", bronze_classify)
    root = timed("elt_replace", elt_replace)
    wh = Warehouse(spark, root)

    def incremental(mode):
        def go():
            b1, b2 = split_batches(stage_bronze(to_bronze(raw_order_lines(spark, sf_dir))))
            cats = category_map(spark, sf_dir)
            w = Warehouse(spark, scratch_path(spark, f"bench-{mode}"))
            load_star(w, build_star(b1, cats, staged=True), mode, dt.date(2025, 1, 1))
            load_star(w, build_star(b2, cats, staged=True), mode, dt.date(2025, 2, 1))
            return w.read("fact_sales").count()
        return go

    timed("elt_merge_batches", incremental("merge"))
    timed("elt_append_batch", incremental("append"))
    timed("dq_suite", lambda: build_default_suite().run(to_bronze(raw_order_lines(spark, sf_dir))).collect())
    timed("column_profile", lambda: column_profile(raw_order_lines(spark, sf_dir).select(*RAW_COLUMNS)).collect())

    def stored_star() -> StarSchema:
        return wh.star()

    for name in ("revenue_by_category", "top_products", "revenue_by_country", "monthly_revenue",
                 "weekend_revenue", "quarantine_reasons", "daily_revenue", "kpis", "dashboard_bundle"):
        fn = getattr(serving, name)
        timed(name, lambda fn=fn: fn(stored_star()).collect())

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "elt_replace_job",
        "value": times["elt_replace"],
        "total_all_steps": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
