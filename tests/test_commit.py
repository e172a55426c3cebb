"""Commits: one winner of a race, runs that take effect once, retention."""

import datetime as dt
import os
import threading
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from conftest import line, raw_rows

from lakestar.operators.bronze import to_bronze
from lakestar.operators.star import build_star
from lakestar.plans import job
from lakestar.plans.commit import create_if_absent
from lakestar.plans.job import Config, run
from lakestar.plans.loads import load_star
from lakestar.plans.warehouse import RUN_FILES, Conflict, DuplicateRun, Entry, Warehouse
from lakestar.schema import PIPELINE_RUNS
from lakestar.streaming import start_incremental_load
from lakestar.streaming.incremental import run_id_of

DAY = dt.date(2032, 2, 2)


def batch(spark, name, n=3, day="2032-02-0"):
    rows = [line(invoice=f"{name}{i}", stock=f"S{i % 2}", date=f"{day}{1 + i % 3}", cust=name, qty=str(i + 1)) for i in range(n)]
    return build_star(to_bronze(raw_rows(spark, rows)))


def record(spark, run_id):
    return spark.createDataFrame([(run_id, "t0", "t1", "merge", 1, 1, 0, Decimal("1.00"), "sha")], PIPELINE_RUNS.schema)


def test_one_of_many_writers_wins(spark, scratch):
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: create_if_absent(spark, f"{scratch}/m", "v1.json", f"writer {i}" * 1000), range(16)))
    assert sum(won) == 1
    assert open(f"{scratch}/m/v1.json").read() == f"writer {won.index(True)}" * 1000
    assert os.listdir(f"{scratch}/m") == ["v1.json"]


def test_publish_refuses_a_taken_version(spark, scratch):
    one, two = Warehouse(spark, scratch), Warehouse(spark, scratch)
    one.publish(1, [Entry("dim_date", None, "x", 3)])
    with pytest.raises(Conflict):
        two.publish(1, [])
    assert two.entries() == [Entry("dim_date", None, "x", 3)]


@pytest.mark.parametrize("modes", [("merge", "merge"), ("append", "append"), ("replace", "merge"), ("merge", "append")])
def test_two_loads_at_once(spark, scratch, modes):
    """Both have read the same version when they publish; the one that loses is done again from the winner's."""
    load_star(Warehouse(spark, scratch), batch(spark, "base", day="2032-01-0"), "merge", DAY)
    both = threading.Barrier(2)

    def load(i):
        wh, tries = Warehouse(spark, scratch), []
        publish = wh.publish

        def meet(*args, **kwargs):
            tries.append(args[0])
            if len(tries) == 1:
                both.wait(300)
            return publish(*args, **kwargs)

        wh.publish = meet
        return load_star(wh, batch(spark, "xy"[i], day="2032-03-0" if i else "2032-02-0"), modes[i], DAY), tries

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(load, range(2)))
    assert sorted(len(t) for _, t in done) == [1, 2] and sorted(r.version for r, _ in done) == [2, 3]
    wh = Warehouse(spark, scratch)
    assert wh.version() == 3
    have = {r.invoice_no[:1] for r in wh.read("fact_sales").collect()}
    late = {i for i, (r, _) in enumerate(done) if r.version == 3}
    if "replace" in modes:
        # the replace drops what was there; a merge that follows it adds to it
        assert have == ({"x"} if late == {0} else {"x", "y"})
    elif modes[0] == "append" or modes == ("merge", "append"):
        # an append that is overtaken by a later month finds its lines before the watermark
        skipped = {"x"} if modes[0] == "append" and late == {0} else set()
        assert have == {"b", "x", "y"} - skipped and sum(r.late_rows_skipped for r, _ in done) == 3 * len(skipped)
    else:
        assert have == {"b", "x", "y"}
    ids = [r.sale_id for r in wh.read("fact_sales").collect()]
    assert len(ids) == len(set(ids)) == wh.fact_totals()[0]


def csv_rows(spark, n, who="kim"):
    return raw_rows(spark, [line(invoice=f"r{i}", stock="S1", date="2032-04-01", cust=who) for i in range(n)])


def test_a_run_takes_effect_once(spark, scratch):
    cfg = Config(warehouse=scratch, load_mode="append", run_date=DAY, run_id="night-1")
    first = run(spark, csv_rows(spark, 120), cfg)
    again = run(spark, csv_rows(spark, 120), cfg)
    wh = Warehouse(spark, scratch)
    assert first.recon_passed and not first.replayed and again.replayed and again.load is None
    assert (again.rows_extracted, again.total_revenue) == (first.rows_extracted, first.total_revenue)
    assert wh.version() == 1 and wh.run_history().count() == 1 and wh.commit(1).run_id == "night-1"


def test_the_same_run_twice_at_once(spark, scratch, monkeypatch):
    """Both pass the first look at the history; one commits, the other finds the id at its own commit."""
    both = threading.Barrier(2)
    real = job.load_star

    def meet(*args, **kwargs):
        both.wait(300)
        return real(*args, **kwargs)

    monkeypatch.setattr(job, "load_star", meet)
    cfg = Config(warehouse=scratch, load_mode="merge", run_date=DAY, run_id="night-2")
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda _: run(spark, csv_rows(spark, 110), cfg), range(2)))
    wh = Warehouse(spark, scratch)
    assert sorted(d.replayed for d in done) == [False, True]
    assert wh.version() == 1 and wh.run_history().count() == 1 and wh.fact_totals()[0] == 110


def test_a_failed_run_leaves_no_record_and_can_be_retried(spark, scratch, monkeypatch):
    cfg = Config(warehouse=scratch, load_mode="merge", run_date=DAY, run_id="night-3")
    publish = Warehouse.publish

    def lost(self, *args, **kwargs):
        raise OSError("connection lost")

    monkeypatch.setattr(Warehouse, "publish", lost)
    with pytest.raises(OSError):
        run(spark, csv_rows(spark, 105), cfg)
    monkeypatch.setattr(Warehouse, "publish", publish)
    assert Warehouse(spark, scratch).run_history().count() == 0
    assert not run(spark, csv_rows(spark, 105), cfg).replayed
    assert Warehouse(spark, scratch).run_history().count() == 1


def test_run_ids_are_unique_and_the_history_stays_small(spark, scratch):
    wh = Warehouse(spark, scratch)
    n = RUN_FILES + 3
    for i in range(n):
        wh.append_run(record(spark, f"run-{i}"))
    with pytest.raises(DuplicateRun):
        wh.append_run(record(spark, "run-4"))
    assert wh.version() == n and sorted(r.run_id for r in wh.run_history().collect()) == sorted(f"run-{i}" for i in range(n))
    assert len([e for e in wh.entries() if e.table_name == "pipeline_runs"]) <= RUN_FILES
    assert wh.stats("pipeline_runs")[0] == n


def test_stream_batch_that_is_delivered_again(spark, tmp_path, monkeypatch):
    """The driver dies after the commit and before the stream's own: the batch comes again and loads nothing."""
    raw, root, ckpt = tmp_path / "raw", str(tmp_path / "wh"), str(tmp_path / "ckpt")
    raw.mkdir()
    head = "invoice_no,stock_code,description,quantity,unit_price,invoice_date,customer_id,country\n"
    (raw / "a.csv").write_text(head + "s1,S1,cup,2,5.00,2032-05-01,kim,Peru\n")
    from lakestar.streaming import incremental
    real = incremental.run

    def dies(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("driver lost")

    def start():
        return start_incremental_load(spark, str(raw), root, checkpoint_location=ckpt, mode="append", run_date=DAY, fail_on_check_error=False)

    monkeypatch.setattr(incremental, "run", dies)
    q = start()
    with pytest.raises(Exception, match="driver lost"):
        q.awaitTermination(300)
    monkeypatch.setattr(incremental, "run", real)
    q = start()
    q.awaitTermination(300)
    wh = Warehouse(spark, root)
    assert wh.version() == 1 and [r.run_id for r in wh.run_history().collect()] == [run_id_of(q.id, 0)]
    (raw / "b.csv").write_text(head + "s2,S1,cup,2,5.00,2032-05-02,kim,Peru\n")
    start().awaitTermination(300)
    # a new checkpoint is a new stream: its batch 0 isn't the old one's
    start_incremental_load(spark, str(raw), root, checkpoint_location=ckpt + "2", run_date=DAY, fail_on_check_error=False).awaitTermination(300)
    assert wh.run_history().count() == 3 and wh.read("fact_sales").count() == 2


def test_vacuum_keeps_what_versions_and_running_loads_need(spark, scratch):
    wh = Warehouse(spark, scratch)
    for i, mode in enumerate(("replace", "merge", "merge")):
        load_star(wh, batch(spark, f"v{i}", day=f"2032-0{1 + i}-0"), mode, DAY + dt.timedelta(days=i))
    old = wh.entries(1)
    wh.write("dim_date", wh.read("dim_date"), 9)  # an attempt that no manifest names
    attempts = lambda: {f"{t}/{a}" for t in os.listdir(scratch) if t != "_manifest" for a in os.listdir(f"{scratch}/{t}")}
    before = attempts()
    assert len(wh.vacuum(keep_versions=2)) == 1  # the first manifest; all files are younger than the grace period
    assert attempts() == before and wh.versions() == [2, 3]
    want = {n: sorted(map(str, df.collect())) for n, df in wh.read_all().items()}
    gone = wh.vacuum(keep_versions=1, older_than=0)
    assert gone and attempts() < before
    fresh = Warehouse(spark, scratch)
    assert fresh.versions() == [3]
    assert {n: sorted(map(str, df.collect())) for n, df in fresh.read_all().items()} == want
    assert not all(os.path.exists(e.path.removeprefix("file://")) for e in old)
