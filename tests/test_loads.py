"""Load modes: late and dirty batches, several changes in one batch, failures and retries."""

import datetime as dt

import pytest
from conftest import line, raw_rows
from pyspark.sql import functions as F

from lakestar.operators.bronze import to_bronze
from lakestar.operators.contracts import ContractViolation
from lakestar.operators.star import build_star
from lakestar.plans import loads
from lakestar.plans.loads import UnresolvedKeys, files_hit, load_star, rekey, watermark
from lakestar.plans.warehouse import Warehouse

JAN, FEB, MAR = dt.date(2031, 1, 31), dt.date(2031, 2, 28), dt.date(2031, 3, 31)


def sale(no, item, who, day, *, where="Peru", qty="1", price="4.00", text="lamp"):
    return line(invoice=no, stock=item, desc=text, qty=qty, price=price, date=day, cust=who, country=where)


def star_of(spark, *rows):
    return build_star(to_bronze(raw_rows(spark, rows)))


def facts(wh, entries=None):
    t = wh.star(entries)
    return {(r.invoice_no, r.stock_code): r for r in
            t.fact_sales.join(t.dim_product.select("product_key", "stock_code"), "product_key").collect()}


@pytest.fixture
def winter(spark, scratch):
    """A warehouse with three lines of January and one of February."""
    wh = Warehouse(spark, scratch)
    load_star(wh, star_of(spark, sale("a1", "lamp-1", "ann", "2031-01-03"), sale("a1", "lamp-2", "ann", "2031-01-03", price="9.50"),
                          sale("b7", "lamp-1", "bob", "2031-01-20", where="Chile", qty="3"),
                          sale("c4", "lamp-3", "cid", "2031-02-02", where="Kenya")), "merge", JAN)
    return wh


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_late_lines(spark, winter, mode):
    """A batch with a line before the watermark, one on its day, one after."""
    batch = star_of(spark, sale("d1", "lamp-1", "ann", "2031-01-15"), sale("d2", "lamp-1", "ann", "2031-02-02"),
                    sale("d3", "lamp-4", "dan", "2031-02-03", where="Peru"))
    assert watermark(winter) == 20310202
    done = load_star(winter, batch, mode, FEB)
    got = {k[0] for k in facts(winter)}
    if mode == "append":
        assert done.late_rows_skipped == 2 and got == {"a1", "b7", "c4", "d3"}
    else:
        assert done.late_rows_skipped == 0 and got == {"a1", "b7", "c4", "d1", "d2", "d3"}
    assert watermark(winter) == 20310203
    ids = sorted(r.sale_id for r in winter.read("fact_sales").collect())
    assert ids == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("mode", ["replace", "append", "merge"])
def test_dirty_batch_fills_the_quarantine(spark, winter, mode):
    batch = star_of(spark, sale("e1", "lamp-1", "", "2031-03-01"), sale("e2", "lamp-1", "ann", "soon"), sale("e3", "lamp-9", "eve", "2031-03-02", qty="-3"),
                    sale("e4", "lamp-1", "ann", "2031-03-03"), sale("e4", "lamp-1", "ann", "2031-03-03"), sale("e5", "lamp-1", "ann", "2031-03-04", qty="900000000000", price="9999999999.99"))
    load_star(winter, batch, mode, MAR)
    reasons = {r.invoice_no: r.quarantine_reason for r in winter.read("quarantine").collect()}
    assert reasons == {"e1": "missing_customer_id", "e2": "missing_or_bad_date", "e3": "non_positive_quantity",
                       "e4": "duplicate_invoice_line", "e5": "amount_out_of_range"}
    assert sum(k[0] == "e4" for k in facts(winter)) == 1
    # an item seen on rejected lines only has no dimension row
    assert "lamp-9" not in {r.stock_code for r in winter.read("dim_product").collect()}


def test_two_countries_of_a_customer_in_one_batch(spark, winter):
    """The first valid line of the batch decides; one version is opened."""
    load_star(winter, star_of(spark, sale("f0", "lamp-1", "bob", "soon", where="Italy"), sale("f1", "lamp-1", "bob", "2031-03-01", where="Ghana"),
                              sale("f2", "lamp-1", "bob", "2031-03-02", where="Nepal")), "merge", MAR)
    mine = sorted((r for r in winter.read("dim_customer").collect() if r.customer_id == "bob"), key=lambda r: r.customer_key)
    assert [(r.country, r.effective_from, r.effective_to, r.is_current) for r in mine] == [
        ("Chile", dt.date(1900, 1, 1), MAR, False), ("Ghana", MAR, None, True)]
    got = facts(winter)
    assert got["f1", "lamp-1"].customer_key == got["f2", "lamp-1"].customer_key == mine[1].customer_key
    assert got["b7", "lamp-1"].customer_key == mine[0].customer_key


def test_country_and_back_gives_three_versions(spark, winter):
    for day, where, run in (("2031-03-01", "Ghana", FEB), ("2031-04-01", "Chile", MAR)):
        load_star(winter, star_of(spark, sale("g" + day, "lamp-1", "bob", day, where=where)), "merge", run)
    versions = sorted((r.customer_key, r.country, r.is_current) for r in winter.read("dim_customer").where("customer_id = 'bob'").collect())
    assert [v[1:] for v in versions] == [("Chile", False), ("Ghana", False), ("Chile", True)]


def test_merge_corrects_lines_and_keeps_their_ids(spark, winter):
    before = facts(winter)
    done = load_star(winter, star_of(spark, sale("a1", "lamp-2", "ann", "2031-01-03", price="7.25", qty="2"),
                                     sale("a1", "lamp-7", "ann", "2031-01-03")), "merge", FEB)
    after = facts(winter)
    assert (done.inserted["fact_sales"], done.updated["fact_sales"]) == (1, 1)
    fixed = after["a1", "lamp-2"]
    assert (fixed.sale_id, fixed.quantity, str(fixed.revenue)) == (before["a1", "lamp-2"].sale_id, 2, "14.50")
    assert after["a1", "lamp-7"].sale_id == 5 and len(after) == 5
    # the untouched line of the same invoice stays
    assert after["a1", "lamp-1"].revenue == before["a1", "lamp-1"].revenue


@pytest.mark.parametrize("mode", ["replace", "append", "merge"])
def test_same_batch_again(spark, winter, mode):
    batch = star_of(spark, sale("h1", "lamp-1", "ann", "2031-05-01"), sale("h2", "lamp-5", "hal", "2031-05-02"))
    load_star(winter, batch, mode, FEB)
    once = {n: sorted(map(str, df.collect())) for n, df in winter.read_all().items()}
    load_star(winter, batch, mode, MAR)
    assert {n: sorted(map(str, df.collect())) for n, df in winter.read_all().items()} == once


@pytest.mark.parametrize("mode", ["replace", "append", "merge"])
def test_failed_load_then_a_good_one(spark, winter, mode):
    """A customer without a country breaks NOT NULL when the load is written: nothing is published, the next load isn't affected."""
    entries, version = winter.entries(), winter.version()
    with pytest.raises(ContractViolation, match=r"not_null\(country\)"):
        load_star(winter, star_of(spark, sale("i1", "lamp-1", "ida", "2031-06-01", where="")), mode, FEB)
    assert winter.version() == version and winter.entries() == entries
    load_star(winter, star_of(spark, sale("i1", "lamp-1", "ida", "2031-06-01")), mode, FEB)
    assert winter.version() == version + 1 and ("i1", "lamp-1") in facts(winter)


def test_second_change_on_one_run_date_is_refused(spark, winter):
    load_star(winter, star_of(spark, sale("j1", "lamp-1", "bob", "2031-03-01", where="Ghana")), "merge", MAR)
    with pytest.raises(ContractViolation, match="customer_id,effective_from"):
        load_star(winter, star_of(spark, sale("j2", "lamp-1", "bob", "2031-03-02", where="Nepal")), "merge", MAR)


def test_two_times_of_a_day_break_the_grain(spark, scratch):
    wh = Warehouse(spark, scratch)
    twice = star_of(spark, sale("k1", "lamp-1", "ann", "2031-01-03 08:00"), sale("k1", "lamp-1", "ann", "2031-01-03 17:30"))
    with pytest.raises(ContractViolation, match="invoice_no,product_key,date_key"):
        load_star(wh, twice, "replace")
    assert wh.version() == 0 and wh.read("fact_sales").count() == 0 and watermark(wh) == 0


def test_append_changes_the_current_version_only(spark, winter):
    load_star(winter, star_of(spark, sale("l1", "lamp-1", "bob", "2031-03-01", where="Ghana")), "merge", MAR)
    load_star(winter, star_of(spark, sale("l2", "lamp-1", "bob", "2031-04-01", where="Nepal")), "append", MAR)
    assert sorted((r.customer_key, r.country) for r in winter.read("dim_customer").where("customer_id = 'bob'").collect())[0][1] == "Chile"
    assert {r.country for r in winter.read("dim_customer").where("customer_id = 'bob' and is_current").collect()} == {"Nepal"}


def test_line_of_an_unknown_product_is_refused(spark, winter):
    other = star_of(spark, sale("m1", "lamp-404", "ann", "2031-03-01"))
    with pytest.raises(UnresolvedKeys):
        rekey(other.lines, winter.read("dim_product"), winter.read("dim_customer"))


def test_bad_mode(spark, winter):
    with pytest.raises(ValueError, match="load mode"):
        load_star(winter, star_of(spark, sale("n1", "lamp-1", "ann", "2031-03-01")), "overwrite")


# -- which files a merge opens ----------------------------------------------------

def test_merge_opens_only_files_that_can_hold_a_line(spark, scratch):
    wh = Warehouse(spark, scratch)
    rows = [sale(f"n{i:03d}", "lamp-1", "ann", f"2031-0{1 + i % 3}-10") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # several files a month, as of a large load
    try:
        load_star(wh, star_of(spark, *rows), "replace")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    before = {e.path: e for e in wh.entries() if e.table_name == "fact_sales"}
    assert len(before) > 3 and all(e.low <= e.high and e.row_count for e in before.values())
    old = facts(wh)
    done = load_star(wh, star_of(spark, sale("n000", "lamp-1", "ann", "2031-01-10", qty="5"), sale("n000x", "lamp-2", "ann", "2031-01-10"),
                                 sale("zzz", "lamp-1", "ann", "2031-02-10"), sale("n500", "lamp-1", "ann", "2031-09-10")), "merge", FEB)
    after = {e.path for e in wh.entries() if e.table_name == "fact_sales"}
    assert done.files_before == len(before) and done.files_read == 1 == len(set(before) - after)
    new = facts(wh)
    assert new["n000", "lamp-1"].quantity == 5 and len(new) == 303 == wh.fact_totals()[0]
    assert all(new[k].sale_id == old[k].sale_id for k in old)
    assert len(facts(wh, wh.entries(1))) == 300  # the version before can still be read


def test_files_hit_matches_a_plain_search(spark, scratch):
    import random

    from lakestar.plans.warehouse import Entry
    rng = random.Random(5)
    wh = Warehouse(spark, scratch)
    text = lambda: "".join(rng.choices("abc", k=rng.randrange(1, 5)))
    for _ in range(8):
        files = [Entry("fact_sales", rng.choice([203101, 203102, 203103]), f"f{i}", 1, 1, "0", *sorted([text(), text()])) for i in range(12)]
        keys = [(rng.choice(["20310105", "20310207", "20310401"]), text()) for _ in range(6)]
        lines = spark.createDataFrame([(int(d), k) for d, k in keys], "date_key int, invoice_no string")
        want = [f.path for f in files if any(int(d) // 100 == f.month_key and f.low <= k <= f.high for d, k in keys)]
        assert sorted(f.path for f in files_hit(wh, lines, files)) == sorted(want)


def test_manifest_measures_equal_a_scan(spark, winter):
    load_star(winter, star_of(spark, sale("o1", "lamp-1", "ann", "2031-01-09", price="0.10"), sale("c4", "lamp-3", "cid", "2031-02-02", qty="8")), "merge", FEB)
    row = winter.read("fact_sales").agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("r"), F.max("sale_id").alias("top")).first()
    assert winter.fact_totals() == (row.n, row.r) and winter.stats("fact_sales") == (row.n, row.top)


def test_a_lost_file_stops_the_load(spark, winter, monkeypatch):
    """What is read back must be what was written."""
    real = Warehouse._measure_fact
    monkeypatch.setattr(Warehouse, "_measure_fact", lambda self, path: real(self, path)[1:])
    with pytest.raises(RuntimeError, match="read back"):
        load_star(winter, star_of(spark, sale("p1", "lamp-1", "ann", "2031-07-01")), "append", FEB)
    assert winter.version() == 1


def test_retries_are_bounded(spark, winter, monkeypatch):
    from lakestar.plans.warehouse import Conflict

    def always(self, *args, **kwargs):
        raise Conflict("taken")

    monkeypatch.setattr(Warehouse, "publish", always)
    with pytest.raises(Conflict):
        loads.load_star(winter, star_of(spark, sale("q1", "lamp-1", "ann", "2031-07-01")), "append", FEB, retries=2)


def test_rekeyed_lines_are_files_not_cached_blocks(spark, winter):
    other = star_of(spark, sale("a9", "lamp-1", "ann", "2031-03-01"))
    lines, n = rekey(other.lines, winter.read("dim_product"), winter.read("dim_customer"), with_count=True)
    assert n == 1 and not lines.storageLevel.useMemory and not lines.storageLevel.useDisk
    assert all("rekeyed-" in f for f in lines.inputFiles()) and lines.inputFiles()


def test_merged_lines_are_written_without_a_sort_by_new(spark, winter):
    from lakestar.operators.merge import merge_facts
    from lakestar.schema import FACT_SALES

    star = star_of(spark, sale("a1", "lamp-1", "ann", "2031-01-03", qty="5"), sale("z9", "lamp-1", "ann", "2031-01-04"))
    lines = rekey(star.lines, winter.read("dim_product"), winter.read("dim_customer"))
    merged, new, updated = merge_facts(winter.read("fact_sales"), lines, list(FACT_SALES.natural_key), 4)
    assert (new, updated) == (1, 1) and not any("_new=" in f for f in merged.inputFiles())
    assert {(r.sale_id, r.invoice_no, r.quantity) for r in merged.collect()} == {
        (1, "a1", 5), (2, "a1", 1), (3, "b7", 3), (4, "c4", 1), (5, "z9", 1)}


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_lines_of_a_first_batch_are_numbered_by_their_places(spark, scratch, monkeypatch, mode):
    """Into an empty fact no line is joined or sorted again; ids follow the ingest order."""
    def never(*args, **kwargs):
        raise AssertionError("joined or sorted")

    monkeypatch.setattr(loads, "merge_facts", never)
    monkeypatch.setattr(loads, "continue_numbering", never)
    rows = [sale(f"n{i % 7}", f"lamp-{i}", "ann", f"2031-0{1 + i % 3}-05", price="x" if i % 10 == 0 else "4.00") for i in range(40)]
    wh = Warehouse(spark, scratch)
    done = load_star(wh, star_of(spark, *rows), mode, JAN)
    want = {(f"n{i % 7}", f"lamp-{i}"): n for n, i in enumerate((i for i in range(40) if i % 10), 1)}
    assert {k: r.sale_id for k, r in facts(wh).items()} == want
    assert done.inserted["fact_sales"] == 36 and done.updated.get("fact_sales", 0) == 0 and done.late_rows_skipped == 0


def test_lines_that_come_twice_are_not_numbered_by_place(spark):
    star = star_of(spark, sale("a1", "lamp-1", "ann", "2031-01-03"), sale("a2", "lamp-1", "ann", "2031-01-03"))
    assert loads.number_all_new(star, star.lines, 2, 5).df.select("sale_id").orderBy("sale_id").collect() == [(6,), (7,)]
    assert loads.number_all_new(star, star.lines.union(star.lines), 4, 5) is None


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_loads_leave_no_shuffle_files_and_no_lines_of_their_own(spark, scratch, mode):
    """Shuffle files go with their query, re-keyed and merged lines with their load; the star stays readable."""
    import glob
    import os

    from lakestar.session import apply_defaults, ensure_checkpoint_dir

    apply_defaults(spark)
    top = ensure_checkpoint_dir(spark).split(":", 1)[-1].replace("//", "/")
    kept = lambda: {x for name in ("merged-*", "lakestar-stage/rekeyed-*") for x in glob.glob(f"{top}/{name}")}
    before = kept()
    wh = Warehouse(spark, scratch)
    rows = [line(f"I{i}", f"S{i % 9}", qty=str(i % 5 + 1), date=f"2025-0{i % 3 + 1}-10", cust=f"C{i % 7}") for i in range(200)]
    for n in (150, 200):
        star = build_star(to_bronze(raw_rows(spark, rows[:n])))
        load_star(wh, star, mode, MAR)
    assert os.path.isdir(top) and kept() == before
    assert star.lines.count() == 200 and wh.read("fact_sales").count() == (200 if mode == "merge" else 150)

    local = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    star.lines.groupBy("customer_id").count().write.parquet(f"{scratch}/counted")
    newest = max(os.path.getmtime(x) for x in glob.glob(f"{scratch}/counted/*"))
    left = [f for x in local for f in glob.glob(f"{x.getPath()}/*/shuffle_*") if os.path.getmtime(f) > newest - 0.5]
    assert not left
