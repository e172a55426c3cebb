import datetime as dt

from lakestar.plans.warehouse import Warehouse
from lakestar.streaming import start_incremental_load

HEADER = "invoice_no,stock_code,description,quantity,unit_price,invoice_date,customer_id,country\n"


def test_stream_runs_job_per_new_file(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "day1.csv").write_text(HEADER + "INV1,SKU-1,mug,2,5.00,2025-01-01,C-1,UK\n"
                                  "INV2,SKU-2,pen,1,1.50,2025-01-02,C-2,DE\n")
    wh_root, ckpt = str(tmp_path / "wh"), str(tmp_path / "ckpt")
    q = start_incremental_load(spark, str(raw), wh_root, checkpoint_location=ckpt,
                               run_date=dt.date(2025, 1, 3), fail_on_check_error=False)
    q.awaitTermination(300)
    wh = Warehouse(spark, wh_root)
    assert wh.read("fact_sales").count() == 2
    # a new drop: C-1 moved; the stream only processes the new file
    (raw / "day2.csv").write_text(HEADER + "INV3,SKU-1,mug,1,5.00,2025-01-05,C-1,FR\n")
    q = start_incremental_load(spark, str(raw), wh_root, checkpoint_location=ckpt,
                               run_date=dt.date(2025, 1, 6), fail_on_check_error=False)
    q.awaitTermination(300)
    assert wh.read("fact_sales").count() == 3
    versions = wh.read("dim_customer").where("customer_id = 'C-1'").count()
    assert versions == 2
    assert wh.run_history().count() == 2
