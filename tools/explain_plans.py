"""Print formatted plans of key queries and flag shuffle/partition patterns.

Usage: python tools/explain_plans.py [sf_dir] > plans.txt
"""
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from lakestar.session import local_session
spark = local_session(8)
from pyspark.sql import functions as F
from lakestar.plans import catalog as C
from lakestar.operators import serving
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
wh, _ = C.replace_flow(spark, sf)
stored = C._stored_star(wh)
out = {}
for name in ["revenue_by_category", "revenue_by_country", "top_products", "dashboard_bundle", "monthly_revenue"]:
    out[name] = plan(getattr(serving, name)(stored))
out["fact_build"] = plan(C.star_for(spark, sf).fact_sales)
out["classified"] = plan(C.classified_for(spark, sf))
out["dim_product"] = plan(C.star_for(spark, sf).dim_product)
for k, v in out.items():
    flags = [t for t in ("SinglePartition", "Window", "BroadcastHashJoin", "SortMergeJoin", "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]", "SortAggregate", "HashAggregate", "Expand") if t in v]
    print(k, "->", flags)
    rs = [l.strip()[:150] for l in v.splitlines() if l.strip().startswith("ReadSchema")]
    for r in rs[:4]: print("    ", r)
print("\n\n".join(f"## {k}\n{v}" for k, v in out.items()))
