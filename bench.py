"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is planned anew and written to a no-op sink, so all its columns are computed.
The first query is run once before to warm the session up. With $BENCH_RUNS above 1 the last run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = """agg_02_revenue_by_category agg_05_user_behavior agg_09_customer_summary agg_11_cohort_analysis agg_12_cube_revenue
agg_14_exact_quantiles agg_25_region_product_summary join_01_top_customers join_08_asof_join win_01_purchase_sequence win_02_ranked_orders
win_03_running_total win_12_daily_growth cdc_01_latest_image cdc_02_order_details cdc_10_scd2 dq_02_duplicate_profile dq_03_rule_counts
fea_03_rolling_features gra_03_pagerank sea_01_cosine_topk sta_04_online_features str_02_sliding_revenue str_10_session_windows
str_11_session_profile ts_01_indicators""".split()


def main() -> None:
    from tidewell.plans import catalog
    from tidewell.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    catalog.QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
