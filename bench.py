"""Times of the headline queries: one JSON line.

BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pyspark

from millrace import get_session
from millrace.plans import QUERIES

HEADLINE = [
    # grouped, distinct and skew-safe counts
    "table_group_agg", "composite_key_count", "distinct_values", "salted_two_phase", "uv_window", "uv_bitmap",
    # running values per key and over a table
    "running_sum", "running_max_by", "running_top3", "over_rows_bounded", "over_unbounded_global", "running_distinct",
    # windows and rankings
    "tumble_et", "slide_et", "session_et", "count_slide", "hot_items_sql", "hot_items_state", "hot_urls",
    # watermarks, detectors, patterns
    "watermark_replay", "allowed_lateness", "no_drop_alert", "login_fail_burst", "pattern_followed_by", "order_pay_monitor",
    # joins and text
    "interval_join", "reconcile_outer", "match_join", "control_broadcast", "app_word_count",
    # whole pipelines and streams
    "app_ad_clicks", "app_order_timeout", "stream_tumble_et", "stream_keyed_profile",
]
# Pairs that compute the same rows in two ways.
ALTERNATIVES = {
    "hot_items: expansion / panes": ("hot_items_sql", "hot_items_state"),
    "hourly pv: plain / salted": ("app_hourly_pv", "app_hourly_pv_salted"),
    "hourly uv: exact / bitmap": ("app_hourly_uv", "app_hourly_uv_bitmap"),
}


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = get_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("OFF")
    run(spark, "pv_count", sf_dir)
    times, failed = {}, {}
    for name in names:
        try:
            times[name] = run(spark, name, sf_dir)
        except Exception as error:
            failed[name] = str(error)[:200]
    pairs = {}
    if len(sys.argv) == 1:
        for label, both in ALTERNATIVES.items():
            pairs[label] = [min(run(spark, n, sf_dir) for _ in range(2)) for n in both]
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "spark": pyspark.__version__,
        "cores": int(cpus),
        "shuffle_partitions": int(cpus),
        "alternatives": pairs,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
