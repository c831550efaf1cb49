"""Time the headline queries on the tables in $BENCH_SF_DIR and print one JSON line.

Each query is run once to warm up and then timed; every result row is computed and thrown away by the no-op sink.
"""

import json
import os
import pathlib
import sys
import tempfile
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from millrace import build_session  # noqa: E402
from millrace.queries import QUERIES  # noqa: E402

HEADLINE = [
    "wordcount", "rolling_sum_max_min", "pv_running", "uv_running", "marketing_by_channel", "ad_clicks_by_province",
    "retract_changelog", "udaf_custom_count", "uv_hourly", "uv_hourly_approx", "uv_hourly_bitmap",
    "win_tumble_count", "win_slide_count", "win_session_count", "win_count_tumble", "win_count_slide", "sql_over_count",
    "hot_items_topn", "hot_pages_topn", "ad_province_topn", "ad_user_topn",
    "late_data_audit", "allowed_lateness_refires", "broadcast_rule_asof", "rise_alert", "login_risk_state",
    "blacklist_pass", "blacklist_then_topn", "order_timeout",
    "window_join", "interval_join", "reconcile_matched", "sql_not_in",
    "cep_followed_by", "cep_followed_by_any", "cep_times", "cep_login", "cep_order_match", "cep_order_timeout",
    "stream_win_tumble", "stream_hot_items_topn", "stream_interval_join", "stream_rise_alert",
    "stream_cep_next", "stream_cep_followed_by", "stream_cep_followed_by_any", "stream_cep_times", "stream_cep_order_timeout",
    "stream_over_count", "stream_lateness_refires", "stream_retract_changelog",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    scratch = tempfile.mkdtemp(prefix="millrace-bench-")
    spark = build_session(
        "millrace-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": scratch + "/shared",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        if not name.startswith("stream_"):
            run(spark, name, folder)
        times[name] = round(run(spark, name, folder), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": pathlib.Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
