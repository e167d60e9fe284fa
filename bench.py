"""Seconds per query; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the cores (default 8), ``BENCH_QUERIES``
a comma-separated choice of queries. Each query runs once to warm up and then ``BENCH_RUNS`` times, all
rows are produced, and the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from quoteloom.queries import REGISTRY
from quoteloom.session import build_session

HEADLINES = """
latest_bar bars_from_ticks bars_weekly bars_monthly last_writer_wins batch_bars_clean wide_to_long_bars
moving_averages high_low_52w avg_volume_10 trading_snapshot bars_with_attributes period_filter_5d
index_membership index_flags_fixed universe_by_choice symbol_list_union
history_upsert_new_wins bulk_upsert_old_wins history_incremental bulk_snapshot_merge bulk_backfill
staleness_report newly_rejected portfolio_clean_info
fundamentals_wide growth_yoy growth_acceleration canslim_score screen_funnel
ratio_extract ratio_upsert html_table_rows directory_symbols tz_suffix_restore
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
