"""Wall time of the headline queries: one warm-up and the median of three runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "gold_integrated_schedule",
    "gold_schedule_change_history",
    "gold_hourly_workload",
    "gold_today_schedule",
    "silver_from_bronze",
    "historical_silver",
    "interval_islands",
    "berth_occupancy",
    "monthly_terminal_ops",
    "gold_ml_features",
    "forecast_features",
]
RUNS = 3


def main() -> None:
    from berthlake.registry import load_all
    from berthlake.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = load_all()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        laps = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            catalog[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 3)
    print(json.dumps({
        "metric": "sum of median wall times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
