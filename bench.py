"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEATS
(default 3). Every query runs once unmeasured, then the median of the repeats counts. A
query is timed from building its plan to its last row in a noop sink; ``until_planned`` is the
part before the last job starts. ``rows_per_sec`` has the queries that read all of lineitem.
``calibration`` is a fixed aggregate over generated numbers, which tells machines apart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue import QUERIES  # noqa: E402

HEADLINE = (
    "bench_types", "bench_label_types", "mart_cube", "all_marts", "hourly_counts",
    "time_period_counts", "season_counts", "yearly_counts", "holiday_split", "flag_month",
    "flag_dates", "flag_pivot", "per_day_rate", "period_types", "top_type_on_dates",
    "normalize_label", "location_counts", "top_type_per_category", "rank_types_big_labels",
    "share_by_label", "join_aggregates", "area_rate", "transit_rate", "airport_rate",
    "top_areas_geo", "clean_incidents", "dedup_by_key", "typed_view", "key_violations",
    "monthly_trend", "monthly_trend_by_type", "dense_series", "model_choice", "ets_forecast",
    "series_analysis", "forecast_metrics", "route_texts", "summarize", "vector_topk",
)
SCANS = ("bench_types", "bench_label_types", "mart_cube", "all_marts", "yearly_counts", "monthly_trend",
         "clean_incidents", "dedup_by_key")


def run(query, spark, sf_dir: str) -> tuple[float, float]:
    """Seconds until the plan stands (jobs that run while it is built included), and in all."""
    start = time.perf_counter()
    df = query(spark, sf_dir)
    built = time.perf_counter() - start
    df.write.format("noop").mode("overwrite").save()
    return built, time.perf_counter() - start


def calibration(spark) -> float:
    """Seconds for a fixed aggregate over 50 million generated numbers, the best of three after one unmeasured."""
    def once() -> float:
        start = time.perf_counter()
        spark.range(0, 50_000_000, 1, 16).selectExpr("id % 1000 AS k", "id * 7 % 13 AS v").groupBy("k").sum(
            "v").write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return min(once() for _ in range(3))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("civitally-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, planning = {}, {}
    machine = round(calibration(spark), 3)
    for name in HEADLINE:
        query = QUERIES[name]
        run(query, spark, sf_dir)
        timed = [run(query, spark, sf_dir) for _ in range(repeats)]
        planning[name], seconds[name] = (round(statistics.median(x), 3) for x in zip(*timed))
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    both = seconds["bench_types"] + seconds["bench_label_types"]
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "until_planned": planning, "sf": Path(sf_dir).name.removeprefix("sf"), "rows": rows,
        "aggregate_rows_per_sec": round(rows / both),
        "rows_per_sec": {name: round(rows / seconds[name]) for name in SCANS}, "cpus": int(cpus), "repeats": repeats,
        "calibration": machine, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
