"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (warm runs).
Every query is run once to warm up; its figure is the median of the warm runs, each
computing the whole result without storing it. Model training runs once warm.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowcast.queries import all_queries  # noqa: E402
from flowcast.session import local_session  # noqa: E402
from flowcast.sources.staging import staging  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "hourly_counts", "hourly_counts_by_location", "hourly_pivot", "hourly_total_grid",
    "hourly_grid_by_type", "hourly_features", "row_lag_interleaved", "daily_resample",
    "hour_of_day_mean", "series_bounds", "forecast_metrics_nonzero", "future_features",
    "seq_id", "dimension_ids", "profile_allocate", "count_expand", "ball_by_ball",
    "match_info", "team_players", "officials_by_role", "parse_props", "json_roundtrip",
    "csv_roundtrip", "parquet_compact", "write_audit", "gram_sums", "ar_forecast",
    "seasonal_ar_forecast", "fourier_forecast", "model_errors", "report_daily",
    "forest_holdout", "forest_recursive",
]


def timed(run, spark):
    with staging(spark):
        start = time.perf_counter()
        run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main():
    spark = local_session("flowcast-bench", **{"spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="flowcast-bench-")})
    queries, seconds = all_queries(), {}
    for name in HEADLINE:
        timed(queries[name], spark)
        runs = 1 if name.startswith("forest") else RUNS
        seconds[name] = round(statistics.median(timed(queries[name], spark) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
