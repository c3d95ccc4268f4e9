"""Times the headline queries over whole tables and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (comma separated)
other queries than the headline ones, BENCH_RUNS the timed runs per query (the best one counts).
Every result is computed in full and thrown away by Spark's noop sink.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barwright.registry import QUERIES  # noqa: E402
from barwright.session import make_session  # noqa: E402

HEADLINE = [
    "bars_from_lineitem",
    "silver_bars",
    "silver_bars_part",
    "silver_audit",
    "quality_report_clean",
    "daily_return_incremental",
    "daily_metrics",
    "daily_metrics_part",
    "portfolio_summary_part",
    "monthly_returns_part",
    "max_drawdown",
    "sector_performance",
    "correlation_matrix",
    "equal_weight_backtest",
    "bollinger_bands",
    "volume_anomalies",
    "return_histogram",
    "monthly_heatmap",
    "gold_roundtrip_part",
    "full_batch",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = make_session(
        "barwright-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    timings = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - start
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
        print(f"{name}: {best:.3f}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
