"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and threads.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "silver_slot_mean", "csv_scan_days", "lake_roundtrip", "gold_replace_days", "land_zip", "dedupe_mean_days",
    "complete_grid_days", "impute_rolling_days", "impute", "split_fraction", "standardise", "horizon_target",
    "sequences", "target_threshold", "eval_persistence", "forecast_eval", "day_run",
)


def main() -> None:
    sf_dir = Path(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="roadspeed-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE

    def run(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, str(sf_dir)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    run("silver_slot_mean")  # starts the session's threads and loads classes
    seconds = {name: round(run(name), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
