"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "a04_duplicate_rows", "a09_distinct_and_missing", "a10_numeric_profile", "a14_column_roles",
    "a16_top_categories", "a17_numeric_summary", "a18_percentiles_by_counting", "a21_period_counts",
    "a22_row_order", "a24_label_by_numeric", "a25_iqr_outliers", "a26_extreme_values",
    "a28_high_correlations", "a29_majority_positive_categories", "a30_near_duplicates",
    "a32_leakage_findings", "a33_run_all", "c02_parse_number", "c06_timestamp_text",
    "i03_first_id_wins", "i03_first_row_per_key", "i05_source_report", "s05_typed_scan",
    "v16_validate",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from queries import QUERIES
    from riskframe.sources.scratch import clear_scratch, use_scratch_dir

    use_scratch_dir("/tmp/checkpoints")
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskframe-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    wanted = sys.argv[1:]
    times = {}
    for name in HEADLINE:
        if wanted and not any(w in name for w in wanted):
            continue
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            # Every column of every row is computed and thrown away.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "riskframe headline queries, best of two runs, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
