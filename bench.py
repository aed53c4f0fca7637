"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gaugeline import build_session  # noqa: E402
from gaugeline.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "D01_daily_rollup",
    "D01_daily_rollup_long",
    "E04_gap_fill",
    "E08_feature_mart_long",
    "E11_seasonal_decompose",
    "A06_incremental_append",
    "D09_describe",
    "D20_exact_quantiles",
    "D21_extreme_days",
    "D25_correlation_matrix",
    "I09_continuous_days",
    "J06_mann_whitney",
    "I18_check_suite",
    "J02_shapiro",
    "J03_qq_points",
    "J08_anova",
    "J14_kendall",
    "K03_time_split",
    "K08_ridge",
    "K12_random_forest",
    "L02_daily_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__python__sql__dataFrameDebugging__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["D01_daily_rollup"](spark, sf_dir).collect()  # warm the JVM
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
