"""Headline timings: one JSON line. Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import QUERIES  # noqa: E402
from workload.session import set_folder  # noqa: E402

HEADLINE = ["calendar_monthly", "calendar_weekly", "calendar_daily", "avail_by_month",
            "dedup_keep_first", "reviews_clean", "listings_full", "listings_hosts", "price_normalize",
            "price_outliers", "impute_median_by_group", "amenities_long", "quote_flatten",
            "host_concentration", "null_pct", "describe_numeric", "quantiles_by_group",
            "spearman_matrix", "matched_reviews", "step_audit"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    set_folder(spark)
    QUERIES["calendar_monthly"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times), 3)
    print(json.dumps({"metric": "total seconds of the headline queries, best of "
                                f"{runs} runs each, one warm-up query before",
                      "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
