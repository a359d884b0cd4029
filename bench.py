"""Headline queries, each run to completion on local[BENCH_CPUS]; one line of JSON."""

import json
import os
import time

from pyspark.sql import SparkSession

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
NAMES = ["distinct_rows", "set_diff", "change_summary", "multiset_diff", "interval_conflicts", "window_replace", "statement_union", "overlap_pagination", "page_fingerprint", "normalize_projection"]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from strandline.plans.catalogue import QUERIES

    took = {}
    for name in NAMES:
        best = None
        for _ in range(2):
            start = time.time()
            QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
            best = min(best or 1e9, time.time() - start)
        took[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
