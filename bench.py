"""Headline queries, timed: one warm-up and the median of three runs each; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs), BENCH_QUERIES,
BENCH_SHARED_DIR (the folder that executors share; in local mode a new temporary one).
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tickloom.plans import catalog
from tickloom.session import clear_scratch

HEADLINE = ["bollinger_bands", "rsi", "stochastic_multi", "indicator_set", "indicator_set_by_supplier", "sharpe",
            "melt_subset", "explode_units", "infer_document_schema", "row_index_by_key", "gramian", "tall_skinny_qr",
            "matmul"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tickloom-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="tickloom-shared-"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({"metric": "headline queries, sum of median wall seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus)}))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
