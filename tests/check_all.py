"""Run registered queries against their SQL: ``python tests/check_all.py <sf_dir> [name …]``."""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.compare import connect, difference
from tickloom.session import clear_scratch


def main(sf_dir, names):
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tickloom-shared-")).config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = difference(con, df, sql[name]) if name in sql else None
            note = "" if name in sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            problem, note = f"{type(e).__name__}: {str(e)[:600]}", ""
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or note}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    clear_scratch(spark)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
