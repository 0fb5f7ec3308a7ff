"""Run queries by key pattern against their SQL: ``python tests/check.py [pattern] [sf or folder]``."""

import os
import re
import sys
import tempfile
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from pyspark.sql import SparkSession  # noqa: E402

import oracle  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from lakeloom.session import build_session  # noqa: E402


def main():
    pattern = sys.argv[1] if len(sys.argv) > 1 else ""
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "0.01"
    if "/" not in sf_dir:
        sf_dir = f"/root/testdata/sf{sf_dir}"
    if os.environ.get("CHECK_PLAIN"):  # a session with Spark's own defaults
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("check", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "20g", "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-shared-"),
        })
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for key, fn in queries().items():
        if not re.search(pattern, key):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if key in sqls:
                problem = oracle.differences(df, con, sqls[key])
                note = "ok"
            else:
                problem, note = None, f"{len(df.collect())} rows"
        except Exception as e:  # report and go on
            problem, note = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += problem is not None
        print(f"{key:32s} {time.time() - start:6.2f}s {'FAIL ' + problem if problem else note}", flush=True)
    print("failures:", bad)


main()
