from pyspark.sql import functions as F

from lakeloom.llm import common


def test_saved_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {f for f in found.split(",") if "shuffle_" in f}

    usual, before = spark.conf.get(common.CLEANUP), files()
    table = common.saved(spark.range(10_000).groupBy(F.xxhash64("id").alias("k")).count(), "grouped")
    assert not files() - before
    assert spark.conf.get(common.CLEANUP) == usual and table.count() == 10_000
