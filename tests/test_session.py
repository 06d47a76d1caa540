"""What a cut of the lineage leaves behind."""

import time

from pyspark.sql import functions as F

from tickframe.session import cut_lineage, shuffles_removed


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_of(spark, before):
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left


def test_shuffles_go_with_a_cut(spark):
    """Before, the files of a finished shuffle stayed for as long as anything referred to its plan."""
    before = shuffle_files(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("a")).count()
    cut = cut_lineage(counted)
    assert not left_of(spark, before)
    # Both can be used again, also after the frame itself has been run.
    for frame in (cut, counted, cut.join(counted.withColumnRenamed("count", "n"), "a").select("a", "n"), counted):
        assert {r[0]: r[1] for r in frame.collect()} == {i: 1000 // 7 + (i < 1000 % 7) for i in range(7)}
    assert {r[0] for r in cut_lineage(counted).select("a").collect()} == set(range(7))


def test_the_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    with shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == was
