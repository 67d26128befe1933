import os
import time

from pyspark.sql import functions as F

from lingotile.session import SHUFFLES_DROPPED, released, written


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, was = _shuffles(spark), spark.conf.get(SHUFFLES_DROPPED, None)
    made = written(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count().repartition(3, "k"))
    for _ in range(50):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffles(spark) - before and spark.conf.get(SHUFFLES_DROPPED, None) == was
    assert made.count() == 700
    path = made._written_path.removeprefix("file:")
    assert os.path.isdir(path)
    released(made)
    assert not os.path.exists(path)
