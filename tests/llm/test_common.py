import time
from pathlib import Path

from pyspark.sql import functions as F

from scholar_lake.llm.common import REMOVE_SHUFFLES, settle


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in Path(folder).rglob("shuffle_*")}


def test_settled_rows_keep_no_shuffle_files(spark):
    counts = spark.range(1000).groupBy((F.col("id") % 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    frame = counts.join(spark.range(60).withColumnRenamed("id", "k").hint("merge"), "k", "full")
    before, switch = shuffle_files(spark), spark.conf.get(REMOVE_SHUFFLES)
    settled = settle(frame)
    end = time.time() + 10
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(REMOVE_SHUFFLES) == switch
    expected = sorted((k, 20 if k < 50 else None) for k in range(60))
    for rows in (settled, settled.repartition(3, "k"), settle(frame), frame):  # what was settled can be read, settled and run again
        assert sorted(tuple(r) for r in rows.collect()) == expected
