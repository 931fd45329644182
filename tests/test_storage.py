"""Written tables leave no shuffle files behind."""

import os
import time

from pyspark.sql import functions as F

from matchloom.operators import storage


def _shuffled(spark):
    """Shuffle files of this session's local folders."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for root in manager.localDirsString() for _, _, names in os.walk(root) for name in names if name.startswith("shuffle_")}


def test_a_written_table_drops_its_shuffles(spark):
    before = _shuffled(spark)
    left = spark.range(2000).select((F.col("id") % 97).alias("k"), "id")
    pairs = left.repartition("k")
    twice = pairs.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 20")
    joined = pairs.join(twice.hint("shuffle_hash"), "k").groupBy("id").agg(F.max("n").alias("n"))
    table, path = storage.written(joined, "dropped")
    for _ in range(50):                                    # executors delete at their own pace
        if _shuffled(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffled(spark) <= before
    assert table.count() == joined.count()                 # the plan itself can still be run
    assert joined.count() == table.count()
    storage.discard(spark, path)


def test_the_session_keeps_its_setting(spark):
    for own in ("true", "false"):
        spark.conf.set(storage.CLEANUP, own)
        with storage.shuffles_dropped(spark):
            assert spark.conf.get(storage.CLEANUP) == "true"
        assert spark.conf.get(storage.CLEANUP) == own
    spark.conf.unset(storage.CLEANUP)
    usual = spark.conf.get(storage.CLEANUP)
    try:
        with storage.shuffles_dropped(spark):
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(storage.CLEANUP) == usual
