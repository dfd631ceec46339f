"""Written steps: their folders and shuffle files go when told to, and results stay."""

import os

from pyspark.sql import functions as F

from larkspur import session

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_steps_without_their_shuffles(spark):
    before = spark.conf.get(KEY, None)
    with session.shuffles_dropped(spark):
        assert spark.conf.get(KEY) == "true"
        first = session.written(spark, spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "step")
        second = session.written(spark, first.frame.groupBy("count").agg(F.min("k").alias("k")), "step")
        again = first.frame.groupBy("count").count()
        assert again.count() == again.count() == 2
        session.remove_folder(spark, first.folder)
    assert spark.conf.get(KEY, None) == before
    assert not os.path.exists(first.folder.removeprefix("file:"))
    assert sorted(tuple(r) for r in second.frame.collect()) == [(142, 6), (143, 0)]


def test_setting_is_restored_after_an_error(spark):
    before = spark.conf.get(KEY, None)
    try:
        with session.shuffles_dropped(spark):
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(KEY, None) == before


def test_rows_of_a_task_do_not_grow_with_the_table(spark):
    df = spark.range(0, 5000, 1, 8).withColumn("x", F.col("id") % 3)
    dealt = session.spread(df, 100)
    sizes = [len(part) for part in dealt.rdd.glom().collect()]
    assert len(sizes) == 50 and sum(sizes) == 5000 and max(sizes) < 200
    assert session.spread(df, 5000).rdd.getNumPartitions() == 8
    # not fewer than there are cores
    assert session.spread(df, 2500).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
