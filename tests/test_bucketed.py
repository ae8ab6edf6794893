"""Bucketed tables: joins without a shuffle, swaps, and keys too hot for a bucket."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra.sources import bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def measures(spark, n=400):
    return spark.range(n).select((F.col("id") % 100).alias("k"), (F.col("id") % 4).alias("year"), F.col("id").alias("value"))


def test_joins_and_groups_on_the_keys_shuffle_nothing(spark, tmp_path, no_broadcast, rows):
    left, right = str(tmp_path / "left"), str(tmp_path / "it's right")
    names = spark.range(100).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    assert bucketed.write_bucketed(measures(spark), left, ["k"], 4).count == 4
    assert bucketed.write_bucketed(names, right, ["k"], 4).count == 4
    joined = bucketed.read_bucketed(spark, left).join(bucketed.read_bucketed(spark, right), "k")
    summed = joined.groupBy("k", "name").agg(F.sum("value").alias("v"))
    assert "Exchange" not in plan(summed) and "SortMergeJoin" in plan(summed)
    assert "Exchange" in plan(measures(spark).join(names, "k"))
    assert rows(summed) == rows(measures(spark).join(names, "k").groupBy("k", "name").agg(F.sum("value").alias("v")))


def test_a_bucket_is_one_file_and_a_write_is_a_swap(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        bucketed.read_bucketed(spark, path)
    bucketed.write_bucketed(measures(spark), path, ["k", "year"], 4)
    before = bucketed.read_bucketed(spark, path)
    assert len(before.inputFiles()) == 4
    bucketed.write_bucketed(measures(spark, 8).withColumn("more", F.lit("x")), path, ["k", "year"], 2)
    assert bucketed.read_bucketed(spark, path).columns == ["k", "year", "value", "more"]
    assert bucketed.read_bucketed(spark, path).count() == 8
    assert before.count() == 400  # who read the copy before still does


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    bucketed.write_bucketed(measures(spark), path, ["k"], 2)
    broken = measures(spark).withColumn("value", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        bucketed.write_bucketed(broken, path, ["k"], 2)
    assert bucketed.read_bucketed(spark, path).count() == 400


def test_a_hot_key_gets_no_bucket(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    assert bucketed.write_bucketed(hot, path, ["k"], 64).count == 0
    assert rows(bucketed.read_bucketed(spark, path)) == rows(hot)


def test_null_keys_empty_tables_and_odd_names(spark, tmp_path, rows):
    odd = spark.createDataFrame([(None, "a"), (None, "b"), (1, None), (1, None), (2, "c")], "`k ``1` long, `v.clash` string")
    for name, df in (("odd", odd), ("none", odd.limit(0))):
        path = str(tmp_path / name)
        bucketed.write_bucketed(df, path, ["k `1"], 2)
        assert rows(bucketed.read_bucketed(spark, path)) == rows(df)


def test_number_of_buckets():
    assert [bucketed.buckets_for(n << 20) for n in (0, 1, 256, 257, 1000, 1025)] == [1, 1, 1, 2, 4, 8]
    assert bucketed.buckets_for(100 << 40) == 1 << 19


def test_buckets_of_lines_stay_small_enough_for_one_task():
    from lavra.plans.sales import LINE_BUCKET_BYTES

    # a byte of packed lines takes some 20 in the task that sorts it
    for size in (50 << 20, 460 << 20, 2760 << 20, 30 << 30):
        assert size / bucketed.buckets_for(size, LINE_BUCKET_BYTES) * 20 <= 400 << 20
