"""The index of seen ids: exact, pruned to the buckets that may hold an id, and merged."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra.sources.published import Publication, markers
from lavra.streaming import seen as S
from lavra.streaming.routing import new_events


def ids(spark, *values):
    return spark.createDataFrame([(str(v),) for v in values], "id string")


def added(index, df, name):
    with Publication(index.spark) as run:
        return index.add(run, df, name)


@pytest.fixture
def index(spark, tmp_path):
    return S.SeenIndex(spark, str(tmp_path / "index"), bucket_ids=100)


def test_an_empty_index_knows_nothing(spark, index):
    assert index.known(ids(spark, 1, 2)).count() == 0
    assert added(index, ids(spark).limit(0), "none") == 0 and index.generations() == []
    assert index.known(ids(spark, 1)).count() == 0 and index.merge() == 0


def test_known_is_exact_over_generations(spark, index, rows):
    assert added(index, spark.range(1500).select(F.col("id").cast("string")), "a") == 1500
    assert added(index, spark.range(5000, 5050).select(F.col("id").cast("string")), "b") == 50
    got = rows(index.known(ids(spark, 0, 1499, 1500, 5000, 5049, 5050, "x", "")))
    assert got == [("0",), ("1499",), ("5000",), ("5049",)]
    every = index.known(spark.range(0, 6000).select(F.col("id").cast("string")))
    assert every.count() == 1550


def test_ids_of_other_types_and_nulls(spark, index, rows):
    added(index, spark.createDataFrame([(1,), (None,), (7,)], "key long"), "a")
    assert rows(index.known(spark.createDataFrame([(1,), (2,), (None,)], "key long"))) == [(1,)]


def test_filters_never_miss_and_seldom_pass(spark):
    buckets, words = 4, S._power(S.BITS * 250 / 64)
    held = spark.range(1000).select(S._bucket(F.col("id").cast("string"), buckets).alias("bucket"), F.col("id").cast("string"))
    made = S.filters(held, buckets, words)
    assert {(len(r["bits"])) for r in made.collect()} == {words} and made.count() == buckets

    def passing(df):
        placed = df.select(F.col("id").cast("string")).withColumn("bucket", S._bucket(F.col("id"), buckets))
        return placed.join(made, "bucket").where(S.may_hold(F.col("bits"), F.col("id"))).count()

    assert passing(spark.range(1000)) == 1000
    assert passing(spark.range(10_000, 30_000)) < 20_000 * 0.03


def test_a_look_up_reads_few_buckets(spark, index):
    added(index, spark.range(6400).select(F.col("id").cast("string")), "a")
    assert markers(spark, index.ids_path)[0].partition["buckets"] == "64"
    asked = ids(spark, 17, 4711, "new", "newer")
    rows = index.bucket_rows(index.hits(asked))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1]
    assert len({r["bucket"] for r in rows.select("bucket").distinct().collect()}) <= 3
    assert rows.count() < 6400 / 64 * 3 * 2
    assert index.bucket_rows(index.hits(ids(spark, *[f"n{i}" for i in range(3)]))) is None or rows.count() < 1000


def test_generations_are_merged_in_one_step(spark, index, monkeypatch):
    for g in range(S.FAN_IN):
        added(index, spark.range(g * 100, g * 100 + 100).select(F.col("id").cast("string")), f"g{g}")
    with monkeypatch.context() as patch:
        patch.setattr(Publication, "publish", lambda self: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            index.merge()
    assert len(index.generations()) == S.FAN_IN and index.known(ids(spark, 5, 705, 900)).count() == 2
    assert index.merge() == S.FAN_IN
    (one,) = index.generations()
    assert one.rows == 800 and one.partition["buckets"] == "8"
    assert index.known(spark.range(0, 1000).select(F.col("id").cast("string"))).count() == 800
    assert index.merge() == 0


def test_new_events_against_the_index(spark, index, rows):
    added(index, ids(spark, "b"), "a")
    events = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "id string, n int").coalesce(1)
    known = index.known(events.select("id").distinct())
    assert rows(new_events(events, "id", known).where("is_new"), "n") == [(1,), (4,)]
