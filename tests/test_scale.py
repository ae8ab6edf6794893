"""Plans at size: hot keys are split, small tables alone are broadcast, scans are pruned."""

from __future__ import annotations

import re
import statistics
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lavra.folders import exists
from lavra.operators import integrity as I
from lavra.operators import median, uniqueness
from lavra.operators import quality as Q
from lavra.operators.median import exact_median
from lavra.operators.uniqueness import duplicated_keys, flag_repeats
from lavra.plans import layers, sales
from lavra.session import drop_stages, shared_folder, stage
from lavra.sources import tables as tb
from lavra.sources.published import Publication
from lavra.streaming.routing import route_events, route_marked, route_marks

SF = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


LARGE_TABLES = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4k",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def executed(df) -> str:
    """The final plan; the frame is run for it."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """A third of the rows have no key; some others repeat."""
    rows = spark.range(60_000).repartition(6).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 25_000).alias("k"),
        F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("body"),
    )
    return stage(rows, "hot")


def test_hot_key_is_split_when_marking_repeats(spark, hot):
    with settings(spark, **{**LARGE_TABLES, "spark__sql__adaptive__enabled": "true"}):
        flagged = flag_repeats(tb.with_positions(hot), ["k"], ["v"])
        text = executed(flagged)
        assert "isSkew=true" in text or "skew=true" in text, text[:3000]
        want = hot.groupBy("k").count().selectExpr("sum(count - 1)").first()[0]
        assert flagged.where("_repeat").count() == want


def test_hot_key_is_split_in_semi_and_anti_joins(spark, hot):
    with settings(spark, **LARGE_TABLES):
        assert "skew=true" in executed(duplicated_keys(hot, ["k"])).replace("isSkew", "skew")
        other = hot.where("k > 20000").select("k")
        orphans = I.anti_join(hot, other, ["k"])
        assert "skew=true" in executed(orphans).replace("isSkew", "skew")
        assert orphans.count() == hot.where("k is null or k <= 20000").count()


def test_match_counts_join_counted_keys(spark, hot):
    joined = plan(I.match_percentage(hot, hot.select("k"), ["k"]))
    assert joined.count("partial_count(1)") >= 1
    assert "CartesianProduct" not in joined and "NestedLoop" not in joined


def test_median_sorts_only_the_middle(spark, hot, monkeypatch):
    sorted_rows = []
    narrowed = median._narrowed

    def watched(rows, most):
        out = narrowed(rows, most)
        sorted_rows.append((rows.count(), out.count()))
        return out

    monkeypatch.setattr(median, "_narrowed", watched)
    rows = exact_median(hot.withColumn("g", F.lit("all")), "g", "v", accuracy=1000)
    assert rows.first()["median"] == 29999.5
    # one group of continuous values and a bracket far wider than what one task may sort
    values = spark.range(40_000).select(F.lit(1).alias("g"), (F.xxhash64("id") / 3.0).alias("v"))
    want = statistics.median(r["v"] for r in values.collect())
    assert exact_median(values, "g", "v", accuracy=20, most=50).first()["median"] == want
    assert sorted_rows[-1][0] > 5_000 and sorted_rows[-1][1] <= 2 * 50


ROW_AT_A_TIME = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups")


@pytest.mark.parametrize(
    "name",
    ["target_comparison", "multi_level_targets", "feature_table", "lineitem_valid_rows", "quality_report",
     "integrity_report", "routed_events", "first_line_per_key", "record_hashes", "normalised_documents"],
)
def test_no_python_and_no_product_of_tables(spark, name):
    text = plan(sales.QUERIES[name](spark, SF))
    assert not ROW_AT_A_TIME.search(text)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(sales.observed_orders(spark, SF))
    assert "EqualTo(o_orderstatus,F)" in text and "IsNotNull(o_totalprice)" in text
    assert "o_orderpriority" not in text and "o_orderdate" not in text
    text = plan(sales.spend_per_year(spark, SF))
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,year:int,spend:double>", text)


def test_key_count_reads_only_keys(spark):
    text = plan(duplicated_keys(sales.table(spark, SF, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_latest_snapshot_is_pruned_to_one_run(spark):
    path = sales._two_runs(spark, SF)
    files = tb.read_latest_snapshot(spark, path).inputFiles()
    assert files and all("_ingestion_id=run-b" in f for f in files)


def test_stages_lie_in_the_shared_folder_and_go(spark):
    df = stage(spark.range(3), "gone")
    (file, *_) = df.inputFiles()
    assert shared_folder(spark).removeprefix("file:") in file
    drop_stages(spark)
    assert not exists(spark, file)


def test_silver_moves_no_whole_rows_and_marks_first_rows_by_their_bits(spark, hot, tmp_path, monkeypatch):
    """Rows of repeated keys, a hot null key among them, in several files; the first one by value is valid."""
    moved = []
    written = Publication.write

    def seen(self, df, path, *args, **kwargs):
        moved.append(plan(df))
        return written(self, df, path, *args, **kwargs)

    monkeypatch.setattr(Publication, "write", seen)
    rows = tb.with_positions(hot)
    spec = Q.QualitySpec("hot", ["k"], [], unique_keys=["k"], order_by=["v"])
    with settings(spark, **LARGE_TABLES):
        result = layers.build_silver(rows, spec, layers.Layout(str(tmp_path / "lake")))
        want = hot.groupBy("k").agg(F.min("v").alias("v"))
        assert result.valid_count == want.count() and result.valid_count + result.invalid_count == hot.count()
        valid = layers.read_silver(spark, layers.Layout(str(tmp_path / "lake")), "hot").select("k", "v")
        assert valid.exceptAll(want).isEmpty() and want.exceptAll(valid).isEmpty()
    sinks = [p for p in moved if "body" in p]
    assert len(sinks) == 2 and all("Exchange hashpartitioning" not in p for p in sinks)


def test_many_marks_are_joined_by_blocks_with_the_same_result(spark, hot, monkeypatch):
    rows = tb.with_positions(hot)
    marks = stage(uniqueness.first_marks(rows, ["k"], ["v"]), "marks")
    few = uniqueness.flag_marked(rows, marks)
    monkeypatch.setattr(uniqueness, "MOST_MARKS", 0)
    with settings(spark, **LARGE_TABLES):
        many = uniqueness.flag_marked(rows, marks)
        assert "BroadcastHashJoin" in plan(few) and "BroadcastHashJoin" not in plan(many)
        one, two = (df.select("v", "_repeat") for df in (few, many))
        assert one.exceptAll(two).isEmpty() and one.count() == two.count() == hot.count()
        plain = flag_repeats(rows, ["k"], ["v"]).select("v", "_repeat")
        assert plain.exceptAll(one).isEmpty()


def test_equal_rows_are_told_apart_by_position(spark, tmp_path):
    same = stage(spark.range(40_000).repartition(3).select(F.lit(1).alias("k"), F.lit(None).cast("string").alias("o")), "same")
    rows = tb.with_positions(same)
    flagged = flag_repeats(rows, ["k"], ["o"], marks=stage(uniqueness.first_marks(rows, ["k"], ["o"]), "marks"))
    assert flagged.where("not _repeat").count() == 1 and flagged.count() == 40_000


def test_a_batch_is_routed_by_marks_as_by_joins_and_moves_no_events(spark):
    ids = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("e"), F.col("id") % 700))
    bad = F.when(F.col("id") % 11 == 0, F.array(F.lit("bad"))).otherwise(F.array().cast("array<string>"))
    events = stage(spark.range(9000).repartition(3).select(ids.alias("event_id"), (F.col("id") % 5).alias("o"), "id", bad.alias("errors")), "events")
    rows, spec = tb.with_positions(events), sales.LINE_EVENTS
    known = spark.createDataFrame([("e1",), ("e2",), ("never",)], "event_id string")
    with settings(spark, **LARGE_TABLES):
        for seen in (known, known.limit(0)):
            marks = stage(route_marks(rows, spec, seen, ["o", "id"]), "marks")
            routed = route_marked(rows, marks)
            want = route_events(rows, spec, seen, ["o", "id"]).select(routed.columns)
            assert routed.exceptAll(want).isEmpty() and routed.count() == want.count() == 9000
            assert "hashpartitioning" not in plan(routed)
