"""Events as VARIANT."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra.session import stage
from lavra.streaming.variants import decode_variant_events, extra_field, extra_names

FIELDS = {"id": "string", "year": "int", "rate": "double"}


def decoded(spark, texts):
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_offset long, value string")
    return decode_variant_events(raw, FIELDS)


def test_fields_are_typed_and_extras_keep_their_nesting(spark):
    texts = [
        '{"id": "a", "year": 2026, "rate": 87.5, "geo": {"point": [1.5, 2]}, "tag": "x"}',
        '{"id": 7, "year": "bad", "rate": null}',
        '{"id": "c", "year": 99999999999, "rate": 1}',
    ]
    df = stage(decoded(spark, texts), "variants")  # VARIANT survives the table
    got = df.orderBy("_offset").select(
        *FIELDS, extra_field("$.geo.point[0]", "double").alias("x"), extra_field("$.tag", "int").alias("no"),
        extra_names().alias("names"), "_bad_json",
    ).collect()
    assert [tuple(r) for r in got] == [
        ("a", 2026, 87.5, 1.5, None, ["geo", "tag"], False),
        ("7", None, None, None, None, [], False),
        ("c", None, 1.0, None, None, [], False),
    ]


def test_what_is_no_event_is_bad(spark):
    texts = [None, "", "{", "[1]", "5", "null", "{}"]
    got = decoded(spark, texts).orderBy("_offset").select("_bad_json", "id", F.col("_extra").isNull(), "_raw").collect()
    assert [tuple(r)[:3] for r in got] == [(t != "{}", None, True) for t in texts]
    assert [r["_raw"] for r in got] == texts
    assert decoded(spark, ["x"]).limit(0).count() == 0


def test_one_parse(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("value", F.col("props"))
    plan = decode_variant_events(raw, FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_text_after_the_event_is_kept_as_it_came(spark):
    got = decoded(spark, ['{"id": "a"} x']).first()
    assert (got["id"], got["_bad_json"], got["_raw"]) == ("a", False, '{"id": "a"} x')


def test_names_with_quotes(spark):
    raw = spark.createDataFrame([('{"it\'s": 1, "say \\"x\\"": 2}',)], "value string")
    got = decode_variant_events(raw, {"it's": "int"}).first()
    assert got["it's"] == 1
    with pytest.raises(ValueError, match="quotes"):
        decode_variant_events(raw, {"'\"": "int"})
