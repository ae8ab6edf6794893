from __future__ import annotations

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lavra.functions import numbers as N
from lavra.functions import predicates as P
from lavra.functions.jsontext import flatten_nested
from lavra.functions.text import hash_text, row_hash, strip_text, upper_text
from lavra.functions.times import iso_text, parse_iso, seconds_between


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def apply(spark, values, f, kind="string"):
    df = column(spark, values, kind).select("i", f(F.col("c")).alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_strip_and_upper(spark):
    values = ["  São \t Paulo\n", "a  b", "\x1c x \x1f", "", None]
    assert apply(spark, values, strip_text) == ["São Paulo", "a b", "x", "", None]
    assert apply(spark, [" sp ", "ção"], upper_text) == ["SP", "ÇÃO"]


def test_hash_text_of_null_is_hash_of_empty(spark):
    expected = [hashlib.sha256(t.encode()).hexdigest() for t in ("ação", "", "")]
    assert apply(spark, ["ação", "", None], hash_text) == expected


def test_record_hash_joins_text_and_writes_floats_alike(spark):
    floats = [85.0, 0.1, 1e16, 12345678.5, 0.0005, 1.5e-7, 123456789012.25, None, float("nan"), -2.5e20, 0.0]
    df = spark.createDataFrame(
        [(i, "x" if i % 2 else None, v) for i, v in enumerate(floats)], "i int, s string, v double"
    )
    got = {r["i"]: r["h"] for r in df.select("i", row_hash(df, ["i", "s", "v"]).alias("h")).collect()}
    for i, v in enumerate(floats):
        text = "" if v is None or v != v else repr(v)
        want = "|".join([str(i), "x" if i % 2 else "", text])
        assert got[i] == hashlib.sha256(want.encode()).hexdigest(), want


@pytest.mark.parametrize(
    "text,number",
    [("12", 12.0), (" -1.5e2 ", -150.0), ("1d", None), ("abc", None), ("", None), (".5", 0.5), ("5.", 5.0),
     ("inf", float("inf")), ("nan", None), (None, None), ("1 2", None), ("0x1F", None)],
)
def test_to_number(spark, text, number):
    assert apply(spark, [text], N.to_number) == [number]


def test_to_number_of_numbers_turns_nan_to_null(spark):
    assert apply(spark, [1.5, float("nan"), None], N.to_number, "double") == [1.5, None, None]
    assert apply(spark, [7, None], N.to_number, "bigint") == [7.0, None]


def test_numeric_column_never_goes_through_text(spark):
    plan = column(spark, [1.0], "double").select(N.to_number(F.col("c")).alias("n"))._jdf.queryExecution()
    assert "RLIKE" not in plan.optimizedPlan().toString()


def test_year(spark):
    assert apply(spark, ["2023", "2023.0", "2023.5", "x", None], N.to_year) == [2023, 2023, None, None, None]


def test_round_half_even_on_scaled_value(spark):
    assert apply(spark, [0.125, 0.375, 2.675, 1.005, -0.125], N.round2, "double") == [0.12, 0.38, 2.68, 1.0, -0.12]


def test_ratio_by_zero_is_null(spark):
    assert apply(spark, [0.0, 2.0], lambda c: N.safe_ratio(F.lit(1.0), c), "double") == [None, 0.5]


def test_status_order_and_label(spark):
    df = spark.createDataFrame(
        [(90.0, 85.0), (70.0, 80.0), (60.0, None), (None, 80.0), (None, None), (80.0, 80.0)], "v double, t double"
    )
    got = df.select(
        N.target_status(F.col("v"), F.col("t")).alias("s"), N.reached_label(F.col("v"), F.col("t")).alias("l")
    ).collect()
    assert [r["s"] for r in got] == ["ATINGIDA", "NAO_ATINGIDA", "SEM_META", "SEM_RESULTADO", "SEM_META", "ATINGIDA"]
    assert [r["l"] for r in got] == [1, 0, 0, 0, 0, 1]


def test_predicates_are_never_null(spark):
    assert apply(spark, ["a", "  ", "", None, "\t "], P.not_null) == [True, False, False, False, False]
    digits = lambda c: P.matches_regex(c, r"\d{2}")
    assert apply(spark, ["12", "12\n", "123", "a", None, "١٢"], digits) == [True, False, False, False, False, True]
    assert apply(spark, ["SP", "sp", None], lambda c: P.in_set(c, ["SP"])) == [True, False, False]
    ranged = lambda c: P.numeric_between(c, 0, 100)
    assert apply(spark, ["0", "100", "100.1", "x", None, "inf"], ranged) == [True, True, False, False, False, False]
    assert apply(spark, ["1", "1d", None], P.is_numeric) == [True, False, False]
    assert apply(spark, ["1990", "2100", "1989", "2101"], P.year_valid) == [True, True, False, False]


@pytest.mark.parametrize(
    "text",
    ["2026-07-13T10:20:30+00:00", "2026-07-13T10:20:30Z", "2026-07-13 10:20", "2026-07-13", "20260713",
     "2026-07-13T10", "2026-07-13T10:20:30.123456-03:00", "20260713T102030", "2026-W29-1", "2026W291",
     "2026-W29", "2026-07-13T10:20:30,5", "2026-07-13T10:20:30+0530", "2020-W53-7", "2026-07-13T10:20:30.1234567"],
)
def test_parse_iso_accepts_iso_forms(spark, text):
    want = datetime.fromisoformat(text.replace("Z", "+00:00"))
    want = want.replace(tzinfo=timezone.utc) if want.tzinfo is None else want
    micros = apply(spark, [text], lambda c: F.unix_micros(parse_iso(c)))
    assert micros == [round(want.timestamp() * 1e6)]


@pytest.mark.parametrize("text", ["2026", "2026-7-3", "ontem", "", "2026-13-01", "2026-07-13T25:00", "2026-W60-1",
                                  "2021-W53-1", "2026-07-13T", "12:30", None])
def test_parse_iso_refuses_the_rest(spark, text):
    assert apply(spark, [text], parse_iso) == [None]


def test_seconds_and_iso_text(spark):
    df = spark.sql("select timestamp'2026-07-13 00:00:00' a, timestamp'2026-07-13 00:00:01.2345' b")
    r = df.select(seconds_between(F.col("a"), F.col("b")).alias("s"), iso_text(F.col("b")).alias("t")).first()
    assert r["s"] == 1.234
    assert r["t"] == "2026-07-13T00:00:01.234500+00:00"


def test_flatten_nested(spark):
    df = spark.sql("select 1 a, named_struct('x', 1) n, map('k', array(1,2)) m, 's' s")
    r = flatten_nested(df).first()
    assert (r["a"], r["n"], r["m"], r["s"]) == (1, '{"x":1}', '{"k":[1,2]}', "s")
