from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra.operators import quality as Q
from lavra.operators.quality import CriticalSchemaError, run_quality
from lavra.operators.uniqueness import duplicated_keys, flag_repeats, keep_first
from lavra.plans.literacy import SOURCES, SPECS
from lavra.sources import tables as tb

BASE = [("3550308", "  São Paulo ", "sp"), ("3304557", "Rio de Janeiro", "RJ")]


def table(spark, data):
    return spark.createDataFrame(data, "id_municipio string, nome string, sigla_uf string")


def failures(spark, data):
    result = run_quality(table(spark, data), SPECS["municipio"]())
    return result, result.report.first()


def test_valid_rows_are_standardised(spark, rows):
    result, report = failures(spark, BASE)
    assert rows(result.valid) == [("3304557", "Rio de Janeiro", "RJ"), ("3550308", "São Paulo", "SP")]
    assert (report["status"], report["total_read"], report["invalid_count"]) == ("PASSED", 2, 0)
    assert report["failures_by_rule"] == {}
    assert [r["rule"] for r in report["rule_results"]] == [
        "id_municipio.not_null", "id_municipio.seven_digits", "nome.not_null", "sigla_uf.not_null",
        "sigla_uf.valid_uf", "unique.id_municipio",
    ]


@pytest.mark.parametrize(
    "change,rule",
    [((0, 2, "XX"), "sigla_uf.valid_uf"), ((0, 0, "355"), "id_municipio.seven_digits"), ((0, 1, "   "), "nome.not_null")],
)
def test_one_bad_value(spark, change, rule):
    data = [list(r) for r in BASE]
    data[change[0]][change[1]] = change[2]
    result, report = failures(spark, [tuple(r) for r in data])
    assert report["failures_by_rule"] == {rule: 1}
    assert report["status"] == "PASSED_WITH_WARNINGS"
    assert result.invalid.first()["_failed_rules"] == [rule]


def test_repeated_key_keeps_the_first_row(spark, rows):
    result, report = failures(spark, BASE + [("3550308", "Cópia", "SP")])
    assert report["failures_by_rule"] == {"unique.id_municipio": 1}
    assert rows(result.invalid, "nome") == [("Cópia",)]


def test_missing_column_stops_the_run(spark):
    with pytest.raises(CriticalSchemaError):
        run_quality(table(spark, BASE).drop("sigla_uf"), SPECS["municipio"]())


def test_uniqueness_does_not_depend_on_rules(spark):
    _, report = failures(spark, [("3550308", "A", "XX"), ("3550308", "B", "SP")])
    assert report["failures_by_rule"] == {"sigla_uf.valid_uf": 1, "unique.id_municipio": 1}
    assert report["valid_count"] == 0


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert keep_first(df, ["k"], ["v"]).count() == 2
    assert duplicated_keys(df, ["k"]).count() == 2
    assert duplicated_keys(df, ["absent"]).count() == 0


def test_explicit_order_and_equal_rows(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 1), ("b", 2)] * 50, "k string, v int").repartition(7)
    flagged = flag_repeats(df, ["k"], ["v"])
    assert rows(flagged.where("not _repeat"), "k", "v") == [("a", 1), ("b", 2)]
    assert flagged.count() == 200


def test_one_key_with_most_rows(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    flagged = flag_repeats(df, ["k"], ["v"])
    assert flagged.where("_repeat").count() == 9999
    assert flagged.where("k is null and not _repeat").first()["v"] == 0


def test_student_id_is_checked_before_it_is_hashed(spark):
    df = spark.createDataFrame(
        [("2024", "s1", "municipal"), ("2024", None, "x"), ("2024", " ", "x"), ("2024", "s1", "x")],
        "ano string, id_aluno string, rede string",
    )
    result = run_quality(df, SPECS["aluno"]())
    report = result.report.first()
    assert report["failures_by_rule"] == {"id_aluno.not_null": 2, "unique.ano_id_aluno": 1}
    valid = result.valid.first()
    assert len(valid["id_aluno"]) == 64 and valid["rede"] == "MUNICIPAL"
    assert result.invalid.where("id_aluno = 's1'").count() == 0


def test_specs_agree_with_contracts(spark):
    for name, source in SOURCES.items():
        spec = SPECS[name]()
        assert set(source.keys) <= set(source.selected)
        assert set(spec.required) <= set(source.selected)
        assert set(spec.unique_keys) <= set(source.selected)


@pytest.mark.parametrize(
    "entity,data,schema,expected",
    [
        ("uf", [("35", "sp", "São Paulo"), ("3", "SP", " ")], "codigo_uf string, sigla_uf string, nome string",
         {"codigo_uf.two_digits": 1, "nome.not_null": 1, "unique.sigla_uf": 1}),
        ("meta_brasil", [(2023, 80.0), (1900, 101.0)], "ano int, valor_meta double",
         {"ano.valid_year": 1, "valor_meta.in_range": 1}),
        ("meta_uf", [(2023, "sp", 80.0), (2023, "ZZ", None)], "ano int, sigla_uf string, valor_meta double",
         {"sigla_uf.valid_uf": 1, "valor_meta.in_range": 1}),
        ("meta_municipio", [(2023, "3550308", 80.0), (2023, "3550308", 70.0)],
         "ano int, id_municipio string, valor_meta double", {"unique.ano_id_municipio": 1}),
        ("indicador_alfabetizacao", [(2023, "3550308", 80.0), (2023, "12", float("nan"))],
         "ano int, id_municipio string, taxa_alfabetizacao double",
         {"id_municipio.seven_digits": 1, "taxa_alfabetizacao.in_range": 1}),
    ],
)
def test_shipped_specs(spark, entity, data, schema, expected):
    report = run_quality(spark.createDataFrame(data, schema), SPECS[entity]()).report.first()
    assert report["failures_by_rule"] == expected


def test_report_counts_keys_in_one_shuffle(spark, tmp_path):
    """The counts of the marked rows, null keys, order ties and a first row that fails another rule among them."""
    path = str(tmp_path / "t")
    spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 500).alias("k"), (F.col("id") % 9).cast("string").alias("o"), (F.col("id") % 4).alias("v")
    ).repartition(3).write.parquet(path)
    rows = tb.with_positions(spark.read.parquet(path))
    spec = Q.QualitySpec("t", ["k"], [Q.Rule("v.some", F.col("v") > 0, "v"), Q.Rule("k.set", F.col("k").isNotNull(), "k")], ["k"], ["o"])
    plain = Q.count_failures(Q.check_keys(Q.check_rows(rows, spec), spec), spec)
    result = Q.run_quality(rows, spec)
    line, want = result.report.first(), plain.first()
    assert (line["total_read"], line["valid_count"]) == (want["total_read"], want["valid_count"])
    assert [r["failed_count"] for r in line["rule_results"]] == [want["c0"], want["c1"], want["c2"]]
    assert "Join" not in result.report._jdf.queryExecution().executedPlan().toString().replace("NestedLoopJoin", "")
    assert Q.run_quality(rows.where("k < 0"), spec).report.first()["valid_count"] == 0
