from __future__ import annotations

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lavra.operators import products as prod
from lavra.operators.integrity import (
    IntegrityCheck,
    anti_join,
    incompatible_periods,
    integrity_report,
    match_percentage,
)
from lavra.operators.median import exact_median
from lavra.plans import literacy as lit

DIM = [("3550308", "São Paulo", "SP"), ("3304557", "Rio de Janeiro", "RJ"), ("2927408", "Salvador", "BA")]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(DIM, "id_municipio string, nome string, sigla_uf string")


@pytest.fixture
def measure(spark):
    return spark.createDataFrame(
        [("2023", "3550308", 90.0), ("2023", "3304557", 70.0), ("2023", "2927408", 60.0)],
        "ano string, id_municipio string, taxa_alfabetizacao double",
    )


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("2023", "3550308", 85.0), ("2023", "3304557", 80.0)], "ano string, id_municipio string, valor_meta double"
    )


@pytest.fixture
def compared(measure, target, dim):
    return lit.indicador_municipio_ano(measure, target, dim, "2026-07-13")


def by_id(df, *columns):
    return {r["id_municipio"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_target_comparison(compared):
    assert compared.columns == [
        "ano", "id_municipio", "nome_municipio", "sigla_uf", "regiao", "taxa_alfabetizacao", "meta_municipal",
        "diferenca_meta", "percentual_atingimento", "status_meta", "data_atualizacao",
    ]
    assert by_id(compared, "status_meta", "regiao", "diferenca_meta", "percentual_atingimento") == {
        "3550308": ("ATINGIDA", "Sudeste", 5.0, 105.88),
        "3304557": ("NAO_ATINGIDA", "Sudeste", -10.0, 87.5),
        "2927408": ("SEM_META", "Nordeste", None, None),
    }


def test_zero_and_absent_targets(spark, measure, dim):
    zero = spark.createDataFrame([("2023", "3550308", 0.0)], "ano string, id_municipio string, valor_meta double")
    got = by_id(lit.indicador_municipio_ano(measure, zero, dim), "percentual_atingimento", "status_meta")
    assert got["3550308"] == (None, "ATINGIDA")
    got = by_id(lit.indicador_municipio_ano(measure, None, dim), "meta_municipal", "status_meta")
    assert set(got.values()) == {(None, "SEM_META")}


def test_multi_level_targets(spark, compared):
    uf = spark.createDataFrame([("2023", "SP", 88.0)], "ano string, sigla_uf string, valor_meta double")
    br = spark.createDataFrame([("2023", 82.0)], "ano string, valor_meta double")
    got = by_id(lit.meta_vs_resultado(compared, uf, br), "dif_abs_estadual", "dif_abs_nacional", "dif_pct_municipal")
    assert got["3550308"] == (2.0, 8.0, 105.88)
    assert got["2927408"] == (None, -22.0, None)
    got = by_id(lit.meta_vs_resultado(compared, None, None), "meta_estadual", "meta_nacional")
    assert got["3550308"] == (None, None)


SERIES = [("3550308", 2022, 85.0), ("3550308", 2021, 80.0), ("3550308", 2023, 90.0)]


@pytest.mark.parametrize("unique", [True, False])
def test_time_evolution(spark, unique):
    df = spark.createDataFrame(
        SERIES + [("1", 2021, None), ("1", 2024, 5.0), ("1", None, 7.0), (None, 2021, 1.0), (None, 2022, 2.0)],
        "id_municipio string, ano int, taxa_alfabetizacao double",
    )
    evo = lit.evolucao_temporal(df, unique_periods=unique)
    got = {
        (r["codigo_localidade"], r["ano"]): (r["taxa_ano_anterior"], r["variacao_anual"], r["variacao_acumulada"])
        for r in evo.collect()
    }
    assert got == {
        ("3550308", 2021): (None, None, 0.0),
        ("3550308", 2022): (80.0, 5.0, 5.0),
        ("3550308", 2023): (85.0, 5.0, 10.0),
        ("1", 2021): (None, None, None),
        ("1", 2024): (None, None, 0.0),
        ("1", None): (5.0, 2.0, 2.0),
        (None, 2021): (None, None, None),
        (None, 2022): (None, None, None),
    }
    assert evo.first()["nome_localidade"] == evo.first()["codigo_localidade"]


def test_time_evolution_of_repeated_periods_follows_input_order(spark, monkeypatch):
    monkeypatch.setattr(prod, "STRETCH_ROWS", 3)
    rng = random.Random(5)
    data = [
        (rng.choice(["a", "a", "a", "b"]), rng.choice([2020, 2021]), rng.choice([None, 1.0, 2.0, 3.0, 4.5]))
        for _ in range(120)
    ]
    df = spark.createDataFrame(data, "e string, p int, v double").coalesce(1)
    got = prod.time_evolution(df, entity="e", period="p", value="v", kind="x")
    want = []
    for e in ("a", "b"):
        series = sorted(((p, i, v) for i, (x, p, v) in enumerate(data) if x == e), key=lambda t: t[:2])
        start = next((v for _, _, v in series if v is not None), None)
        for k, (p, _, v) in enumerate(series):
            prev = series[k - 1][2] if k else None
            change = None if v is None or prev is None else v - prev
            want.append((e, p, v, prev, change, None if v is None else v - start))
    read = [
        (r["entity_code"], r["p"], r["v"], r["previous_value"], r["period_change"], r["cumulative_change"])
        for r in got.collect()
    ]
    assert sorted(read, key=str) == sorted(want, key=str)


def test_group_summary(spark, compared):
    uf = spark.createDataFrame([("SP", 88.0), ("SP", 90.0)], "sigla_uf string, valor_meta double")
    got = {r["sigla_uf"]: r for r in lit.resumo_uf(compared, uf).collect()}
    sp = got["SP"]
    assert (sp["media"], sp["mediana"], sp["qtd_municipios"], sp["municipios_atingiram_meta"]) == (90.0, 90.0, 1, 1)
    assert (sp["percentual_atingiu"], sp["meta_estadual"], sp["dif_media_para_meta_estadual"]) == (100.0, 89.0, 1.0)
    assert (got["BA"]["percentual_atingiu"], got["BA"]["meta_estadual"]) == (0.0, None)
    assert lit.resumo_uf(compared, None).where("sigla_uf = 'SP'").first()["meta_estadual"] is None


def test_summary_leaves_out_rows_without_group_and_counts_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "ATINGIDA"), ("a", None, "SEM_RESULTADO"), (None, 9.0, "ATINGIDA"), ("b", None, "SEM_META")],
        "g string, v double, status string",
    )
    got = {r["g"]: r for r in prod.group_summary(df, "g", value="v").collect()}
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a["row_count"], a["with_value"], a["without_value"], a["reached_pct"]) == (2, 1, 1, 50.0)
    assert (got["b"]["mean"], got["b"]["median"], got["b"]["minimum"]) == (None, None, None)


def test_features(spark, compared, measure):
    feats = lit.ml_features_municipio(compared, lit.evolucao_temporal(measure))
    assert by_id(feats, "atingiu_meta") == {"3550308": (1,), "3304557": (0,), "2927408": (0,)}
    assert feats.columns == [
        "ano", "id_municipio", "sigla_uf", "regiao", "taxa_alfabetizacao", "meta_municipal", "diferenca_meta",
        "variacao_anual", "atingiu_meta",
    ]


def test_status_counts_and_top_groups(spark, rows, compared):
    assert rows(prod.status_counts(compared, "status_meta")) == sorted(
        [("ATINGIDA", 1), ("NAO_ATINGIDA", 1), ("SEM_META", 1), (None, 3)], key=lambda t: [(v is None, str(v)) for v in t]
    )
    top = prod.top_groups(compared, "sigla_uf", "taxa_alfabetizacao", "status_meta", 2).collect()
    assert [(r["sigla_uf"], r["mean"]) for r in top] == [("SP", 90.0), ("RJ", 70.0)]
    means = prod.group_means(compared, "sigla_uf", "taxa_alfabetizacao").collect()
    assert [r["sigla_uf"] for r in means] == ["SP", "RJ", "BA"]


values = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.integers(0, 5).map(float)), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(groups=st.lists(values, min_size=1, max_size=4))
def test_exact_median_of_any_values(spark, groups):
    df = spark.createDataFrame([(g, v) for g, vs in enumerate(groups) for v in vs], "g int, v double")
    want = {}
    for g, vs in enumerate(groups):
        known = sorted(v for v in vs if v is not None)
        if known:
            want[g] = statistics.median(known)
    assert {r["g"]: r["median"] for r in exact_median(df, "g", "v").collect()} == want


@pytest.mark.parametrize("n", [19_999, 20_000, 60_001])
def test_exact_median_of_large_groups(spark, n):
    from pyspark.sql import functions as F

    df = spark.range(n * 2).select((F.col("id") % 2).alias("g"), ((F.xxhash64("id") % 100_000) / 7).alias("v"))
    want = {}
    for g in (0, 1):
        want[g] = statistics.median(r["v"] for r in df.where(f"g = {g}").collect())
    assert {r["g"]: r["median"] for r in exact_median(df, "g", "v", accuracy=1000).collect()} == want


def places(spark):
    left = spark.createDataFrame(
        [("1", "SP"), ("2", "RJ"), ("3", "ZZ")], "id_municipio string, sigla_uf string"
    )
    return left, spark.createDataFrame([("SP",), ("RJ",), ("RJ",)], "sigla_uf string")


def test_orphans_and_match(spark, rows):
    left, right = places(spark)
    assert rows(anti_join(left, right, ["sigla_uf"])) == [("3", "ZZ")]
    assert match_percentage(left, right, ["sigla_uf"]).first()[0] == 66.67
    assert match_percentage(left.where("false"), right, ["sigla_uf"]).first()[0] == 0.0
    assert anti_join(left, right, ["absent"]).count() == 3


def test_null_key_matches_null_key(spark):
    left = spark.createDataFrame([(None,), ("a",)], "k string")
    assert anti_join(left, left, ["k"]).count() == 0
    assert match_percentage(left, left, ["k"]).first()[0] == 100.0


def test_incompatible_periods(spark, rows):
    left = spark.createDataFrame([("2020",), ("2023",), ("x",), (None,)], "ano string")
    right = spark.createDataFrame([(2023,)], "ano int")
    assert rows(incompatible_periods(left, right, "ano")) == [(2020,)]
    assert rows(incompatible_periods(left, right, "absent")) == []


def test_integrity_report(spark):
    left, right = places(spark)
    got = {r["check"]: r for r in lit.integrity(left, right).collect()}
    assert got["municipios_orfaos"]["failed_rows"] == 1
    assert got["municipio_uf_match_pct"]["match_pct"] == 66.67
    assert got["municipio_chaves_duplicadas"]["failed_rows"] == 0
    assert got["metas_sem_municipio"]["failed_rows"] == 0
    assert got["anos_incompativeis_indicador_meta"]["periods"] == []
    period = IntegrityCheck(
        "p", "periods", spark.createDataFrame([(2021,), (2020,)], "ano int"),
        spark.createDataFrame([(2022,)], "ano int"), ["ano"],
    )
    assert integrity_report([period]).first()["periods"] == [2020, 2021]
