"""The literacy data set: sources, quality specs, event rules and products."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.predicates import in_set, matches_regex, not_null, numeric_between, year_valid
from lavra.functions.text import strip_text, upper_text
from lavra.functions.times import parse_iso
from lavra.operators.integrity import IntegrityCheck, integrity_report
from lavra.operators.products import (
    TargetLevel,
    feature_table,
    group_summary,
    multi_level_targets,
    target_comparison,
    time_evolution,
)
from lavra.operators.quality import QualitySpec, Rule
from lavra.plans.layers import Layout, Loader, read_silver, write_gold
from lavra.sources.audit import utc_now
from lavra.sources.contracts import ColumnContract, Source
from lavra.streaming.events import EventSpec

# Code, abbreviation, name and region of the 27 states.
STATES = (
    ("11", "RO", "Rondônia", "Norte"),
    ("12", "AC", "Acre", "Norte"),
    ("13", "AM", "Amazonas", "Norte"),
    ("14", "RR", "Roraima", "Norte"),
    ("15", "PA", "Pará", "Norte"),
    ("16", "AP", "Amapá", "Norte"),
    ("17", "TO", "Tocantins", "Norte"),
    ("21", "MA", "Maranhão", "Nordeste"),
    ("22", "PI", "Piauí", "Nordeste"),
    ("23", "CE", "Ceará", "Nordeste"),
    ("24", "RN", "Rio Grande do Norte", "Nordeste"),
    ("25", "PB", "Paraíba", "Nordeste"),
    ("26", "PE", "Pernambuco", "Nordeste"),
    ("27", "AL", "Alagoas", "Nordeste"),
    ("28", "SE", "Sergipe", "Nordeste"),
    ("29", "BA", "Bahia", "Nordeste"),
    ("31", "MG", "Minas Gerais", "Sudeste"),
    ("32", "ES", "Espírito Santo", "Sudeste"),
    ("33", "RJ", "Rio de Janeiro", "Sudeste"),
    ("35", "SP", "São Paulo", "Sudeste"),
    ("41", "PR", "Paraná", "Sul"),
    ("42", "SC", "Santa Catarina", "Sul"),
    ("43", "RS", "Rio Grande do Sul", "Sul"),
    ("50", "MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("51", "MT", "Mato Grosso", "Centro-Oeste"),
    ("52", "GO", "Goiás", "Centro-Oeste"),
    ("53", "DF", "Distrito Federal", "Centro-Oeste"),
)
STATE_CODES = tuple(sorted(s[1] for s in STATES))

# Datasets, tables, columns with their types, and keys.
_LEARNING = "basedosdados.br_inep_avaliacao_alfabetizacao"
_PLACES = "basedosdados.br_bd_diretorios_brasil"
SOURCES: dict[str, Source] = {
    "municipio": Source(
        name="municipio",
        table_id=f"{_PLACES}.municipio",
        columns=(
            ColumnContract("id_municipio", "STRING", nullable=False),
            ColumnContract("nome", "STRING", nullable=False),
            ColumnContract("sigla_uf", "STRING", nullable=False),
        ),
        keys=("id_municipio",),
    ),
    "uf": Source(
        name="uf",
        table_id=f"{_PLACES}.uf",
        columns=(
            ColumnContract("codigo_uf", "STRING", nullable=False),
            ColumnContract("sigla_uf", "STRING", nullable=False),
            ColumnContract("nome", "STRING", nullable=False),
            ColumnContract("regiao", "STRING", nullable=False),
        ),
        keys=("sigla_uf",),
    ),
    "meta_brasil": Source(
        name="meta_brasil",
        table_id=f"{_LEARNING}.meta_alfabetizacao_brasil",
        columns=(
            ColumnContract("ano", "INTEGER", nullable=False),
            ColumnContract("valor_meta", "FLOAT", nullable=False),
        ),
        keys=("ano",),
    ),
    "meta_uf": Source(
        name="meta_uf",
        table_id=f"{_LEARNING}.meta_alfabetizacao_uf",
        columns=(
            ColumnContract("ano", "INTEGER", nullable=False),
            ColumnContract("sigla_uf", "STRING", nullable=False),
            ColumnContract("valor_meta", "FLOAT", nullable=False),
        ),
        keys=("ano", "sigla_uf",),
    ),
    "meta_municipio": Source(
        name="meta_municipio",
        table_id=f"{_LEARNING}.meta_alfabetizacao_municipio",
        columns=(
            ColumnContract("ano", "INTEGER", nullable=False),
            ColumnContract("id_municipio", "STRING", nullable=False),
            ColumnContract("valor_meta", "FLOAT", nullable=False),
        ),
        keys=("ano", "id_municipio",),
    ),
    "indicador_alfabetizacao": Source(
        name="indicador_alfabetizacao",
        table_id=f"{_LEARNING}.municipio",
        columns=(
            ColumnContract("ano", "INTEGER", nullable=False),
            ColumnContract("id_municipio", "STRING", nullable=False),
            ColumnContract("serie", "STRING", nullable=True),
            ColumnContract("rede", "STRING", nullable=True),
            ColumnContract("taxa_alfabetizacao", "FLOAT", nullable=False),
        ),
        keys=("ano", "id_municipio",),
    ),
    "aluno": Source(
        name="aluno",
        table_id=f"{_LEARNING}.alunos",
        columns=(
            ColumnContract("ano", "INTEGER", nullable=False),
            ColumnContract("id_municipio", "STRING", nullable=True),
            ColumnContract("id_aluno", "STRING", nullable=False),
            ColumnContract("rede", "STRING", nullable=True),
            ColumnContract("serie", "STRING", nullable=True),
            ColumnContract("alfabetizado", "STRING", nullable=True),
        ),
        keys=("ano", "id_aluno",),
    ),
}


def states(spark: SparkSession) -> DataFrame:
    """The state dimension. Its 27 rows are the one table that is always broadcast."""
    return F.broadcast(
        spark.createDataFrame(STATES, "codigo_uf string, sigla_uf string, nome string, regiao string")
    )


def regions(spark: SparkSession) -> DataFrame:
    return states(spark).select("sigla_uf", "regiao")


def _year() -> Rule:
    return Rule("ano.valid_year", year_valid(F.col("ano")), "ano")


def _percent(column: str) -> Rule:
    return Rule(f"{column}.in_range", numeric_between(F.col(column), 0.0, 100.0), column)


def _filled(column: str) -> Rule:
    return Rule(f"{column}.not_null", not_null(F.col(column)), column)


def _state() -> Rule:
    return Rule("sigla_uf.valid_uf", in_set(F.col("sigla_uf"), STATE_CODES), "sigla_uf")


def _municipality() -> Rule:
    return Rule("id_municipio.seven_digits", matches_regex(F.col("id_municipio"), r"\d{7}"), "id_municipio")


# One builder per entity: column expressions need a running session.
# Required columns, rules, keys and standardised columns.
SPECS: Mapping[str, Callable[[], QualitySpec]] = {
    "municipio": lambda: QualitySpec(
        entity="municipio",
        required=["id_municipio", "nome", "sigla_uf"],
        rules=[
            _filled("id_municipio"),
            _municipality(),
            _filled("nome"),
            _filled("sigla_uf"),
            _state(),
        ],
        unique_keys=["id_municipio"],
        standardizers={"id_municipio": strip_text, "nome": strip_text, "sigla_uf": upper_text},
    ),
    "uf": lambda: QualitySpec(
        entity="uf",
        required=["codigo_uf", "sigla_uf", "nome"],
        rules=[
            Rule("codigo_uf.two_digits", matches_regex(F.col("codigo_uf"), r"\d{2}"), "codigo_uf"),
            _state(),
            _filled("nome"),
        ],
        unique_keys=["sigla_uf"],
        standardizers={"codigo_uf": strip_text, "nome": strip_text, "sigla_uf": upper_text},
    ),
    "meta_brasil": lambda: QualitySpec(
        entity="meta_brasil",
        required=["ano", "valor_meta"],
        rules=[
            _year(),
            _percent("valor_meta"),
        ],
        unique_keys=["ano"],
        standardizers={"ano": strip_text},
    ),
    "meta_uf": lambda: QualitySpec(
        entity="meta_uf",
        required=["ano", "sigla_uf", "valor_meta"],
        rules=[
            _year(),
            _state(),
            _percent("valor_meta"),
        ],
        unique_keys=["ano", "sigla_uf"],
        standardizers={"ano": strip_text, "sigla_uf": upper_text},
    ),
    "meta_municipio": lambda: QualitySpec(
        entity="meta_municipio",
        required=["ano", "id_municipio", "valor_meta"],
        rules=[
            _year(),
            _municipality(),
            _percent("valor_meta"),
        ],
        unique_keys=["ano", "id_municipio"],
        standardizers={"ano": strip_text, "id_municipio": strip_text},
    ),
    "indicador_alfabetizacao": lambda: QualitySpec(
        entity="indicador_alfabetizacao",
        required=["ano", "id_municipio", "taxa_alfabetizacao"],
        rules=[
            _year(),
            _municipality(),
            _percent("taxa_alfabetizacao"),
        ],
        unique_keys=["ano", "id_municipio"],
        standardizers={"ano": strip_text, "id_municipio": strip_text, "sigla_uf": upper_text},
    ),
    "aluno": lambda: QualitySpec(
        entity="aluno",
        required=["ano", "id_aluno"],
        rules=[
            _year(),
            _filled("id_aluno"),
        ],
        unique_keys=["ano", "id_aluno"],
        standardizers={"ano": strip_text, "rede": upper_text},
        pseudonymise=("id_aluno",),
    ),
}

# The fields every event must have, in order.
EVENT_FIELDS = (
    "event_id",
    "event_type",
    "codigo_municipio",
    "sigla_uf",
    "ano_referencia",
    "taxa_alfabetizacao",
    "event_time",
    "source",
    "schema_version",
)


def _event_checks():
    """The error texts."""
    rate, year = F.col("taxa_alfabetizacao"), F.col("ano_referencia")
    number = r"\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*"
    rate_is_number = matches_regex(rate, number)
    # a producer that holds the year as a double writes 2026.0
    year_is_whole = matches_regex(year, r"\s*[+-]?\d+(\.0*)?\s*")
    return [
        (F.lit("codigo_municipio deve ter 7 dígitos"), matches_regex(F.col("codigo_municipio"), r"\d{7}")),
        (
            F.concat(F.lit("sigla_uf inválida: "), F.col("sigla_uf")),
            in_set(F.upper("sigla_uf"), STATE_CODES),
        ),
        (F.lit("taxa_alfabetizacao não numérica"), rate_is_number),
        (
            F.lit("taxa_alfabetizacao fora do intervalo [0, 100]"),
            ~rate_is_number | numeric_between(rate, 0.0, 100.0),
        ),
        (F.lit("ano_referencia não inteiro"), year_is_whole),
        (F.lit("ano_referencia fora do intervalo plausível"), ~year_is_whole | year_valid(year)),
        (F.lit("event_time não está em ISO-8601"), parse_iso(F.col("event_time")).isNotNull()),
    ]


EVENTS = EventSpec(EVENT_FIELDS, _event_checks)


def indicador_municipio_ano(
    indicador: DataFrame,
    meta_municipio: DataFrame | None,
    municipio: DataFrame,
    as_of: str | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Municipal rate per year against its target."""
    return target_comparison(
        indicador,
        meta_municipio,
        municipio,
        entity="id_municipio",
        period="ano",
        value="taxa_alfabetizacao",
        target_value="valor_meta",
        dim_columns={"nome": "nome_municipio", "sigla_uf": "sigla_uf"},
        region=regions(indicador.sparkSession),
        region_key="sigla_uf",
        as_of=None if as_of is None else F.lit(as_of),
        null_safe=null_safe,
    ).withColumnsRenamed(
        {
            "target": "meta_municipal",
            "target_gap": "diferenca_meta",
            "attainment_pct": "percentual_atingimento",
            "status": "status_meta",
            "updated_on": "data_atualizacao",
        }
    )


def meta_vs_resultado(
    p1: DataFrame, meta_uf: DataFrame | None, meta_brasil: DataFrame | None, null_safe: bool = True
) -> DataFrame:
    """Municipal rate against the municipal, state and national targets."""
    compared = multi_level_targets(
        p1,
        [
            TargetLevel("uf", meta_uf, ["ano", "sigla_uf"], "valor_meta"),
            TargetLevel("brasil", meta_brasil, ["ano"], "valor_meta"),
        ],
        period="ano",
        value="taxa_alfabetizacao",
        null_safe=null_safe,
    )
    return compared.select(
        "ano",
        "id_municipio",
        "sigla_uf",
        "taxa_alfabetizacao",
        "meta_municipal",
        F.col("target_uf").alias("meta_estadual"),
        F.col("target_brasil").alias("meta_nacional"),
        F.col("diferenca_meta").alias("dif_abs_municipal"),
        F.col("percentual_atingimento").alias("dif_pct_municipal"),
        F.col("gap_uf").alias("dif_abs_estadual"),
        F.col("gap_brasil").alias("dif_abs_nacional"),
        "status_meta",
    )


def evolucao_temporal(
    indicador: DataFrame,
    tipo_localidade: str = "municipio",
    codigo_col: str = "id_municipio",
    nome_col: str | None = None,
    unique_periods: bool = False,
) -> DataFrame:
    """Rate over time per place."""
    return time_evolution(
        indicador,
        entity=codigo_col,
        period="ano",
        value="taxa_alfabetizacao",
        kind=tipo_localidade,
        name_col=nome_col,
        unique_periods=unique_periods,
    ).withColumnsRenamed(
        {
            "entity_kind": "tipo_localidade",
            "entity_code": "codigo_localidade",
            "entity_name": "nome_localidade",
            "previous_value": "taxa_ano_anterior",
            "period_change": "variacao_anual",
            "cumulative_change": "variacao_acumulada",
        }
    )


def resumo_uf(p1: DataFrame, meta_uf: DataFrame | None) -> DataFrame:
    """Statistics per state."""
    return group_summary(
        p1,
        "sigla_uf",
        value="taxa_alfabetizacao",
        status="status_meta",
        group_target=meta_uf,
        target_value="valor_meta",
    ).withColumnsRenamed(
        {
            "mean": "media",
            "median": "mediana",
            "minimum": "minimo",
            "maximum": "maximo",
            "row_count": "qtd_municipios",
            "with_value": "municipios_com_resultado",
            "without_value": "municipios_sem_resultado",
            "reached": "municipios_atingiram_meta",
            "reached_pct": "percentual_atingiu",
            "group_target": "meta_estadual",
            "gap_mean_to_target": "dif_media_para_meta_estadual",
        }
    )


def ml_features_municipio(p1: DataFrame, evolucao: DataFrame, null_safe: bool = True) -> DataFrame:
    """Model features per municipality and year, without personal data."""
    return feature_table(
        p1.withColumnRenamed("meta_municipal", "target"),
        evolucao.withColumnsRenamed({"codigo_localidade": "entity_code", "variacao_anual": "period_change"}),
        entity="id_municipio",
        period="ano",
        value="taxa_alfabetizacao",
        columns=[
            "ano",
            "id_municipio",
            "sigla_uf",
            "regiao",
            "taxa_alfabetizacao",
            F.col("target").alias("meta_municipal"),
            "diferenca_meta",
        ],
        null_safe=null_safe,
    ).withColumnsRenamed({"period_change": "variacao_anual", "reached": "atingiu_meta"})


def integrity(
    municipio: DataFrame,
    uf: DataFrame,
    meta_municipio: DataFrame | None = None,
    indicador: DataFrame | None = None,
) -> DataFrame:
    """The integrity checks of the data set, one row each."""
    period_key = ["ano", "id_municipio"]
    has_both = indicador is not None and meta_municipio is not None
    results = indicador if has_both else None
    return integrity_report(
        [
            IntegrityCheck("municipios_orfaos", "orphans", municipio, uf, ["sigla_uf"]),
            IntegrityCheck("municipio_uf_match_pct", "match", municipio, uf, ["sigla_uf"]),
            IntegrityCheck("metas_sem_municipio", "orphans", meta_municipio, municipio, ["id_municipio"]),
            IntegrityCheck("resultados_sem_meta", "orphans", results, meta_municipio, period_key),
            IntegrityCheck("anos_incompativeis_indicador_meta", "periods", results, meta_municipio, ["ano"]),
            IntegrityCheck("municipio_chaves_duplicadas", "duplicates", municipio, keys=["id_municipio"]),
            # A repeated target key would multiply the rows of the first product.
            IntegrityCheck("metas_chaves_duplicadas", "duplicates", meta_municipio, keys=period_key),
        ]
    )


def build_gold(
    spark: SparkSession, layout: Layout, loader: Loader | None = None, day: str | None = None
) -> dict[str, DataFrame | None]:
    """All products that the silver tables at hand allow, written and read back.

    The first product and the evolution feed others and are read from their
    written tables, not worked out again. Silver rows have a valid year and
    municipality, so the joins need not match nulls. A municipality may be
    missing from the directory, so the state of a result may be null; no valid
    target has a null state.
    """
    day = day or utc_now().date().isoformat()
    silver = {e: read_silver(spark, layout, e) for e in SPECS if e != "aluno"}
    municipio, uf, indicador = silver["municipio"], silver["uf"], silver["indicador_alfabetizacao"]
    made: dict[str, DataFrame | None] = {}
    if municipio is not None and uf is not None:
        made["integrity"] = integrity(municipio, uf, silver["meta_municipio"], indicador)
    if municipio is None or indicador is None:
        return made

    def write(product: str, df: DataFrame) -> DataFrame | None:
        made[product] = write_gold(df, layout, product, day, loader)
        return made[product]

    first = indicador_municipio_ano(indicador, silver["meta_municipio"], municipio, day, null_safe=False)
    p1 = write("indicador_municipio_ano", first)
    write("meta_vs_resultado", meta_vs_resultado(p1, silver["meta_uf"], silver["meta_brasil"], null_safe=False))
    # Silver keeps one row per year and municipality.
    evolution = write("evolucao_temporal", evolucao_temporal(indicador, unique_periods=True))
    write("resumo_uf", resumo_uf(p1, silver["meta_uf"]))
    write("ml_features_municipio", ml_features_municipio(p1, evolution, null_safe=False))
    return made
