from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.folders import folder_names
from lavra.plans import layers
from lavra.plans import literacy as lit
from lavra.sources import audit
from lavra.sources import tables as tb
from lavra.sources.bronze import LINEAGE, split_table_id, to_bronze, write_bronze
from lavra.sources.contracts import ContractError, contract_report
from lavra.sources.extraction import directory_scan, observed_scan, ordered_sample, target_scan

AT = datetime(2026, 7, 13, 12, 0, tzinfo=timezone.utc)


@pytest.fixture
def layout(tmp_path):
    return layers.Layout(str(tmp_path))


def uf_reader(spark, source):
    return spark.createDataFrame(lit.STATES, "codigo_uf string, sigla_uf string, nome string, regiao string")


def places(spark, source=None):
    return spark.createDataFrame(
        [("3550308", "São Paulo", "SP"), ("3304557", "Rio de Janeiro", "RJ")],
        "id_municipio string, nome string, sigla_uf string",
    )


def test_bronze_has_the_lineage_columns(spark, layout):
    source = lit.SOURCES["municipio"]
    result = layers.ingest(spark, source, places, layout, at=AT)
    df = tb.read_latest_snapshot(spark, layout.bronze("municipio"))
    assert set(LINEAGE) <= set(df.columns) and result.records_read == 2
    row = df.where("sigla_uf = 'SP'").first()
    assert (row["_source_project"], row["_source_dataset"]) == split_table_id(source.table_id)
    assert row["_load_type"] == "BATCH" and len(row["_record_hash"]) == 64
    assert row["_ingestion_id"] == result.ingestion_id


def test_ingest_with_loader_and_run_log(spark, layout):
    result = layers.ingest(spark, lit.SOURCES["uf"], uf_reader, layout, layers.table_loader(f"{layout.base}/tables"))
    assert (result.records_read, result.records_loaded) == (27, 27)
    run = audit.read_audit(spark, layout.audit, "pipeline_runs").first()
    assert (run["pipeline_name"], run["status"], run["records_written"]) == ("batch_uf", "SUCCESS", 27)
    with pytest.raises(tb.LoadError):
        layers.ingest(spark, lit.SOURCES["uf"], uf_reader, layout, lambda df, name: 26)


def test_contract_errors(spark, layout):
    with pytest.raises(ContractError):
        layers.ingest(spark, lit.SOURCES["municipio"], lambda s, c: places(s).drop("nome"), layout)
    with pytest.raises(ContractError):
        layers.ingest(spark, lit.SOURCES["municipio"], lambda s, c: places(s).where("false"), layout)


def test_contract_report(spark, rows):
    df = spark.createDataFrame([(2023, None)], "ano bigint, valor_meta double")
    got = rows(contract_report(df, lit.SOURCES["meta_brasil"]), "column", "type_ok", "null_count", "nulls_ok")
    assert got == [("ano", False, 0, True), ("valor_meta", True, 1, False)]
    got = rows(contract_report(df.drop("ano"), lit.SOURCES["meta_brasil"]), "column", "present")
    assert got == [("ano", False), ("valor_meta", True)]


def test_history_and_latest_snapshot(spark, layout):
    source, path = lit.SOURCES["municipio"], layout.bronze("municipio")
    second = AT.replace(hour=13)
    write_bronze(to_bronze(places(spark), source, "b-first", AT), path, "b-first", AT)
    newer = places(spark).limit(1).selectExpr("*", "'x' as extra")
    write_bronze(to_bronze(newer, source, "a-second", second), path, "a-second", second)
    write_bronze(to_bronze(newer, source, "a-second", second), path, "a-second", second)  # a repeated run
    history = tb.read_history(spark, path)
    assert history.count() == 3 and "extra" in history.columns
    latest = tb.read_latest_snapshot(spark, path)
    assert [r["_ingestion_id"] for r in latest.collect()] == ["a-second"]
    empty = tb.read_or_empty(spark, f"{layout.base}/none", "a int")
    assert empty.count() == 0 and empty.columns == ["a"]
    with pytest.raises(FileNotFoundError):
        tb.read_latest_snapshot(spark, f"{layout.base}/none")


def test_silver_of_valid_rows(spark, layout, municipio_bronze):
    result = layers.build_silver(municipio_bronze, lit.SPECS["municipio"](), layout, at=AT)
    assert (result.bronze_count, result.valid_count, result.invalid_count) == (4, 4, 0)
    silver = layers.read_silver(spark, layout, "municipio")
    assert {"_quality_status", "_silver_processed_timestamp", "_ingestion_id", "_record_hash"} <= set(silver.columns)
    assert {r["nome"] for r in silver.collect()} == {"São Paulo", "Rio de Janeiro", "Salvador", "Porto Velho"}
    assert tb.partition_values(spark, layout.quarantine("municipio"), "processing_date") == []
    line = audit.read_audit(spark, layout.audit, "quality_results").first()
    assert (line["status"], line["total_read"], line["quarantine_path"]) == ("PASSED", 4, None)
    assert len(line["rule_results"]) == 6


def test_silver_with_quarantine(spark, layout, municipio_bronze):
    bad = municipio_bronze.replace("RJ", "XX", subset=["sigla_uf"])
    seen = []
    result = layers.build_silver(
        bad, lit.SPECS["municipio"](), layout, loader=lambda df, name: seen.append(name) or df.count()
    )
    assert (result.valid_count, result.invalid_count, result.loaded_count) == (3, 1, 3)
    quarantined = tb.read_history(spark, layout.quarantine("municipio")).first()
    assert quarantined["_failed_rules"] == ["sigla_uf.valid_uf"]
    assert quarantined["_quality_status"] == "INVALID"
    line = audit.read_audit(spark, layout.audit, "quality_results").first()
    assert line["failures_by_rule"] == {"sigla_uf.valid_uf": 1}
    with pytest.raises(tb.LoadError):
        layers.build_silver(bad, lit.SPECS["municipio"](), layout, loader=lambda df, name: 1)


def test_silver_without_bronze(spark, layout):
    assert layers.silver_from_bronze(spark, lit.SPECS["uf"](), layout) is None


def data(name):
    return {
        "municipio": ([("3550308", "São Paulo", "SP"), ("3304557", "Rio de Janeiro", "RJ")],
                      "id_municipio string, nome string, sigla_uf string"),
        "meta_brasil": ([(2023, 82.0)], "ano int, valor_meta double"),
        "meta_uf": ([(2023, "SP", 88.0)], "ano int, sigla_uf string, valor_meta double"),
        "meta_municipio": ([(2023, "3550308", 85.0)], "ano int, id_municipio string, valor_meta double"),
        "indicador_alfabetizacao": (
            [(2023, "3550308", "2", "3", 90.0), (2022, "3550308", "2", "3", 80.0), (2023, "3304557", "2", "3", 70.0)],
            "ano int, id_municipio string, serie string, rede string, taxa_alfabetizacao double"),
        "aluno": ([(2024, "3550308", "s1", "3", "2", "1")],
                  "ano int, id_municipio string, id_aluno string, rede string, serie string, alfabetizado string"),
    }[name]


def reader(spark, source):
    return uf_reader(spark, source) if source.name == "uf" else spark.createDataFrame(*data(source.name))


def test_all_layers(spark, layout):
    loader = layers.table_loader(f"{layout.base}/tables")
    counts = layers.run_all(spark, lit.SOURCES, lit.SPECS, reader, layout, lit.build_gold, loader, loader)
    assert counts == {"pipeline_runs": 15, "quality_results": 7}
    made = lit.build_gold(spark, layout, day="2026-07-13")
    assert {r["check"]: r["failed_rows"] for r in made["integrity"].collect()}["resultados_sem_meta"] == 2
    gold = {p: d for p, d in made.items() if p != "integrity"}
    assert {p: d.count() for p, d in gold.items()} == {
        "indicador_municipio_ano": 3, "meta_vs_resultado": 3, "evolucao_temporal": 3, "resumo_uf": 2,
        "ml_features_municipio": 3,
    }
    for product in gold.values():
        assert "id_aluno" not in product.columns
    sp = gold["ml_features_municipio"].where("id_municipio = '3550308' and ano = 2023").first()
    assert (sp["variacao_anual"], sp["atingiu_meta"]) == (10.0, 1)
    table = audit.read_synced(spark, layout.audit_tables, "quality_results")
    assert dict(table.dtypes)["rule_results"] == "string"

    report = audit.monitoring_report(
        *[audit.read_audit(spark, layout.audit, log) for log in ("pipeline_runs", "quality_results", "streaming_metrics")]
    ).first()
    assert report["total_pipeline_runs"] == 15 and report["last_run"]["pipeline_name"] == "all"
    assert report["entities"] == sorted(lit.SPECS)
    assert (report["valid_rows"], report["rejected_rows"], report["rejection_pct"]) == (36, 0, 0.0)
    assert (report["stream_sessions"], report["last_stream"]) == (0, None)
    assert audit.synced_report(spark, layout.audit_tables).first() == report


def test_gold_without_indicator(spark, layout):
    assert lit.build_gold(spark, layout) == {}


def test_fixed_schema_load(spark, layout):
    schema = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([(1, "5"), (2, None)], "id int, n string")
    path = f"{layout.base}/fixed"
    assert tb.load_fixed_schema(df, path, schema) == 2
    assert dict(tb.read_table(spark, path).dtypes) == {"id": "string", "n": "int"}
    with pytest.raises(tb.LoadError):
        tb.load_fixed_schema(df.selectExpr("n as id", "n"), path, schema)
    assert tb.read_table(spark, path).count() == 2  # the version before is still there


def test_a_run_is_seen_when_it_is_whole(spark, layout):
    source, path = lit.SOURCES["municipio"], layout.bronze("municipio")
    write_bronze(to_bronze(places(spark), source, "a", AT), path, "a", AT)
    # a newer run that stopped before it was published, and one that fails while it is written again
    places(spark).limit(1).write.parquet(f"{path}/ingestion_date=2030-01-01/_ingestion_id=half")
    broken = to_bronze(places(spark), source, "b", AT.replace(hour=20)).withColumn("nome", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        write_bronze(broken, path, "b", AT.replace(hour=20))
    assert {r["_ingestion_id"] for r in tb.read_history(spark, path).collect()} == {"a"}
    assert tb.read_latest_snapshot(spark, path).count() == 2
    schema = "id_municipio string"
    assert tb.read_or_empty(spark, path, schema).count() == 2


def test_a_failed_load_leaves_the_table(spark, layout):
    path = f"{layout.base}/table"
    assert [tb.full_refresh(places(spark), path) for _ in range(3)] == [2, 2, 2]
    with pytest.raises(Exception, match="lost"):
        tb.full_refresh(places(spark).withColumn("nome", F.raise_error(F.lit("lost"))), path)
    assert tb.read_table(spark, path).count() == 2
    assert len([n for n in folder_names(spark, path) if n.startswith("_copy=")]) == 2


def test_writers_of_one_table_do_not_hurt_each_other(spark, layout):
    path = f"{layout.base}/shared"
    tb.write_partition(places(spark).where("false"), path, day="1", run="empty")
    tb.write_partition(places(spark), path, day="1", run="full")
    tb.write_partition(places(spark).where("false"), path, day="1", run="empty")
    assert tb.partition_values(spark, path, "run") == ["full"] and tb.read_history(spark, path).count() == 2


def test_records_read_are_those_of_the_reader(spark, layout, monkeypatch):
    monkeypatch.setattr(layers, "write_bronze", lambda *args: write_bronze(*args) - 1)
    with pytest.raises(tb.LoadError, match="expected 2 rows, found 1"):
        layers.ingest(spark, lit.SOURCES["municipio"], places, layout)


def test_extraction_scans(spark, rows):
    uf = spark.createDataFrame([(35, "SP"), (None, "XX"), (33, "RJ")], "id_uf int, sigla string")
    got = directory_scan(uf, "id_uf", {"id_uf": "codigo_uf", "sigla": "sigla_uf"}, "sigla_uf")
    assert [tuple(r) for r in got.collect()] == [("33", "RJ"), ("35", "SP")]
    wide = spark.createDataFrame([(2024, 1.0, 2.0), (2023, 3.0, None)], "ano int, meta_2025 double, meta_2026 double")
    assert rows(target_scan(wide, ["ano"], "meta_2026")) == [(2024, 2.0)]
    seen = spark.createDataFrame([("3", 1.0), ("2", 1.0), ("3", None)], "rede string, taxa double")
    assert rows(observed_scan(seen, ["rede", "taxa"], seen["rede"] == "3", "taxa")) == [("3", 1.0)]
    assert rows(ordered_sample(seen, ["taxa"], seen["rede"] == "3", "taxa", ["taxa"], 1)) == [(1.0,)]
    assert tb.partition_values(spark, "/tmp/no-such-folder", "a") == []
