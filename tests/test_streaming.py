from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lavra.plans.literacy import EVENT_FIELDS, EVENTS
from lavra.sources import audit
from lavra.sources import published as pub
from lavra.sources.published import Publication, markers
from lavra.sources.events import bad_event_records, read_event_file, text_stream, topic_records, topic_values
from lavra.streaming import ingest
from lavra.streaming.events import decode_events, validate_events
from lavra.streaming.ingest import StreamPaths, read_batches, run_session, session_batches
from lavra.streaming.routing import new_events, route_events

EVENT = {
    "event_id": "e1", "event_type": "indicador_atualizado", "codigo_municipio": "3550308", "sigla_uf": "SP",
    "ano_referencia": 2026, "taxa_alfabetizacao": 87.5, "event_time": "2026-07-13T10:00:00+00:00",
    "source": "teste", "schema_version": "1.0",
}


def event(**change):
    return json.dumps({**EVENT, **change}, ensure_ascii=False)


def errors_of(spark, text):
    raw = spark.createDataFrame([(text,)], "value string")
    return validate_events(decode_events(raw, EVENT_FIELDS), EVENTS).first()["errors"]


@pytest.mark.parametrize(
    "change",
    [{}, {"sigla_uf": "sp"}, {"codigo_municipio": 3550308}, {"taxa_alfabetizacao": "12.5"},
     {"event_time": "2026-07-13T10:00:00"}, {"ano_referencia": 2026.0}, {"event_time": "2026-07-13T10:00:00Z"}, {"extra": {"a": 1}}],
)
def test_good_events(spark, change):
    assert errors_of(spark, event(**change)) == []


@pytest.mark.parametrize(
    "change,errors",
    [
        ({"taxa_alfabetizacao": 150.0}, ["taxa_alfabetizacao fora do intervalo [0, 100]"]),
        ({"taxa_alfabetizacao": "abc"}, ["taxa_alfabetizacao não numérica"]),
        ({"codigo_municipio": ""}, ["campo obrigatório ausente: codigo_municipio"]),
        ({"codigo_municipio": "", "sigla_uf": None, "taxa_alfabetizacao": 999},
         ["campo obrigatório ausente: codigo_municipio", "campo obrigatório ausente: sigla_uf"]),
        ({"sigla_uf": "ZZ"}, ["sigla_uf inválida: ZZ"]),
        ({"codigo_municipio": "355030\n", "ano_referencia": 1800},
         ["codigo_municipio deve ter 7 dígitos", "ano_referencia fora do intervalo plausível"]),
        ({"ano_referencia": 2026.5}, ["ano_referencia não inteiro"]),
        ({"ano_referencia": "x", "event_time": "ontem"},
         ["ano_referencia não inteiro", "event_time não está em ISO-8601"]),
    ],
)
def test_bad_events(spark, change, errors):
    assert errors_of(spark, event(**change)) == errors


def test_bad_json_and_extra_fields(spark):
    assert errors_of(spark, "{not json") == ["json inválido"]
    raw = spark.createDataFrame([(event(extra={"a": 1}),)], "value string")
    assert decode_events(raw, EVENT_FIELDS).first()["_extra"] == {"extra": '{"a":1}'}


def routes(df):
    return {r["route"]: r["n"] for r in df.groupBy("route").agg(F.count("*").alias("n")).collect()}


def validated(spark, *texts):
    raw = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    return validate_events(decode_events(raw, EVENT_FIELDS), EVENTS)


def test_routing_keeps_the_first_valid_event(spark):
    events = validated(
        spark, event(taxa_alfabetizacao=150), event(source="a"), event(source="b"), event(event_id="e2"), event(source="c")
    )
    routed = route_events(events, EVENTS)
    assert routes(routed) == {"invalid": 1, "valid": 2, "duplicate": 2}
    assert routed.where("route = 'valid' and event_id = 'e1'").first()["source"] == "a"
    assert {tuple(r["errors"]) for r in routed.where("route = 'duplicate'").collect()} == {("evento duplicado",)}
    seen = spark.createDataFrame([("e1",)], "event_id string")
    assert routes(route_events(events, EVENTS, seen)) == {"invalid": 1, "valid": 1, "duplicate": 3}


EDGE = [
    event(event_id="n1"),
    event(event_id="n2", sigla_uf="RJ", codigo_municipio="3304557"),
    event(event_id="n1"),
    event(event_id="n3", taxa_alfabetizacao=999),
    event(event_id="n4", codigo_municipio=""),
    event(event_id="n5", sigla_uf="ZZ"),
]


def test_sessions_over_one_checkpoint(spark, tmp_path):
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    paths, audit_path = StreamPaths.under(base, "indicador"), f"{base}/audit"
    (inbox / "one.jsonl").write_text("\n".join(EDGE) + "\n", encoding="utf-8")

    def run():
        stream = decode_events(text_stream(spark, str(inbox)), EVENT_FIELDS)
        return run_session(stream, EVENTS, paths, f"{base}/checkpoint", audit_path).first()

    first = run()
    assert (first["consumed"], first["valid"], first["invalid"], first["duplicates"]) == (6, 2, 3, 1)
    assert first["flushed_batches"] == 1 and first["avg_latency_seconds"] > 0
    (inbox / "two.jsonl").write_text("\n".join([event(event_id="n1"), event(event_id="n6"), "{"]) + "\n", encoding="utf-8")
    second = run()
    assert (second["consumed"], second["valid"], second["invalid"], second["duplicates"]) == (3, 1, 1, 1)
    bronze = read_batches(spark, paths.bronze)
    assert {r["event_id"] for r in bronze.collect()} == {"n1", "n2", "n6"}
    assert {r["_load_type"] for r in bronze.collect()} == {"STREAMING"}
    quarantine = read_batches(spark, paths.quarantine)
    assert quarantine.count() == 6 and quarantine.where("_raw = '{'").count() == 1
    assert len(session_batches(spark, paths)) == 2

    # A new checkpoint takes the ids it must know from bronze.
    seen = bronze.select("event_id")
    other = StreamPaths.under(f"{base}/again", "indicador")
    stream = decode_events(text_stream(spark, str(inbox)), EVENT_FIELDS)
    again = run_session(stream, EVENTS, other, f"{base}/checkpoint2", audit_path, seen=seen).first()
    assert (again["valid"], again["invalid"], again["duplicates"]) == (0, 4, 5)

    logs = audit.read_audit(spark, audit_path, "streaming_metrics")
    report = audit.monitoring_report(
        audit.read_audit(spark, audit_path, "pipeline_runs"), audit.read_audit(spark, audit_path, "quality_results"), logs
    ).first()
    assert (report["stream_sessions"], report["stream_duplicates"], report["rejection_pct"]) == (3, 5, 0.0)


def test_one_id_floods_a_batch_and_returns(spark, tmp_path):
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    paths = StreamPaths.under(base, "x")
    for i in range(3):
        lines = [event(event_id="hot")] * 500 + [event(event_id=f"f{i}-{k}") for k in range(20)]
        (inbox / f"{i}.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    stream = decode_events(text_stream(spark, str(inbox), files_per_batch=1), EVENT_FIELDS)
    got = run_session(stream, EVENTS, paths, f"{base}/cp", f"{base}/audit").first()
    assert (got["consumed"], got["valid"], got["duplicates"], got["flushed_batches"]) == (1560, 61, 1499, 3)


def test_a_run_on_an_interval(spark, tmp_path):
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    paths = StreamPaths.under(base, "x")
    (inbox / "0.jsonl").write_text("\n".join(EDGE) + "\n", encoding="utf-8")
    stream = decode_events(text_stream(spark, str(inbox)), EVENT_FIELDS)
    query = ingest.start_ingest(stream, EVENTS, paths, f"{base}/cp", interval="1 second")
    try:
        query.processAllAvailable()
        (inbox / "1.jsonl").write_text(event(event_id="n1") + "\n" + event(event_id="n9") + "\n", encoding="utf-8")
        query.processAllAvailable()
    finally:
        query.stop()
    got = ingest.session_metrics(spark, paths).first()
    assert (got["consumed"], got["valid"], got["invalid"], got["duplicates"], got["flushed_batches"]) == (8, 3, 3, 2, 2)


def ingest_folder(spark, inbox, base, **options):
    stream = decode_events(text_stream(spark, str(inbox), options.pop("files_per_batch", None)), EVENT_FIELDS)
    return run_session(stream, EVENTS, StreamPaths.under(base, "x"), f"{base}/cp", f"{base}/audit", **options).first()


def counts(row):
    return row["consumed"], row["valid"], row["invalid"], row["duplicates"]


@pytest.mark.parametrize("written", [0, 1, 2, 3, 4])
def test_a_batch_that_crashed_is_written_once(spark, tmp_path, monkeypatch, written):
    """The batch stops before one of its five tables; no half of it is seen, and the next start repeats it."""
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    paths = StreamPaths.under(base, "x")
    (inbox / "0.jsonl").write_text("\n".join(EDGE) + "\n", encoding="utf-8")
    write, done = Publication.write, []

    def failing(self, df, path, *args, **more):
        if path.startswith(base) and "audit/pipeline" not in path:
            if len(done) == written:
                raise RuntimeError("lost")
            done.append(path)
        return write(self, df, path, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(Publication, "write", failing)
        with pytest.raises(Exception, match="lost"):
            ingest_folder(spark, inbox, base)
    for path in (paths.bronze, paths.quarantine, paths.metrics):
        assert markers(spark, path) == []
    assert counts(ingest_folder(spark, inbox, base)) == (6, 2, 3, 1)
    assert sorted(r["event_id"] for r in read_batches(spark, paths.bronze).collect()) == ["n1", "n2"]
    assert read_batches(spark, paths.quarantine).count() == 4


@pytest.mark.parametrize("made", [1, 3, 5])
def test_a_crash_while_a_batch_is_published_shows_no_half(spark, tmp_path, monkeypatch, made):
    """The driver stops after some markers, before the commit: as if it had been killed, nothing is cleaned up."""
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    paths = StreamPaths.under(base, "x")
    (inbox / "0.jsonl").write_text("\n".join(EDGE) + "\n", encoding="utf-8")
    create, files = pub.create_file, []

    def failing(spark, path, **more):
        if len(files) == made:
            raise RuntimeError("killed")
        files.append(path)
        create(spark, path, **more)

    with monkeypatch.context() as patch:
        patch.setattr(pub, "create_file", failing)
        patch.setattr(Publication, "drop", lambda self: None)
        with pytest.raises(Exception, match="killed"):
            ingest_folder(spark, inbox, base)
    assert len(files) == made and markers(spark, paths.bronze) == markers(spark, paths.quarantine) == []
    assert counts(ingest_folder(spark, inbox, base)) == (6, 2, 3, 1)
    assert read_batches(spark, paths.bronze).count() == 2 and read_batches(spark, paths.quarantine).count() == 4
    for path in (paths.bronze, paths.quarantine):
        assert pub.sweep(spark, path, 0) == 1
    assert read_batches(spark, paths.bronze).count() == 2


def test_a_published_batch_is_not_repeated(spark, tmp_path):
    """The driver stops after the commit, before the checkpoint knows: the batch comes again and is left out."""
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    (inbox / "0.jsonl").write_text("\n".join(EDGE) + "\n", encoding="utf-8")
    assert counts(ingest_folder(spark, inbox, base)) == (6, 2, 3, 1)
    for name in ("0", ".0.crc"):
        (tmp_path / "lake" / "cp" / "commits" / name).unlink()
    assert counts(ingest_folder(spark, inbox, base)) == (0, 0, 0, 0)
    paths = StreamPaths.under(base, "x")
    assert read_batches(spark, paths.bronze).count() == 2 and read_batches(spark, paths.quarantine).count() == 4
    (inbox / "1.jsonl").write_text(event(event_id="n1") + "\n" + event(event_id="n8") + "\n", encoding="utf-8")
    assert counts(ingest_folder(spark, inbox, base)) == (2, 1, 0, 1)


def test_a_new_checkpoint_keeps_batches_and_ids(spark, tmp_path):
    """Batch numbers start anew, but replace nothing, and ids of the first checkpoint are known."""
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    (inbox / "0.jsonl").write_text("\n".join(EDGE) + "\n", encoding="utf-8")
    ingest_folder(spark, inbox, base)
    (tmp_path / "lake" / "cp").rename(tmp_path / "lake" / "cp-lost")
    assert counts(ingest_folder(spark, inbox, base)) == (6, 0, 3, 3)
    paths = StreamPaths.under(base, "x")
    assert read_batches(spark, paths.bronze).count() == 2 and read_batches(spark, paths.quarantine).count() == 10


def test_the_source_is_read_once(spark, tmp_path):
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    for i in range(3):
        (inbox / f"{i}.jsonl").write_text("\n".join([*EDGE, event(event_id=f"k{i}")]) + "\n", encoding="utf-8")
    stream = decode_events(text_stream(spark, str(inbox), 1), EVENT_FIELDS)
    query = ingest.start_ingest(stream, EVENTS, StreamPaths.under(base, "x"), f"{base}/cp")
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 21
    assert all(not p["stateOperators"] for p in query.recentProgress)
    assert counts(ingest.session_metrics(spark, StreamPaths.under(base, "x")).first()) == (21, 5, 9, 7)


def test_batches_are_packed_while_the_stream_runs_on(spark, tmp_path, monkeypatch):
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    paths = StreamPaths.under(base, "x")
    for i in range(4):
        (inbox / f"{i}.jsonl").write_text("\n".join([*EDGE, event(event_id=f"k{i}")]) + "\n", encoding="utf-8")
    ingest_folder(spark, inbox, base, files_per_batch=1)
    seen = {p: sorted(map(str, read_batches(spark, p).select("event_id", "batch_id").collect())) for p in (paths.bronze, paths.quarantine)}
    reader = read_batches(spark, paths.bronze)
    reader_rows = reader.count()
    assert ingest.tidy(spark, paths) == 8
    for path, before in seen.items():
        assert len(markers(spark, path)) == 1
        assert sorted(map(str, read_batches(spark, path).select("event_id", "batch_id").collect())) == before
        assert len(read_batches(spark, path).inputFiles()) == 1
    assert reader.count() == reader_rows  # one that had begun with the small files
    # the stream goes on, knows the ids, and a repeated batch is still known after it was packed
    (inbox / "9.jsonl").write_text(event(event_id="k0") + "\n" + event(event_id="z") + "\n", encoding="utf-8")
    assert counts(ingest_folder(spark, inbox, base)) == (2, 1, 0, 1)
    last = markers(spark, paths.metrics)[-1].info["_as"]
    assert pub.published(spark, paths.bronze, last) and pub.published(spark, paths.metrics, last)
    assert ingest.tidy(spark, paths, keep_seconds=0) == 4
    assert read_batches(spark, paths.bronze).count() == 7 and len(markers(spark, paths.bronze)) == 1


def test_event_files_and_topic_records(spark, tmp_path):
    schema = "event_id string, taxa_alfabetizacao double"
    array, lines = tmp_path / "a.json", tmp_path / "l.json"
    array.write_text("\n [" + ",\n".join([event(), event(event_id="e2")]) + "]", encoding="utf-8")
    lines.write_text(event() + "\n\n" + event(event_id="e2") + "\n", encoding="utf-8")
    for path in (array, lines):
        df = read_event_file(spark, str(path), schema)
        assert sorted(r["event_id"] for r in df.collect()) == ["e1", "e2"]
    record = topic_records(read_event_file(spark, str(array), schema)).orderBy("key").first()
    assert (record["key"], json.loads(record["value"])) == ("e1", {"event_id": "e1", "taxa_alfabetizacao": 87.5})


def test_a_folder_of_mixed_event_files(spark, tmp_path):
    schema = "event_id string, taxa_alfabetizacao double"
    (tmp_path / "a b.json").write_text("\ufeff\n[" + event() + "," + event(event_id="a2") + "]", encoding="utf-8")
    (tmp_path / "l.jsonl").write_text(event(event_id="l1") + "\n{broken\n" + event(event_id="l2") + "\n", encoding="utf-8")
    (tmp_path / "empty.json").write_text(" \n", encoding="utf-8")
    got = read_event_file(spark, str(tmp_path), schema)
    assert sorted(r["event_id"] for r in got.collect()) == ["a2", "e1", "l1", "l2"]
    assert [r[0] for r in bad_event_records(spark, str(tmp_path), schema).collect()] == ["{broken"]


def test_topic_records_keep_their_place(spark):
    records = spark.createDataFrame(
        [(event(source="late").encode(), "t", 1, 9, 0), (event(source="early").encode(), "t", 1, 3, 0)],
        "value binary, topic string, partition int, offset long, ms long",
    ).withColumn("timestamp", F.timestamp_millis("ms"))
    events = validate_events(decode_events(topic_values(records), EVENT_FIELDS), EVENTS)
    routed = route_events(events, EVENTS, order_by=["_partition", "_offset"])
    assert routed.where("route = 'valid'").first()["source"] == "early"


def test_hot_and_missing_ids_in_a_stream_batch(spark, tmp_path):
    inbox, base = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    lines = [event(event_id="hot")] * 3000 + ["{"] * 2000 + [event(event_id=f"f{k}") for k in range(500)]
    (inbox / "0.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    paths = StreamPaths.under(base, "x")
    seen = {}
    route = ingest.route_events

    def watched(rows, *args, **more):
        seen["adaptive"] = rows.sparkSession.conf.get("spark.sql.adaptive.enabled")
        seen["partitions"] = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
        return route(rows, *args, **more)

    ingest.route_events = watched
    try:
        stream = decode_events(text_stream(spark, str(inbox)), EVENT_FIELDS)
        got = run_session(stream, EVENTS, paths, f"{base}/cp", f"{base}/audit").first()
    finally:
        ingest.route_events = route
    assert seen == {"adaptive": "true", "partitions": spark.conf.get("spark.sql.shuffle.partitions")}
    assert (got["consumed"], got["valid"], got["invalid"], got["duplicates"]) == (5500, 501, 2000, 2999)


def test_new_events_without_other_checks(spark, rows):
    events = spark.createDataFrame(
        [("a", 1), ("a", 2), ("", 3), (None, 4), ("b", 5), ("c", 6)], "id string, n int"
    ).coalesce(1)
    got = new_events(events, "id", spark.createDataFrame([("b",)], "id string"))
    assert rows(got.where("is_new"), "n") == [(1,), (6,)]
    assert got.count() == 6
