"""Audit logs are synced by what is new, exactly once, with running totals."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from lavra.sources import audit
from lavra.sources.published import Publication, pack

LOGS = ("pipeline_runs", "quality_results", "streaming_metrics")


def add_lines(spark, path, n, entity="uf"):
    """One run, one quality result and one stream session, each numbered n."""
    for log in LOGS:
        line = spark.createDataFrame([()], "").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], audit.SCHEMAS[log]).schema]
        )
        time = F.lit(f"2026-07-{n + 10:02d}T00:00:00+00:00")
        if log == "pipeline_runs":
            line = line.withColumns({"pipeline_name": F.lit(f"run {n}"), "end_time": time})
        elif log == "quality_results":
            nested = F.create_map(F.lit("rule"), F.lit(n).cast("long"))
            line = line.withColumns(
                {"entity": F.lit(entity), "valid_count": F.lit(10 * n), "invalid_count": F.lit(n), "failures_by_rule": nested}
            )
        else:
            line = line.withColumns({"consumed": F.lit(n), "duplicates": F.lit(n), "timestamp": time})
        audit.append_audit(line, path, log)


def full_report(spark, path):
    return audit.monitoring_report(*[audit.read_audit(spark, path, log) for log in LOGS]).first()


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "audit"), str(tmp_path / "tables")


def test_the_second_sync_takes_new_files_only(spark, paths):
    source, target = paths
    add_lines(spark, source, 1)
    add_lines(spark, source, 2, "municipio")
    assert audit.sync_audit(spark, source, target) == dict.fromkeys(LOGS, 2)
    assert audit.synced_report(spark, target).first() == full_report(spark, source)
    assert audit.sync_audit(spark, source, target) == dict.fromkeys(LOGS, 2)
    shutil.move(source, source + "-before")  # the files of the first sync are gone: they are not read again
    add_lines(spark, source, 4)
    assert audit.sync_audit(spark, source, target) == dict.fromkeys(LOGS, 3)
    report = audit.synced_report(spark, target).first()
    assert (report["total_pipeline_runs"], report["valid_rows"], report["rejected_rows"]) == (3, 70, 7)
    assert report["last_run"]["pipeline_name"] == "run 4" and report["stream_duplicates"] == 4
    assert report["entities"] == ["municipio", "uf"] and report["stream_sessions"] == 3
    rules = {r[0] for r in audit.read_synced(spark, target, "quality_results").select("failures_by_rule").collect()}
    assert rules == {'{"rule":1}', '{"rule":2}', '{"rule":4}'}


def test_a_sync_that_crashed_appends_once(spark, paths, monkeypatch):
    source, target = paths
    add_lines(spark, source, 1)

    def lost(self):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Publication, "publish", lost)
        with pytest.raises(Exception, match="lost"):
            audit.sync_audit(spark, source, target)
    assert audit.sync_audit(spark, source, target) == dict.fromkeys(LOGS, 1)
    assert audit.synced_report(spark, target).first() == full_report(spark, source)


def test_missing_logs_and_packed_tables(spark, paths):
    source, target = paths
    assert audit.sync_audit(spark, source, target) == {}
    report = audit.synced_report(spark, target).first()
    assert (report["total_pipeline_runs"], report["entities"], report["last_run"]) == (0, [], None)
    for n in (1, 2):
        add_lines(spark, source, n)
        audit.sync_audit(spark, source, target)
    before = audit.synced_report(spark, target).first()
    for log in LOGS:
        assert pack(spark, f"{target}/{log}", ["batch_id"]) == 2
        assert pack(spark, f"{target}/{log}{audit.TOTALS}", ["batch_id"]) == 2
    assert audit.synced_report(spark, target).first() == before
    add_lines(spark, source, 3)
    assert audit.sync_audit(spark, source, target) == dict.fromkeys(LOGS, 3)
    assert audit.synced_report(spark, target).first() == full_report(spark, source)
