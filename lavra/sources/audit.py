"""Audit logs as JSON lines, their tables, and the monitoring report."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.folders import exists
from lavra.functions.jsontext import flatten_nested
from lavra.functions.numbers import percent
from lavra.functions.times import parse_iso, seconds_between
from lavra.sources.published import Publication, markers
from lavra.sources.tables import read_history
from lavra.streaming.once import Once

# The three logs and their fields.
SCHEMAS = {
    "pipeline_runs": (
        "pipeline_name string, source string, layer string, status string, records_read bigint,"
        " records_written bigint, records_valid bigint, records_rejected bigint, bytes_processed bigint,"
        " error_type string, error_message string, pipeline_run_id string, start_time string,"
        " end_time string, duration_seconds double"
    ),
    "quality_results": (
        "quality_run_id string, pipeline string, entity string, layer string, status string,"
        " started_at string, finished_at string, duration_seconds double, total_read bigint,"
        " valid_count bigint, invalid_count bigint, failures_by_rule map<string,bigint>,"
        " rule_results array<struct<rule:string,column:string,severity:string,failed_count:bigint,message:string>>,"
        " silver_path string, quarantine_path string, error_message string"
    ),
    "streaming_metrics": (
        "consumed bigint, valid bigint, invalid bigint, duplicates bigint, flushed_batches bigint,"
        " avg_latency_seconds double, timestamp string"
    ),
}

# Beside the audit tables: their running totals, and what the sync remembers.
TOTALS, CHECKPOINTS = "_totals", "_checkpoints"
# Logs with a folder per value of these columns.
PARTITIONS = {"quality_results": ("entity",)}


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def pipeline_run(
    spark: SparkSession,
    pipeline_name: str,
    source: str,
    layer: str,
    status: str,
    start: datetime,
    end: datetime | None = None,
    run_id: str | None = None,
    **counts: int | str | None,
) -> DataFrame:
    """One row of the run log; counts that are not given are 0."""
    row = {
        "pipeline_name": pipeline_name,
        "source": source,
        "layer": layer,
        "status": status,
        "records_read": 0,
        "records_written": 0,
        "records_valid": 0,
        "records_rejected": 0,
        "bytes_processed": 0,
        "error_type": None,
        "error_message": None,
        "pipeline_run_id": run_id or str(uuid4()),
        "start_time": start.isoformat(),
        "end_time": (end or utc_now()).isoformat(),
        "duration_seconds": None,
        **counts,
    }
    df = spark.createDataFrame([row], SCHEMAS["pipeline_runs"])
    return df.withColumn(
        "duration_seconds",
        seconds_between(parse_iso(F.col("start_time")), parse_iso(F.col("end_time"))),
    )


def append_audit(df: DataFrame, path: str, log: str) -> None:
    """Append rows to a log, one JSON object per line; quality results in a folder per entity."""
    writer = df.write.mode("append").option("ignoreNullFields", "false")
    if log in PARTITIONS:
        writer = writer.partitionBy(*PARTITIONS[log])
    writer.json(f"{path}/{log}")


def read_audit(spark: SparkSession, path: str, log: str) -> DataFrame:
    """A log with its declared fields; empty where it was never written."""
    if not exists(spark, f"{path}/{log}"):
        return spark.createDataFrame([], SCHEMAS[log])
    fields = spark.createDataFrame([], SCHEMAS[log]).columns
    return spark.read.schema(SCHEMAS[log]).json(f"{path}/{log}").select(*fields)


def sync_audit(spark: SparkSession, audit_path: str, table_path: str) -> dict[str, int]:
    """Append what is new in each log to its table, nested fields as JSON; gives the rows of each table.

    A stream over the log's files takes those that came since the last time, and appends their
    lines together with their totals in one step, exactly once. A missing log is skipped. What
    remembers the files taken lies with the tables.
    """
    for log in SCHEMAS:
        if exists(spark, f"{audit_path}/{log}"):
            _append_new(spark, f"{audit_path}/{log}", table_path, log)
    return {log: sum(m.rows for m in found) for log in SCHEMAS if (found := markers(spark, f"{table_path}/{log}"))}


def _append_new(spark: SparkSession, source: str, table_path: str, log: str) -> None:
    table, checkpoint = f"{table_path}/{log}", f"{table_path}/{CHECKPOINTS}/{log}"
    once = Once(spark, checkpoint, table)

    def write(batch: DataFrame, batch_id: int) -> None:
        identity = once.identity(batch_id)
        if identity is None:
            return
        with Publication(spark) as run:
            run.write(flatten_nested(batch), table, identity=identity, batch_id=str(batch_id))
            run.write(_totals(run.read(table), log), f"{table}{TOTALS}", identity=identity, batch_id=str(batch_id))

    fields = spark.createDataFrame([], SCHEMAS[log]).columns
    lines = spark.readStream.schema(SCHEMAS[log]).json(source).select(*fields)
    query = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True)
    query.start().awaitTermination()


def read_synced(spark: SparkSession, table_path: str, log: str) -> DataFrame:
    """The table of a log as of the last sync."""
    return read_history(spark, f"{table_path}/{log}").drop("batch_id")


def _last(df: DataFrame, time: str) -> Column:
    return F.max_by(F.struct(*df.columns), F.coalesce(parse_iso(F.col(time)), F.lit(0).cast("timestamp")))


def _totals(lines: DataFrame, log: str) -> DataFrame:
    """One row over lines of a log, which can be summed up with others of its kind."""
    lines = lines.drop("batch_id")
    if log == "pipeline_runs":
        return lines.agg(F.count("*").alias("total_pipeline_runs"), _last(lines, "end_time").alias("last_run"))
    if log == "quality_results":
        return lines.agg(
            F.sort_array(F.collect_set("entity")).alias("entities"),
            F.coalesce(F.sum("valid_count"), F.lit(0)).alias("valid_rows"),
            F.coalesce(F.sum("invalid_count"), F.lit(0)).alias("rejected_rows"),
        )
    return lines.agg(F.count("*").alias("stream_sessions"), _last(lines, "timestamp").alias("last_stream"))


def _report(parts: dict[str, DataFrame]) -> DataFrame:
    """The report of totals, any number of rows per log."""

    def newest(last: str, time: str) -> Column:
        when = F.coalesce(parse_iso(F.col(f"{last}.{time}")), F.lit(0).cast("timestamp"))
        return F.max_by(last, F.when(F.col(last).isNotNull(), when)).alias(last)

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    lines = [
        parts["pipeline_runs"].agg(total("total_pipeline_runs").alias("total_pipeline_runs"), newest("last_run", "end_time")),
        parts["quality_results"].agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("entities")))).alias("entities"),
            total("valid_rows").alias("valid_rows"),
            total("rejected_rows").alias("rejected_rows"),
            percent(total("rejected_rows"), total("valid_rows") + total("rejected_rows")).alias("rejection_pct"),
        ),
        parts["streaming_metrics"].agg(total("stream_sessions").alias("stream_sessions"), newest("last_stream", "timestamp")),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lines)
    return every.agg(*[F.first(c, ignorenulls=True).alias(c) for c in every.columns]).select(
        "*",
        F.col("last_stream.avg_latency_seconds").alias("stream_latency_seconds"),
        F.col("last_stream.duplicates").alias("stream_duplicates"),
    )


def monitoring_report(runs: DataFrame, quality: DataFrame, streams: DataFrame) -> DataFrame:
    """One row over all logs: volumes, rejection, the last run and stream."""
    return _report({log: _totals(df, log) for log, df in zip(SCHEMAS, (runs, quality, streams), strict=True)})


def synced_report(spark: SparkSession, table_path: str) -> DataFrame:
    """The same report as of the last sync, from one row of totals per sync; no line is read again."""
    parts = {}
    for log in SCHEMAS:
        found = markers(spark, f"{table_path}/{log}{TOTALS}")
        none = _totals(flatten_nested(spark.createDataFrame([], SCHEMAS[log])), log)
        parts[log] = read_history(spark, f"{table_path}/{log}{TOTALS}") if found else none
    return _report(parts)
