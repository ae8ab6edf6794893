"""Stream ingestion: validate, de-duplicate, write bronze, quarantine, metrics.

A batch reads its source once, into a copy. Ids of the copy are looked up in the index of seen ids,
and what is routed is published in one step: readers that go by `read_batches` never see half a batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lavra.functions.times import parse_iso, seconds_between
from lavra.sources.audit import append_audit, utc_now
from lavra.sources.published import Publication, markers, pack, read_copies, sweep
from lavra.sources.tables import read_history, with_positions
from lavra.streaming.events import EventSpec, validate_events
from lavra.streaming.once import Once
from lavra.streaming.routing import route_marked, route_marks
from lavra.streaming.seen import SeenIndex


@dataclass(frozen=True)
class StreamPaths:
    """Where a stream writes. `work` holds one batch at a time."""

    bronze: str
    quarantine: str
    metrics: str
    work: str
    index: str

    @classmethod
    def under(cls, base: str, name: str) -> StreamPaths:
        return cls(
            bronze=f"{base}/bronze/streaming/{name}",
            quarantine=f"{base}/quarantine/streaming/{name}",
            metrics=f"{base}/audit/streaming_batches/{name}",
            work=f"{base}/work/streaming/{name}",
            index=f"{base}/index/streaming/{name}",
        )


def enrich(events: DataFrame, at: datetime, spec: EventSpec) -> DataFrame:
    """Ingestion time, latency and load type; one time for the whole batch."""
    stamp = F.lit(at.isoformat()).cast("timestamp")
    time = F.col(spec.time_column)
    started = F.when(F.typeof(time) == "string", parse_iso(time.cast("string"))).otherwise(
        time.try_cast("timestamp")
    )
    return events.withColumns(
        {
            "_ingestion_time": F.lit(at.isoformat()),
            "_latency_s": seconds_between(started, stamp),
            "_load_type": F.lit("STREAMING"),
        }
    )


def write_routed(
    run: Publication, routed: DataFrame, paths: StreamPaths, identity: str, batch_id: int, at: datetime
) -> None:
    """Valid events to bronze, others with their errors to quarantine, counters.

    Everything lies under day and batch id. The counters are read from what was
    written, so the routing is not worked out a third time.
    """
    where = {"ingestion_date": at.date().isoformat(), "batch_id": str(batch_id)}

    def write(df: DataFrame, path: str) -> DataFrame:
        run.write(df, path, at, identity, **where)
        return run.read(path)

    good = routed.where("route = 'valid'").drop("route", "errors", "_bad_json")
    rest = routed.where("route <> 'valid'").drop("_latency_s", "_load_type", "_bad_json")
    kept = write(good, paths.bronze).agg(F.count("*").alias("valid"), F.sum("_latency_s").alias("latency_sum"))
    left_out = write(rest, paths.quarantine).agg(
        F.count_if(F.col("route") == "invalid").alias("invalid"),
        F.count_if(F.col("route") == "duplicate").alias("duplicates"),
    )
    counts = kept.unionByName(left_out, allowMissingColumns=True).agg(
        *[F.sum(c).alias(c) for c in ("valid", "invalid", "duplicates", "latency_sum")]
    )
    consumed = F.col("valid") + F.col("invalid") + F.col("duplicates")
    write(counts.select("*", consumed.alias("consumed"), F.lit(at.isoformat()).alias("timestamp")), paths.metrics)


def start_ingest(
    stream: DataFrame,
    spec: EventSpec,
    paths: StreamPaths,
    checkpoint: str,
    *,
    interval: str | None = None,
    seen: DataFrame | None = None,
    order_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Start the ingestion of decoded events.

    Without `interval` it takes what is there and stops; with one it runs on.
    The number of rows per batch is set on the source. `seen` holds ids that came in some other
    way; those of earlier batches are in the index beside bronze, whatever checkpoint brought them.

    Events, rejects, counters and the index's new ids of a batch are published together. A batch
    that is repeated after that is left out, one that stopped before is written anew.
    """
    events = validate_events(stream, spec)
    # The batch's own session has no adaptive plans; routing runs in this one.
    spark = stream.sparkSession
    index = SeenIndex(spark, paths.index)
    once = Once(spark, checkpoint, paths.metrics)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        identity = once.identity(batch_id)
        if identity is None:
            return
        at = utc_now()
        # One action reads the source; all else reads the copy.
        work = f"{paths.work}/current"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(work)
        rows = with_positions(spark.read.schema(batch.schema).parquet(work))
        again = index.known(rows.where(F.size("errors") == 0).select(spec.id_column).distinct())
        known = again if seen is None else again.unionByName(seen.select(spec.id_column))
        marks, placed = route_marks(rows, spec, known, order_by), f"{paths.work}/marks"
        marks.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(placed)
        routed = route_marked(rows, spark.read.schema(marks.schema).parquet(placed))
        with Publication(spark) as run:
            write_routed(run, enrich(routed, at, spec), paths, identity, batch_id, at)
            index.add(run, run.read(paths.bronze).select(spec.id_column), identity.replace(":", "-"))
        index.merge()

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def read_batches(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The published batches of a stream's table; empty with the given schema where there are none."""
    found = markers(spark, path)
    if not found and schema is not None:
        return spark.createDataFrame([], schema)
    return read_history(spark, path)


def session_metrics(spark: SparkSession, paths: StreamPaths, before: Sequence[str] = ()) -> DataFrame:
    """One row over the batches but those in `before`: the counters of a session."""
    schema = "consumed bigint, valid bigint, invalid bigint, duplicates bigint, latency_sum double, timestamp string"
    new = [m for m in markers(spark, paths.metrics) if m.copy not in set(before)]
    batches = read_copies(spark, paths.metrics, new) if new else spark.createDataFrame([], schema)

    def total(c: str):
        return F.coalesce(F.sum(c), F.lit(0))

    return batches.agg(
        *[total(c).alias(c) for c in ("consumed", "valid", "invalid", "duplicates")],
        F.count_if(F.col("valid") > 0).alias("flushed_batches"),
        F.coalesce(F.round(F.try_divide(F.sum("latency_sum"), F.sum("valid")), 3), F.lit(0.0)).alias(
            "avg_latency_seconds"
        ),
        F.max("timestamp").alias("timestamp"),
    )


def run_session(
    stream: DataFrame, spec: EventSpec, paths: StreamPaths, checkpoint: str, audit_path: str, **options
) -> DataFrame:
    """Take all that is there, then log the session's counters and return them."""
    spark = stream.sparkSession
    before = session_batches(spark, paths)
    start_ingest(stream, spec, paths, checkpoint, **options).awaitTermination()
    metrics = session_metrics(spark, paths, before)
    append_audit(metrics, audit_path, "streaming_metrics")
    return metrics


def session_batches(spark: SparkSession, paths: StreamPaths) -> list[str]:
    """The batches published so far, from the names of their markers alone."""
    return [m.copy for m in markers(spark, paths.metrics)]


def tidy(spark: SparkSession, paths: StreamPaths, target_bytes: int = 128 << 20, keep_seconds: float = 24 * 3600) -> int:
    """Pack small batches of bronze and quarantine and remove what no reader needs; gives the number of batches packed.

    The stream may run on meanwhile.
    """
    packed = sum(pack(spark, path, ["batch_id"], target_bytes) for path in (paths.bronze, paths.quarantine))
    for path in (paths.bronze, paths.quarantine, paths.metrics, f"{paths.index}/ids", f"{paths.index}/filters"):
        sweep(spark, path, keep_seconds)
    return packed
