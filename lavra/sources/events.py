"""Event files and topics."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.session import stage

# Positions of a record, whatever source it comes from.
POSITION = ("_partition", "_offset", "_time")
BAD_RECORD = "_bad_record"


def event_file_forms(spark: SparkSession, path: str) -> DataFrame:
    """Each file below a path with its first visible character, found where the file is read."""
    lines = (
        spark.read.option("recursiveFileLookup", "true").text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
            F.substring(F.regexp_extract("value", r"^[\s\uFEFF]*(\S)", 1), 1, 1).alias("mark"),
        )
    )
    return lines.where("mark <> ''").groupBy("file").agg(F.min_by("mark", "place").alias("mark"))


def read_event_files(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Events of all files below a path, each file a JSON array or JSON lines.

    What cannot be parsed has its text in `_bad_record`. A file without any
    visible character holds no event. Only file names come to the driver.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = T.StructType([*wanted.fields, T.StructField(BAD_RECORD, T.StringType())])
    forms = event_file_forms(spark, path).collect()
    found = spark.createDataFrame([], wanted)
    for is_array in (True, False):
        files = sorted(unquote(f["file"]) for f in forms if (f["mark"] == "[") is is_array)
        if files:
            reader = spark.read.schema(wanted).option("columnNameOfCorruptRecord", BAD_RECORD).option("multiLine", is_array)
            found = found.unionByName(reader.json(files))
    return found


def read_event_file(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The events of `read_event_files` that could be parsed."""
    return stage(read_event_files(spark, path, schema), "event-files").where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)


def bad_event_records(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The text of what could not be parsed, for quarantine."""
    return stage(read_event_files(spark, path, schema), "event-files").where(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD)


def topic_stream(spark: SparkSession, servers: str, topic: str, max_per_batch: int | None = None) -> DataFrame:
    """A topic from its first record on; needs Spark's Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return topic_values(reader.load())


def topic_values(records: DataFrame) -> DataFrame:
    """Text and position of topic records."""
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.concat_ws("-", "topic", F.lpad(F.col("partition").cast("string"), 10, "0")).alias("_partition"),
        F.col("offset").cast("bigint").alias("_offset"),
        F.col("timestamp").cast("timestamp").alias("_time"),
    )


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files that arrive in a folder, one event text per row."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).where(F.trim("value") != "").select(
        "value",
        F.col("_metadata.file_path").alias("_partition"),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.col("_metadata.file_modification_time").alias("_time"),
    )


def topic_records(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Key and JSON value of each event, as a topic takes them."""
    return events.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish(events: DataFrame, servers: str, topic: str, key: str = "event_id") -> None:
    """Write events to a topic; needs Spark's Kafka connector."""
    (
        topic_records(events, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
