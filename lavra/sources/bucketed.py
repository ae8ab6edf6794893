"""Tables kept in buckets of their keys, so that joins and groupings on these need no shuffle.

A table is a folder. Every write goes to a folder of its own below it and is seen once a small
file names that folder, its schema and its buckets; the newest of them is the table. A reader keeps
the copy it began with, a crashed write is never seen.

Rows of one key must share a bucket, and a bucket is one task's work that Spark cannot split. Rows
are counted per bucket first, therefore, and where one would hold more than `most_of_mean` times
the mean, the copy is written without buckets: joins shuffle it, and Spark splits the hot key there.
Null keys share a bucket like any key. Tables are registered in the session's catalog under a name
made from their path.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.folders import folder_names, read_text, write_text

_NAMED = "_table-"


@dataclass(frozen=True)
class Buckets:
    """Keys that a table is clustered by, and the number of buckets; none for a table that is not."""

    keys: tuple[str, ...]
    count: int


def buckets_for(total_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """A power of two, so that tables of different sizes can be brought to the smaller number."""
    return 1 << max(0, -(-total_bytes // bucket_bytes) - 1).bit_length()


def _evenly(df: DataFrame, buckets: Buckets, most_of_mean: float) -> bool:
    """Whether no bucket is much larger than the mean; a row per bucket at most comes back."""
    number = F.pmod(F.hash(*map(_column, buckets.keys)), F.lit(buckets.count))  # the bucket that Spark writes a row to
    sizes = df.groupBy(number.alias("b")).agg(F.count("*").alias("n"))
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return not total or most <= most_of_mean * total / buckets.count


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], count: int, most_of_mean: float = 4.0) -> Buckets:
    """Replace the table at `path`; the buckets it was given, a count of 0 where a key is too hot for them.

    `df` is read twice, so it should be a table or a staged copy.
    """
    spark = df.sparkSession
    buckets = Buckets(tuple(keys), count)
    if count > 1 and not _evenly(df, buckets, most_of_mean):
        buckets = Buckets((), 0)
    copy = f"copy-{uuid4().hex}"
    spec = {"copy": copy, "schema": df.schema.jsonValue(), "keys": buckets.keys, "count": buckets.count}
    if buckets.count:
        # dealt as the buckets are, so that each is one file
        df.repartition(buckets.count, *map(_column, buckets.keys)).write.insertInto(_registered(spark, path, spec))
    else:
        df.write.parquet(f"{path}/{copy}")
    done = _specs(spark, path)
    at = int(done[-1][len(_NAMED) :].split("-")[0]) + 1 if done else 0
    write_text(spark, f"{path}/{_NAMED}{at:09d}-{uuid4().hex}", json.dumps(spec))
    return buckets


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The newest copy of the table, with its buckets if it has any."""
    done = _specs(spark, path)
    if not done:
        raise FileNotFoundError(f"no table at {path}")
    spec = json.loads(read_text(spark, f"{path}/{done[-1]}"))
    if not spec["count"]:
        return spark.read.schema(T.StructType.fromJson(spec["schema"])).parquet(f"{path}/{spec['copy']}")
    return spark.table(_registered(spark, path, spec))


def _specs(spark: SparkSession, path: str) -> list[str]:
    return sorted(name for name in folder_names(spark, path) if name.startswith(_NAMED))


def _registered(spark: SparkSession, path: str, spec: dict) -> str:
    """The catalog's name of a copy; the catalog holds no rows, and another session registers it anew."""
    location = f"{path}/{spec['copy']}"
    name = f"bucketed_{hashlib.sha256(location.encode()).hexdigest()[:32]}"
    keys = ", ".join(map(_name, spec["keys"]))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({T.StructType.fromJson(spec['schema']).toDDL()}) USING parquet"
        f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec['count']} BUCKETS LOCATION {_quoted(location)}"
    )
    return name


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _column(name: str) -> Column:
    return F.col(_name(name))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
