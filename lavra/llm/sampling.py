"""Bounded samples of rows for fitting, the same whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_ids(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most `bound` distinct ids, those with the smallest hash; each task passes on no more."""
    return df.select(F.col(key).alias("_id")).where("_id is not null").distinct().select(
        "_id", F.xxhash64(F.col("_id").cast("string")).alias("_order")
    ).orderBy("_order", "_id").limit(bound).select("_id")


def rows_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows with one of a bounded set of ids; the set is broadcast, the rows stay where they are."""
    return df.join(F.broadcast(ids), df[key] == ids["_id"], "left_semi")
