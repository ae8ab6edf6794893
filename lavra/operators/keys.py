"""Joins on key lists where a null equals a null, and row positions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.session import stage

ROW_ID = "_row_id"


def same_keys(left: str, right: str, keys: Sequence[str], null_safe: bool = True) -> Column:
    """Equality of `keys` between two aliased frames."""
    pairs = [(F.col(f"{left}.`{k}`"), F.col(f"{right}.`{k}`")) for k in keys]
    return reduce(Column.__and__, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def left_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Left join keeping one copy of the keys.

    Null keys match null keys unless `null_safe` is off. Turn it off where keys
    are never null: a plain equality can use tables bucketed by the key, and a
    partitioning that is there already.

    No broadcast hint: Spark broadcasts `right` only below its size threshold,
    and otherwise splits a hot key of `left` over several tasks. With a plain
    equality, stage a `right` that is grouped by the same keys: Spark splits
    only a join whose two sides it shuffles.
    """
    added = [c for c in right.columns if c not in keys]
    return (
        left.alias("l")
        .join(right.alias("r"), same_keys("l", "r", keys, null_safe), "left")
        .select("l.*", *[F.col(f"r.`{c}`") for c in added])
    )


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of `left` with (or, for `left_anti`, without) a match in `right`."""
    return left.alias("l").join(right.alias("r"), same_keys("l", "r", keys), how)


def file_row_id() -> Column:
    """Position of a row in a Parquet table: file, then row in the file."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


def with_row_id(df: DataFrame) -> DataFrame:
    """`df` with the input position in `_row_id`.

    A frame that is no plain Parquet scan is written out first, so that a task
    run again after a lost executor sees the same positions.
    """
    if ROW_ID in df.columns:
        return df
    return stage(df, "rows").withColumn(ROW_ID, file_row_id())
