"""The scans that pick and rename columns of source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def directory_scan(
    df: DataFrame, key: str, columns: Mapping[str, str], ordered_by: str | None = None
) -> DataFrame:
    """Directory rows with a key: the key as text, columns under new names."""
    picked = df.where(F.col(key).isNotNull()).select(
        *[(F.col(c).cast("string") if c == key else F.col(c)).alias(out) for c, out in columns.items()]
    )
    return picked.orderBy(ordered_by) if ordered_by else picked


def target_scan(
    df: DataFrame, keys: Sequence[str], target_column: str, name: str = "valor_meta", ordered: bool = False
) -> DataFrame:
    """One column of a wide target table, where it is set."""
    picked = df.where(F.col(target_column).isNotNull()).select(*keys, F.col(target_column).alias(name))
    return picked.orderBy(*keys) if ordered else picked


def observed_scan(
    df: DataFrame, columns: Sequence[str], condition: Column, value: str, order: Sequence[str] = ()
) -> DataFrame:
    """Observed values of one part of the table."""
    picked = df.where(condition & F.col(value).isNotNull()).select(*columns)
    return picked.orderBy(*order) if order else picked


def ordered_sample(
    df: DataFrame, columns: Sequence[str], condition: Column, key: str, order: Sequence[str], n: int
) -> DataFrame:
    """The first `n` rows in a stated order, so that a second run gives the same."""
    picked = df.where(condition & F.col(key).isNotNull()).select(*columns)
    return picked.orderBy(*order).limit(n)
