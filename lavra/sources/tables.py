"""Layer tables: partitioned Parquet, snapshots, history and loads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.operators.keys import ROW_ID, file_row_id
from lavra.sources.published import COPY, LoadError, Marker, Publication, markers, read_copies


def scan(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    ordered: bool = False,
) -> DataFrame:
    """Read only the named columns; sorted by key only when asked for."""
    df = spark.read.parquet(path).select(*columns)
    return df.orderBy(*keys) if ordered and keys else df


def with_positions(df: DataFrame) -> DataFrame:
    """A plain Parquet scan with each row's position, for "first row" decisions."""
    return df.withColumn(ROW_ID, file_row_id())


def write_partition(df: DataFrame, path: str, at: datetime | None = None, **partition: str) -> int:
    """Replace one partition, named by constants, and return its row count.

    Readers see the partition as it was until the new copy is whole, and stay with the old one if
    they have begun to read it. Without rows there is nothing to see.
    """
    with Publication(df.sparkSession) as run:
        return run.write(df, path, at, **partition)


def partition_values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Sorted values of a partition column among the published runs."""
    return sorted({m.partition[key] for m in markers(spark, path) if key in m.partition})


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All published runs of a table, with all of their columns, each in the widest of its types.

    A table without one is an error.
    """
    found = markers(spark, path)
    if not found:
        raise FileNotFoundError(f"no data in {path}")
    return read_copies(spark, path, found)


def read_partition(spark: SparkSession, path: str, **partition: str) -> DataFrame:
    """One published partition."""
    found = [m for m in markers(spark, path) if m.partition == partition]
    if not found:
        raise FileNotFoundError(f"no data in {path} for {partition}")
    return read_copies(spark, path, found)


def _newest(found: list[Marker]) -> Marker:
    """The newest run of a table partitioned by date and run."""
    keys = list(found[0].partition)
    return max(found, key=lambda m: (m.partition[keys[0]], m.at, [m.partition[k] for k in keys]))


def read_latest_snapshot(spark: SparkSession, path: str, positions: bool = False) -> DataFrame:
    """Only the newest published run of a table partitioned by date and run.

    Date, time and run come from the markers; the read is pruned to one folder.
    """
    found = markers(spark, path)
    if not found:
        raise FileNotFoundError(f"no data in {path}")
    df = spark.read.option("basePath", path).parquet(_newest(found).folder)
    return (with_positions(df) if positions else df).drop(COPY)


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType, **snapshot: bool) -> DataFrame:
    """Newest snapshot, or an empty frame where nothing was published yet; any other trouble is an error."""
    if not markers(spark, path):
        return spark.createDataFrame([], schema)
    return read_latest_snapshot(spark, path, **snapshot)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a fully refreshed table."""
    found = [m for m in markers(spark, path) if not m.partition]
    if not found:
        raise FileNotFoundError(f"no data in {path}")
    return read_copies(spark, path, found)


def full_refresh(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None) -> int:
    """Replace a whole table and return its row count, read back.

    The rows become a new version, which `check` may refuse before it is
    published. Until then readers see the version before, which stays on disk
    for those who are still reading it; older ones go.
    """
    with Publication(df.sparkSession) as run:
        rows = run.write(df, path)
        if check is not None:
            check(run.read(path))
    return rows


def load_fixed_schema(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Full refresh with declared types; refuses nulls in required columns of what was written."""
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    required = [f.name for f in schema.fields if not f.nullable]

    def no_nulls(written: DataFrame) -> None:
        nulls = written.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first().asDict()
        broken = {c: n for c, n in nulls.items() if n}
        if broken:
            raise LoadError(f"nulls in required columns: {broken}")

    return full_refresh(typed, path, no_nulls if required else None)


def require_equal(what: str, expected: int, found: int) -> None:
    """The counts that every load must keep."""
    if expected != found:
        raise LoadError(f"{what}: expected {expected} rows, found {found}")
