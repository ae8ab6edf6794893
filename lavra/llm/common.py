"""What several operators of this subpackage share."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.session import stage

# The white space that separates words (space and U+0009 to U+000D).
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), "")


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def share_code(spark: SparkSession | None = None) -> None:
    """Let Python workers find this package where the driver has it.

    On machines without that folder, ship the package with `--py-files` as usual.
    """
    context = (spark or SparkSession.active()).sparkContext
    root = str(Path(__file__).resolve().parents[2])
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


_held: dict[str, object] = {}


def worker_keeps(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks under a name; a worker keeps one thing at a time."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def let_go() -> None:
    """Free what this Python worker keeps for an operator that ran before: Spark uses workers again."""
    if _held:
        _held.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on no more than so many rows in an Arrow batch, which whole texts would make large; a smaller setting stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= rows:
        spark.conf.set(setting, rows)


def settled(df: DataFrame, name: str) -> DataFrame:
    """A staged copy, after which Spark may drop the shuffle files that made it.

    It drops those of plans that nothing refers to any more, once the driver collects its
    garbage, which a small driver heap may put off until the disks are full.
    """
    copy = stage(df, name)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return copy


@contextmanager
def filtered_joins(spark: SparkSession) -> Iterator[None]:
    """Within, Spark tests rows of any table against a Bloom filter of a small join side before it shuffles them."""
    setting = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "0")
    try:
        yield
    finally:
        spark.conf.set(setting, before)
