"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from lavra.folders import drop_folder

_staged: list[str] = []
_folder_of: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

# Shuffle partitions are left to the cluster: AQE coalesces small ones and
# splits skewed ones, also where that costs a later shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session(app: str = "lavra", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the SQL settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read, named by `spark.checkpoint.dir`.

    Only a local master gets a folder of its own when the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="lavra-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, which `drop_stages` removes."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` to the shared folder once and read it back.

    The copy survives lost executors, and its size on disk is known, so a
    following join is broadcast only when it really is small.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    _folder_of[copy] = path
    return copy


def drop_copies(*copies: DataFrame) -> None:
    """Remove staged copies whose last reader has been written itself."""
    for copy in copies:
        path = _folder_of.pop(copy)
        drop_folder(copy.sparkSession, path)
        _staged.remove(path)


def drop_stages(spark: SparkSession) -> None:
    """Remove every staged copy and folder of this process, once nothing reads them any more."""
    while _staged:
        drop_folder(spark, _staged.pop())
