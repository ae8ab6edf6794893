"""Publication of partitions: copies are written and counted first, and then seen all at once.

A table is a folder. Every write of a partition goes to a copy of its own (`day=D/_copy=…`) and is
seen once a marker names it: an empty file in the table's `_published` folder whose name says
partition, rows, time and copy. Of several copies of one partition the newest is seen, so replacing
a partition is a swap; the copy before stays on disk for those who are reading it, older ones go.

Copies of several tables are published together: their markers name a commit and count once the
commit's file lies in `_commits` below the tables' common folder. That file is the one step; before
it readers see none of the copies, after it all of them. What a crash leaves behind is never seen,
and `sweep` removes it.

`pack` rewrites small partitions into few files. Its marker names in its text what it replaces, so
that one file swaps them all.

The schema of a copy is kept beside the markers, once per schema and named by its hash. Reading
history needs no file footers, and runs whose columns or types differ are read by schema and
brought to the widest one.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import parse_qsl, urlencode
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lavra.folders import (
    changed_at,
    create_file,
    drop_folder,
    folder_bytes,
    folder_names,
    read_text,
    write_text,
)
from lavra.sources.schemas import merged, union_of

# Folders below a table or a common parent; Spark reads no folder of such a name.
MARKERS, COMMITS, SCHEMAS = "_published", "_commits", "_schemas"
COPY = "_copy"
_AT, _ROWS, _COMMIT, _SCHEMA, _AS, _PACK = "_at", "_rows", "_commit", "_schema", "_as", "_pack"
_INFO = (_AT, _ROWS, COPY, _COMMIT, _SCHEMA, _AS, _PACK)
_CLAIM = ".packing"


class LoadError(RuntimeError):
    """A load lost, gained or refused rows."""


@dataclass(frozen=True)
class Marker:
    """One copy of a partition of the table at `path`."""

    path: str
    info: dict[str, str] = field(hash=False)

    @classmethod
    def parse(cls, path: str, name: str) -> Marker:
        return cls(path, dict(parse_qsl(name, keep_blank_values=True)))

    @property
    def name(self) -> str:
        return urlencode(self.info)

    @property
    def partition(self) -> dict[str, str]:
        return {k: v for k, v in self.info.items() if k not in _INFO}

    @property
    def identity(self) -> tuple:
        """What a newer copy replaces."""
        if _PACK in self.info:
            return (_PACK, self.info[COPY])
        return (self.info[_AS],) if _AS in self.info else tuple(self.partition.items())

    @property
    def copy(self) -> str:
        return self.info[COPY]

    @property
    def rows(self) -> int:
        return int(self.info[_ROWS])

    @property
    def visible(self) -> bool:
        """A partition without rows is not there; a whole table may be empty."""
        return self.rows > 0 or not self.partition

    @property
    def at(self) -> str:
        return self.info[_AT]

    @property
    def folder(self) -> str:
        return "/".join([self.path, *[f"{k}={v}" for k, v in self.partition.items()], f"{COPY}={self.copy}"])

    @property
    def file(self) -> str:
        return f"{self.path}/{MARKERS}/{self.name}"

    @property
    def stamped(self) -> float:
        """Seconds since 1970 at which the copy was begun."""
        return int(self.copy.split("-")[0], 16) / 1e9


def _above(path: str, levels: int) -> str:
    return "/".join(path.rstrip("/").split("/")[:-levels] if levels else path.rstrip("/").split("/"))


def _common(paths: Sequence[str]) -> str:
    """The folder above all of the paths."""
    split = [p.rstrip("/").split("/") for p in paths]
    shared = []
    for parts in zip(*split):
        if len(set(parts)) > 1:
            break
        shared.append(parts[0])
    folder = "/".join(shared[: min(len(s) for s in split) - 1])
    if not folder.strip("/") or folder.endswith(":/") or folder.endswith(":"):
        raise ValueError(f"tables that are published together must lie below one folder: {sorted(paths)}")
    return folder


def _written(spark: SparkSession, path: str) -> list[Marker]:
    """All copies with a marker whose commit, if they are part of one, is there."""
    found = [Marker.parse(path, n) for n in folder_names(spark, f"{path}/{MARKERS}") if not n.startswith(".")]
    levels = {m.info[_COMMIT].split(".")[0] for m in found if _COMMIT in m.info}
    done = {f"{k}.{n}" for k in levels for n in folder_names(spark, f"{_above(path, int(k))}/{COMMITS}")}
    return [m for m in found if m.info.get(_COMMIT, "") in done or _COMMIT not in m.info]


def _packed(spark: SparkSession, written: list[Marker]) -> dict[str, Marker]:
    """Names of the markers that packs replace, with the pack."""
    return {name: m for m in written if _PACK in m.info for name in read_text(spark, m.file).splitlines()}


def markers(spark: SparkSession, path: str) -> list[Marker]:
    """The copies that readers see, oldest first."""
    written = _written(spark, path)
    packed = _packed(spark, written)
    newest: dict[tuple, Marker] = {}
    for m in sorted((m for m in written if m.name not in packed), key=lambda m: m.copy):
        newest[m.identity] = m
    return sorted((m for m in newest.values() if m.visible), key=lambda m: m.copy)


def published(spark: SparkSession, path: str, identity: str) -> bool:
    """Whether a partition was published under that name, also where it holds no rows or was packed since."""
    written = _written(spark, path)
    names = [m.info for m in written] + [dict(parse_qsl(n)) for n in _packed(spark, written)]
    return any(info.get(_AS) == identity for info in names)


class Publication:
    """Copies of partitions that are seen all at once, or not at all.

    As a context it publishes at the end; an error inside drops what was written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.made: list[Marker] = []

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.publish()
        else:
            self.drop()

    def write(
        self,
        df: DataFrame,
        path: str,
        at: datetime | None = None,
        identity: str | None = None,
        folders: Sequence[str] = (),
        **partition: str,
    ) -> int:
        """Write a copy of a partition named by constants, and return its row count, read back.

        The rows go straight into the copy's folder: a dynamic partition write would sort them all by
        the constants first. `identity` names what a later copy replaces, where that is not the
        partition. Columns in `folders` become folders of the copy, by which reads are pruned.
        """
        spark, rows = self.spark, df.drop(*partition)
        marker = self._marker(path, at, identity, partition)
        try:
            # hashes are written as text, which zstd brings to about half of what it is with snappy
            rows.write.partitionBy(*folders).option("compression", "zstd").parquet(marker.folder)
            count = spark.read.schema(rows.schema).parquet(marker.folder).count()
            marker.info[_ROWS], marker.info[_SCHEMA] = str(count), _keep_schema(spark, marker.path, rows.schema)
        except Exception:
            drop_folder(spark, marker.folder)
            raise
        self.made.append(marker)
        return count

    def remove(self, path: str, **partition: str) -> None:
        """A partition that is not there any more once this is published."""
        marker = self._marker(path, None, None, partition)
        marker.info[_ROWS] = "0"
        self.made.append(marker)

    def _marker(self, path: str, at: datetime | None, identity: str | None, partition: dict[str, str]) -> Marker:
        """A marker with a copy of its own, newer than all there are."""
        path = path.rstrip("/")
        info = {
            **partition,
            _AT: (at or datetime.now(timezone.utc)).astimezone(timezone.utc).isoformat(),
            COPY: f"{time.time_ns():016x}-{uuid4().hex[:8]}",
            **({_AS: identity} if identity is not None else {}),
        }
        marker = Marker(path, info)
        same = [m.copy for m in _written(self.spark, path) if m.identity == marker.identity]
        if same and max(same) >= marker.copy:  # clocks differ between writers
            info[COPY] = f"{int(max(same).split('-')[0], 16) + 1:016x}-{uuid4().hex[:8]}"
        return marker

    def read(self, path: str) -> DataFrame:
        """What this publication wrote to a table, before or after it is published."""
        return read_copies(self.spark, path, [m for m in self.made if m.path == path.rstrip("/")])

    def drop(self) -> None:
        for marker in self.made:
            drop_folder(self.spark, marker.folder)
        self.made = []

    def publish(self) -> None:
        """Let readers see the copies, and let go of what they replace but for the copy before."""
        spark = self.spark
        tables = list(dict.fromkeys(m.path for m in self.made))
        if len(self.made) > 1:
            parent, commit = _common(tables) if len(tables) > 1 else tables[0], uuid4().hex[:12]
            for marker in self.made:
                levels = len(marker.path.split("/")) - len(parent.split("/"))
                marker.info[_COMMIT] = f"{levels}.{commit}"
                create_file(spark, marker.file)
            create_file(spark, f"{parent}/{COMMITS}/{commit}")
        else:
            for marker in self.made:
                create_file(spark, marker.file)
        for marker in self.made:
            if not marker.visible:
                drop_folder(spark, marker.folder)
            _retire(spark, marker)
        self.made = []


def _retire(spark: SparkSession, marker: Marker) -> None:
    """Remove copies of a partition that are older than the one before its newest."""
    same = sorted((m for m in _written(spark, marker.path) if m.identity == marker.identity), key=lambda m: m.copy)
    for old in same[:-2]:
        drop_folder(spark, old.file)
        drop_folder(spark, old.folder)


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> str:
    text = schema.json()
    name = hashlib.sha256(text.encode()).hexdigest()[:16]
    if name not in folder_names(spark, f"{path}/{SCHEMAS}"):
        write_text(spark, f"{path}/{SCHEMAS}/{name}", text)
    return name


def read_copies(spark: SparkSession, path: str, copies: Sequence[Marker]) -> DataFrame:
    """The rows of some copies with their partition columns, in the widest of their schemas.

    Copies of one schema and kind of partition are one scan.
    """
    path = path.rstrip("/")
    groups: dict[tuple, list[Marker]] = {}
    for m in copies:
        groups.setdefault((m.info[_SCHEMA], tuple(m.partition)), []).append(m)
    schemas = {
        name: T.StructType.fromJson(json.loads(read_text(spark, f"{path}/{SCHEMAS}/{name}"))) for name, _ in groups
    }
    frames = [
        spark.read.schema(schemas[name]).option("basePath", path).parquet(*[m.folder for m in group]).drop(COPY)
        for (name, _), group in groups.items()
    ]
    if len(frames) == 1:
        return frames[0]
    return union_of(frames, merged(list(schemas.values())))


# --- packing and sweeping ----------------------------------------------------


@contextmanager
def _claim(spark: SparkSession, path: str, stale_seconds: float) -> Iterator[None]:
    """One packer at a time; the claim of one that crashed is taken over once it is old."""
    claim = f"{path}/{MARKERS}/{_CLAIM}"
    if _CLAIM in folder_names(spark, f"{path}/{MARKERS}") and time.time() - changed_at(spark, claim) > stale_seconds:
        drop_folder(spark, claim)
    try:
        create_file(spark, claim, replace=False)
    except Exception as error:
        raise LoadError(f"{path} is being packed by another run") from error
    try:
        yield
    finally:
        drop_folder(spark, claim)


def pack(
    spark: SparkSession,
    path: str,
    over: Sequence[str],
    target_bytes: int = 128 << 20,
    stale_seconds: float = 6 * 3600,
) -> int:
    """Rewrite partitions smaller than a target into files of about that size; gives the number of partitions replaced.

    The partition columns `over`, such as the number of a batch, become columns of the files; the
    other ones stay folders. Spark's own file reader fills each task with small files up to the
    target, and each task writes one file; there is no shuffle. The new copy counts the rows it
    must hold and is swapped in by one file, while readers go on with the old ones, which `sweep`
    removes later. Writers add other partitions meanwhile. A partition that was packed is final.
    """
    path, replaced = path.rstrip("/"), 0
    with _claim(spark, path, stale_seconds):
        groups: dict[tuple, list[Marker]] = {}
        for m in markers(spark, path):
            if folder_bytes(spark, m.folder) < target_bytes:
                kept = {k: v for k, v in m.partition.items() if k not in over}
                groups.setdefault(tuple(kept.items()), []).append(m)
        for kept, group in groups.items():
            # a pack that was not filled yet is worth rewriting only with others
            if len(group) > 1:
                _pack_group(spark, path, dict(kept), group, target_bytes)
                replaced += len(group)
    return replaced


def _pack_group(spark: SparkSession, path: str, kept: dict[str, str], group: list[Marker], target_bytes: int) -> None:
    packing = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {k: spark.conf.get(k, None) for k in packing}
    run = Publication(spark)
    try:
        for k, v in packing.items():
            spark.conf.set(k, v)
        found = run.write(read_copies(spark, path, group), path, **kept)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    expected = sum(m.rows for m in group)
    if found != expected:
        run.drop()
        raise LoadError(f"packing of {path}: expected {expected} rows, found {found}")
    (marker,) = run.made
    marker.info[_PACK] = str(len(group))
    gone = [m.name for m in group]
    inner = [n for m in group if _PACK in m.info for n in read_text(spark, m.file).splitlines()]
    write_text(spark, marker.file, "\n".join(gone + inner))


def sweep(spark: SparkSession, path: str, keep_seconds: float = 24 * 3600) -> int:
    """Remove copies that no reader sees and that were replaced or given up at least so long ago; gives their number."""
    path, now = path.rstrip("/"), time.time()
    written = _written(spark, path)
    packed = _packed(spark, written)
    seen = {m.name for m in markers(spark, path)}
    every = [Marker.parse(path, n) for n in folder_names(spark, f"{path}/{MARKERS}") if not n.startswith(".")]
    heads: dict[tuple, Marker] = {}  # the newest copy of a partition may hold no rows
    for m in sorted(written, key=lambda m: m.copy):
        heads[m.identity] = m
    gone = 0
    for m in every:
        pack, head = packed.get(m.name), heads.get(m.identity)
        if m.name not in seen and (pack or head is None or head.name != m.name):
            if now - (pack or head or m).stamped >= keep_seconds:
                drop_folder(spark, m.file)
                drop_folder(spark, m.folder)
                gone += 1
    known = {m.folder for m in every}
    for folder in _copy_folders(spark, path):
        if folder not in known and now - changed_at(spark, folder) >= keep_seconds:
            drop_folder(spark, folder)
            gone += 1
    return gone


def sweep_commits(spark: SparkSession, parent: str, paths: Sequence[str]) -> int:
    """Remove commits below a common folder that no marker of its tables names any more, which must be all given; gives their number."""
    named = {
        Marker.parse(p, n).info.get(_COMMIT, ".").split(".")[1] for p in paths for n in folder_names(spark, f"{p}/{MARKERS}")
    }
    old = [n for n in folder_names(spark, f"{parent}/{COMMITS}") if n not in named]
    for name in old:
        drop_folder(spark, f"{parent}/{COMMITS}/{name}")
    return len(old)


def _copy_folders(spark: SparkSession, path: str) -> Iterator[str]:
    for name in folder_names(spark, path):
        if name.startswith(f"{COPY}="):
            yield f"{path}/{name}"
        elif "=" in name:
            yield from _copy_folders(spark, f"{path}/{name}")
