"""Nearest neighbours by multiprobe p-stable hashing.

Each of `tables` tables cuts space along `width` random Gaussian directions into slabs; the slab
numbers name a bucket. A query visits, in every table, its own bucket and then those a step over
the nearer slab borders, in the order in which they are expected to hold neighbours (the scores
of the perturbation sets are the expected squared distances to the sorted borders). Rows found in
any table are ranked by exact distance in double precision, ties by smaller id.

Queries go to the rows in blocks of at most `block` queries, a few MB each; rows never move. Every
task keeps the best `k` rows per query, so a vector that a third of all rows share costs no more
than others. A query with fewer than `k` finds is searched exactly.

The slab width follows the distance to the `k`-th neighbour in a bounded sample of `sample` rows,
those with the smallest id hash; every row is hashed. Vectors that are null or zero, or hold nulls
or non-finite numbers take no part. Vectors of different lengths have no distance: each length that
a query has is searched among the rows of that length, with an index of its own. Rows that share
an id are different candidates; a query does not find rows with its own id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import share_code
from lavra.llm.sampling import bounded_ids, rows_of
from lavra.session import stage

_ROWS = 2048  # rows compared at a time


@dataclass(frozen=True)
class Probing:
    """Parameters of the index."""

    tables: int = 12
    width: int = 10
    probes: int = 110
    slab: float = 2.0  # in units of the distance to the k-th neighbour in the sample
    sample: int = 2048
    block: int = 2048
    seed: int = 3


def usable(vector: str) -> Column:
    """Whether a vector takes part."""
    v = F.col(vector)
    big = F.lit(float("inf"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def perturbations(width: int, probes: int) -> list[tuple[int, ...]]:
    """The first sets of border ranks by expected squared distance, the empty set first."""
    m = width
    expected = [
        j * (j + 1) / (4 * (m + 1) * (m + 2))
        if j <= m
        else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
        for j in range(1, 2 * m + 1)
    ]
    found, heap = [()], [(expected[0], (0,))]
    while heap and len(found) < probes:
        score, ranks = heapq.heappop(heap)
        # the two borders of one slab are the ranks j and 2m - 1 - j
        if not any(2 * m - 1 - r in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1] + 1
        if last < 2 * m:
            heapq.heappush(heap, (score - expected[last - 1] + expected[last], (*ranks[:-1], last)))
            heapq.heappush(heap, (score + expected[last], (*ranks, last)))
    return found


@dataclass(frozen=True)
class Index:
    """Directions and offsets of all tables."""

    directions: np.ndarray  # tables x dimension x width, divided by the slab width
    offsets: np.ndarray
    mixers: np.ndarray
    sets: list[tuple[int, ...]]

    @classmethod
    def of(cls, dimension: int, slab: float, probing: Probing) -> Index:
        rng = np.random.default_rng(probing.seed)
        shape = (probing.tables, dimension, probing.width)
        return cls(
            rng.normal(size=shape) / slab,
            rng.random((probing.tables, probing.width)),
            rng.integers(1, 1 << 62, probing.width).astype(np.uint64) * np.uint64(2) + np.uint64(1),
            perturbations(probing.width, probing.probes),
        )

    def _names(self, slabs: np.ndarray) -> np.ndarray:
        """Buckets as 64-bit numbers; two that share one only add candidates."""
        return (slabs.astype(np.int64).astype(np.uint64) * self.mixers).sum(axis=-1, dtype=np.uint64)

    def buckets(self, table: int, x: np.ndarray) -> np.ndarray:
        return self._names(np.floor(x @ self.directions[table] + self.offsets[table]))

    def probes(self, table: int, x: np.ndarray) -> np.ndarray:
        """Per query the buckets to visit, in order."""
        place = x @ self.directions[table] + self.offsets[table]
        home = np.floor(place)
        inside = place - home
        width = home.shape[1]
        order = np.argsort(np.hstack([inside, 1 - inside]), axis=1, kind="stable")
        out = np.empty((len(x), len(self.sets)), np.uint64)
        rows = np.arange(len(x))
        for i, ranks in enumerate(self.sets):
            slabs = home.copy()
            for r in ranks:
                border = order[:, r]
                slabs[rows, border % width] += np.where(border < width, -1, 1)
            out[:, i] = self._names(slabs)
        return out


def _best(ids, x, query_ids, q, may, k) -> Iterator[tuple[int, int, float]]:
    """The `k` nearest allowed rows of each query."""
    square = (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1) - 2 * (q @ x.T)
    may &= query_ids[:, None] != ids
    square[~may] = np.inf
    if square.shape[1] > k:
        reach = np.partition(square, k - 1, axis=1)[:, k - 1]
    else:
        reach = np.full(len(q), np.inf)
    # a margin for rounding; what lies in it is ranked by the exact distance
    near = may & (square <= (reach + 1e-6 * (1 + np.abs(np.where(np.isfinite(reach), reach, 0))))[:, None])
    for i in np.flatnonzero(near.any(axis=1)):
        rows = np.flatnonzero(near[i])
        exact = np.sqrt(((x[rows] - q[i]) ** 2).sum(axis=1))
        for j in np.lexsort((ids[rows], exact))[:k]:
            yield int(query_ids[i]), int(ids[rows[j]]), float(exact[j])


def _search_block(rows: DataFrame, query_ids: np.ndarray, q: np.ndarray, index: Index | None, k: int) -> DataFrame:
    """Finds of one block of queries; without an index all rows are compared."""
    context = rows.sparkSession.sparkContext
    share_code(rows.sparkSession)
    probes = [np.unique(index.probes(t, q).ravel(), return_inverse=True) for t in range(len(index.offsets))] if index else []
    shared = context.broadcast((query_ids, q, index, probes))  # one block of queries
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, q, index, probes = shared.value
        best: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                vectors = part.column(1)
                x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
                may = np.full((len(q), len(ids)), index is None)
                for t, (names, inverse) in enumerate(probes):
                    own, place = np.unique(index.buckets(t, x), return_inverse=True)
                    at = np.minimum(np.searchsorted(own, names), len(own) - 1)
                    hit = own[at] == names
                    visits = np.zeros((len(q), len(own)), bool)
                    which = inverse.reshape(len(q), -1)
                    row, column = np.nonzero(hit[which])
                    visits[row, at[which[row, column]]] = True
                    may |= visits[:, place]
                for query, row, score in _best(ids, x, query_ids, q, may, k):
                    best.setdefault(query, []).append((score, row))
                if start % (8 * _ROWS) == 0:
                    best = {query: heapq.nsmallest(k, found) for query, found in best.items()}
        out = [(query, row, score) for query, found in best.items() for score, row in heapq.nsmallest(k, found)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.mapInArrow(search, "query_id long, vec_id long, score double")


def _blocks(queries: DataFrame, rows: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries in blocks of about `block`, one at a time on the driver."""
    n = max(1, -(-rows // block))
    for i in range(n):
        found = queries.where(F.pmod(F.xxhash64("id"), F.lit(n)) == i).orderBy("id").collect()
        if found:
            yield np.array([r["id"] for r in found], np.int64), np.array([r["v"] for r in found], np.float64)


def search(
    vectors: DataFrame, queries: Column, k: int = 10, probing: Probing | None = None, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The `k` nearest rows found for each row that `queries` picks."""
    probing = probing or Probing()
    rows = (
        vectors.where(F.col(key).isNotNull() & usable(vector))
        .select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asked"))
    )
    lengths = rows.where("asked").groupBy(F.size("v").alias("n")).agg(F.count("*").alias("queries")).orderBy("n")
    found = None
    for row in lengths.collect():  # one row where all vectors have the length that a table's vectors have
        part = _search_length(rows.where(F.size("v") == row["n"]), k, probing)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found


def _search_length(rows: DataFrame, k: int, probing: Probing) -> DataFrame:
    """The search among rows (id, v, asked) whose vectors have one length."""
    sample = rows_of(rows, bounded_ids(rows, "id", probing.sample), "id").orderBy("id").limit(2 * probing.sample).collect()
    dimension = len(sample[0]["v"])
    x = np.array([r["v"] for r in sample])
    square = np.maximum((x**2).sum(axis=1)[:, None] + (x**2).sum(axis=1) - 2 * (x @ x.T), 0)
    reach = np.sqrt(np.median(np.partition(square, min(k, len(x) - 1), axis=1)[:, min(k, len(x) - 1)]))
    index = Index.of(dimension, probing.slab * (reach if reach > 1e-9 else 1.0), probing)
    # equal queries share an id: their vectors are told apart by position only, so keep one row per id
    asked = stage(rows.where("asked").select("id", "v").dropDuplicates(["id"]), "ann-queries")
    count = rows.agg(F.count("*")).first()[0]
    n_asked = asked.count()
    found = None
    for ids, q in _blocks(asked, n_asked, probing.block):
        part = _search_block(rows.select("id", "v"), ids, q, index, k)
        found = part if found is None else found.unionByName(part)
    found = stage(_ranked(found, k), "ann-found")
    wanted = min(k, count - 1)
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= wanted)
    short = stage(asked.join(full, F.col("id") == F.col("query_id"), "left_anti"), "ann-short")
    n_short = short.count() if wanted else 0
    for ids, q in _blocks(short, n_short, probing.block) if n_short else ():
        exact = _ranked(_search_block(rows.select("id", "v"), ids, q, None, k), k)
        found = found.join(F.broadcast(exact.select("query_id").distinct()), "query_id", "left_anti").unionByName(exact)
    return found


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
