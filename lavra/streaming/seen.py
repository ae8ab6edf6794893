"""Index of the ids seen so far: exact, and read only where it may hold an id that is asked for.

Ids lie in generations, one for each addition. A generation spreads its ids over buckets by hash, a
folder each, and keeps a Bloom filter per bucket in a table beside them. A look-up takes the ids
asked for (the batch's, not history's), tests each against the filter of its bucket in every
generation, and reads only the buckets that may hold one; a join there decides. What is read
follows the ids that come back, and hardly grows with what was seen before.

Generations of like size are merged eightfold, so there are few, each id is rewritten as often as
the index grows eightfold, and buckets stay at about `bucket_ids` ids. An addition belongs to a
publication: the ids are known from the moment on at which the rows that carry them are seen.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.session import stage
from lavra.sources.published import Marker, Publication, markers, read_copies

# Bits per id and hashes per id of the filters: about one id in a hundred passes by chance.
BITS, HASHES = 10, 4
# Generations of one size that are merged into one.
FAN_IN = 8
# Filters of one size, some 130 KB each at most with the usual `bucket_ids`, that go to every task.
FEW = 64


def _power(n: float) -> int:
    """The smallest power of two that is no less."""
    return 1 << max(0, int(-(-n // 1)) - 1).bit_length()


def _bits(id_: Column, size: Column | int) -> list[Column]:
    """The bits of an id in a filter of a size, which is a power of two."""
    return [F.pmod(F.xxhash64(id_, F.lit(i)), F.lit(size) if isinstance(size, int) else size) for i in range(HASHES)]


def _bucket(id_: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), id_), F.lit(buckets)).cast("int")


def filters(ids: DataFrame, buckets: int, words: int) -> DataFrame:
    """A Bloom filter of 64 * `words` bits for each bucket of (bucket, id): (bucket, bits)."""
    at = F.explode(F.array(*_bits(F.col("id"), 64 * words))).alias("at")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    spread = ids.select("bucket", at).select("bucket", F.floor(F.col("at") / 64).cast("int").alias("word"), one.alias("mask"))
    every = ids.sparkSession.range(buckets * words).select(
        F.floor(F.col("id") / words).cast("int").alias("bucket"),
        (F.col("id") % words).cast("int").alias("word"),
        F.lit(0).cast("long").alias("mask"),
    )
    dense = spread.unionByName(every).groupBy("bucket", "word").agg(F.bit_or("mask").alias("mask"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "mask")))  # as many as a filter has words
    return dense.groupBy("bucket").agg(F.transform(in_order, lambda x: x["mask"]).alias("bits"))


def may_hold(bits: Column, id_: Column) -> Column:
    """Whether a filter may hold an id; never false for one that it holds."""
    places = _bits(id_, (F.size(bits) * 64).cast("long"))
    words = [F.get(bits, F.floor(p / 64).cast("int")) for p in places]
    shifted = [F.call_function("shiftright", w, (p % 64).cast("int")) for w, p in zip(words, places, strict=True)]
    return reduce(Column.__and__, [s.bitwiseAND(F.lit(1)) == 1 for s in shifted])


@dataclass(frozen=True)
class SeenIndex:
    """The index in two tables below a folder. Ids are text."""

    spark: SparkSession
    path: str
    bucket_ids: int = 100_000

    @property
    def ids_path(self) -> str:
        return f"{self.path}/ids"

    @property
    def filters_path(self) -> str:
        return f"{self.path}/filters"

    def generations(self) -> list[Marker]:
        return markers(self.spark, self.ids_path)

    def add(self, run: Publication, ids: DataFrame, generation: str) -> int:
        """Write distinct ids that are not in the index yet as one generation; gives their number."""
        ids = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).where("id is not null")
        count = ids.count()
        if not count:
            return 0
        buckets = _power(count / self.bucket_ids)
        placed = ids.select(_bucket(F.col("id"), buckets).alias("bucket"), "id").repartition(buckets, "bucket")
        which = {"generation": generation, "buckets": str(buckets)}
        run.write(placed, self.ids_path, folders=["bucket"], **which)
        written = run.read(self.ids_path).where(F.col("generation") == generation).select("bucket", "id")
        words = _power(BITS * count / buckets / 64)
        run.write(filters(written, buckets, words), self.filters_path, **which)
        return count

    def hits(self, ids: DataFrame) -> DataFrame:
        """Where ids may be: (id, generation, bucket)."""
        copies = markers(self.spark, self.filters_path)
        wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("id"))
        found = []
        for buckets in sorted({m.partition["buckets"] for m in copies}):
            of_size = read_copies(self.spark, self.filters_path, [m for m in copies if m.partition["buckets"] == buckets])
            filters_ = of_size.select("generation", "bucket", "bits")
            if sum(m.rows for m in copies if m.partition["buckets"] == buckets) <= FEW:
                filters_ = F.broadcast(filters_)  # at most FEW filters of bounded size; few buckets would gather all ids asked for
            placed = wanted.withColumn("bucket", _bucket(F.col("id"), int(buckets)))
            met = placed.join(filters_, "bucket")
            found.append(met.where(may_hold(F.col("bits"), F.col("id"))).select("id", "generation", "bucket"))
        if not found:
            return self.spark.createDataFrame([], "id string, generation string, bucket int")
        return reduce(DataFrame.unionByName, found)

    def bucket_rows(self, hits: DataFrame) -> DataFrame | None:
        """The ids of the buckets that were hit, each generation pruned to its own; None where there are none."""
        buckets: dict[str, list[int]] = {}
        for generation, bucket in hits.select("generation", "bucket").distinct().collect():  # as file names go to a plan
            buckets.setdefault(generation, []).append(bucket)
        parts = [
            read_copies(self.spark, self.ids_path, [m]).where(F.col("bucket").isin(buckets[m.partition["generation"]]))
            for m in self.generations()
            if m.partition["generation"] in buckets
        ]
        return reduce(DataFrame.unionByName, parts).select("generation", "bucket", "id") if parts else None

    def known(self, ids: DataFrame) -> DataFrame:
        """Those of the distinct ids that the index holds."""
        name = ids.columns[0]
        hits = stage(self.hits(ids), "seen-hits") if self.generations() else None
        rows = self.bucket_rows(hits) if hits is not None else None
        if rows is None:
            return ids.limit(0)
        found = hits.join(rows, ["generation", "bucket", "id"], "left_semi")
        return found.select(F.col("id").cast(ids.schema[name].dataType).alias(name))

    def merge(self) -> int:
        """Merge generations wherever eight have the same number of digits to base eight; gives the number merged."""
        tiers: dict[int, list[Marker]] = {}
        for m in self.generations():
            tiers.setdefault((m.rows.bit_length() - 1) // 3, []).append(m)
        merged = 0
        for same in tiers.values():
            if len(same) < FAN_IN:
                continue
            with Publication(self.spark) as run:
                old = read_copies(self.spark, self.ids_path, same)
                self.add(run, old.select("id"), f"{same[-1].partition['generation']}+")
                for m in same:
                    run.remove(self.ids_path, **m.partition)
                    run.remove(self.filters_path, **m.partition)
            merged += len(same)
        return merged
