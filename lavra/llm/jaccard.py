"""Exact join of texts by the Jaccard distance of their word shingles, as connected components.

Two texts link when their shingle sets have a similarity of `percent` or more. The distance is a
metric, and unrelated texts are all at distance one from each other, so pivots work on two levels.

First level: the pivots are single shingles. A set's nearest pivots are its own members, taken in
one order for all sets. Within the distance limit at most a fifth of a set differs, so a set lies
in the Voronoi region of its first member, and its boundary window is the members that could come
first in a near set: it is replicated to those regions, and any two linked sets meet in one. The
order is by hash at first, to drop texts whose window is not shared enough for a link, and then,
for the few that are left, by frequency in half powers of two, rarest first, and then by hash.

Second level: regions that overlap form groups. A group of at most `leaf` sets is joined in one
task; sets are sorted by distance to a pivot set, and only those within the limit of each other
there are compared. A larger group gets pivot sets; sets within the limit of a pivot link to it,
and sets that are connected need not meet again. Each set's home is its nearest pivot, and it is
replicated to pivots no further than home plus twice the limit, where that cuts the group. What is
left of the regions is joined recursively. A group that is still too large after `levels` rounds is
cut into blocks, and every two of them meet in a task of their own, where members shared are
counted and no pair is written. Nothing is capped and no link is lost.

Equal sets are one class, named by the smallest id, and travel once. Shingles are 64-bit hashes.
Texts without words have no shingles and no links; a text with fewer words than a shingle has one,
of all its words. Repeated rows are copies. Rows without an id take part under their copies' id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import filtered_joins, let_go, settled, share_code
from lavra.llm.components import components
from lavra.session import drop_copies, stage

_CHARS = 4_000_000  # characters handled at a time


@dataclass(frozen=True)
class Join:
    """Parameters of the join."""

    words: int = 5
    percent: int = 80
    leaf: int = 1024
    pivots: int = 8
    levels: int = 1  # rounds of pivots
    parts: int = 3  # of all members, shuffled one after the other


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in one array, and where each text's begin."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    coded = flat.dictionary_encode()
    known = coded.dictionary.to_numpy(zero_copy_only=False)
    place = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    real = np.array([w != "" for w in known], bool)[place] if len(known) else np.zeros(0, bool)
    place, row = place[real], row[real]  # blanks at the ends leave empty words
    code = pd.util.hash_array(known, categorize=False)[place] if len(known) else np.zeros(0, np.uint64)
    counts = np.bincount(row, minlength=len(texts))
    powers = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(words)]
    n = max(0, len(code) - words + 1)
    key = np.zeros(n, np.uint64)
    for i, power in enumerate(powers):
        key += code[i : i + n] * power
    whole = row[:n] == row[words - 1 :] if n else np.zeros(0, bool)
    key, own = _mixed(key[whole]), row[:n][whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        starts = np.cumsum(counts) - counts
        extra = [
            sum(int(code[starts[r] + i]) * int(powers[i]) for i in range(counts[r])) + int(counts[r]) for r in short
        ]
        key = np.concatenate([key, _mixed(np.array([e % (1 << 64) for e in extra], np.uint64))])
        own = np.concatenate([own, short])
    signed = key.view(np.int64)
    order = np.lexsort((signed, own))
    signed, own = signed[order], own[order]
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (signed[1:] != signed[:-1])
    signed, own = signed[first], own[first]
    return signed, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(texts)))])


def _groups(column: pa.Array) -> Iterator[pa.Array]:
    """Texts in slices of bounded length."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + _CHARS)))
        yield column.slice(start, end - start)
        start = end


def signatures(text: Column, words: int) -> Column:
    """Size and two 64-bit sums of each text's set."""
    share_code()

    @F.arrow_udf("struct<n:int,s1:long,s2:long>")
    def sums(column: pa.Array) -> pa.Array:
        let_go()
        parts = []
        for part in _groups(column):
            keys, at = shingle_sets(part, words)
            n = np.diff(at)
            sums = []
            for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
                run = np.concatenate([[0], np.cumsum(_mixed(keys.view(np.uint64) * np.uint64(salt)))]).astype(np.uint64)
                sums.append(pa.array((run[at[1:]] - run[at[:-1]]).view(np.int64)))
            parts.append(pa.StructArray.from_arrays([pa.array(n, pa.int32()), *sums], ["n", "s1", "s2"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64())]))

    return sums(text)


def shingles(text: Column, words: int, window: bool = False) -> Column:
    """Each text's set in hash order, or the window of it that must hold a twentieth of shared members."""
    share_code()

    @F.arrow_udf("array<long>")
    def sets(column: pa.Array) -> pa.Array:
        let_go()
        parts = []
        for part in _groups(column):
            keys, at = shingle_sets(part, words)
            if window:
                n = np.diff(at)
                length = np.minimum(n, n // 5 + (n + 19) // 20)
                keys = keys[np.arange(len(keys)) - np.repeat(at[:-1], n) < np.repeat(length, n)]
                at = np.concatenate([[0], np.cumsum(length)])
            parts.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return sets(text)


def similar(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both


def survivors(docs: DataFrame, members: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """A copy of the ids of texts whose window holds as many shared shingles as a link needs, one id per class.

    Of two linked sets the members they share come within the windows of both, up to the smaller of
    the two twentieths, and that is at least a twenty-fifth of either set.
    """
    rows = docs.select(F.col(key).alias("doc"), F.explode(shingles(F.col(text), join.words, window=True)).alias("h"))
    shared = rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1").select(F.col("h").alias("h2"))
    shared = settled(shared, "jaccard-shared")
    near = rows.join(shared, F.col("h") == F.col("h2"), "left_semi").groupBy("doc").agg(F.count("*").alias("n_shared"))
    heads = members.where("n > 0 and doc = class").select("doc", "n").distinct()
    enough = near.join(heads, "doc").where(F.col("n_shared") >= F.floor((F.col("n") + 24) / 25))
    found = settled(enough.select(F.col("doc").alias("_doc"), "n_shared"), "jaccard-near")
    drop_copies(shared)
    return found


def classes(docs: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """Per row its id, the size of its set, and the smallest id with an equal set."""
    sized = docs.select(F.col(key).alias("doc"), signatures(F.col(text), join.words).alias("s")).select("doc", "s.*")
    sized = stage(sized, "jaccard-sizes")
    names = sized.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc").alias("class"))
    return sized.join(names, ["n", "s1", "s2"], "left").select("doc", "n", F.coalesce("class", "doc").alias("class"))


def regions(docs: DataFrame, members: DataFrame, key: str, text: str, join: Join) -> tuple[DataFrame, DataFrame]:
    """(h, doc) of all regions, and (doc, n, set) of the classes in them."""
    wanted = survivors(docs, members, key, text, join)
    found = docs.select(F.col(key).alias("doc"), F.col(text).alias("_text")).join(
        wanted.where("n_shared > 0").hint("merge"), F.col("doc") == F.col("_doc"), "left_semi"
    )
    with filtered_joins(docs.sparkSession):
        # rows of an id meet in the join already, so repeated ones go there and sets need not move
        sets = found.dropDuplicates(["doc"]).select("doc", shingles(F.col("_text"), join.words).alias("set"))
        sets = settled(sets, "jaccard-sets")
    drop_copies(wanted)
    rows = sets.select("doc", F.explode("set").alias("h"))
    parts = []
    for part in range(join.parts):  # no shuffle holds the members of all sets
        own = rows.where(F.pmod("h", F.lit(join.parts)) == part)
        shared = settled(own.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "jaccard-df")
        with_df = own.join(shared.select(F.col("h").alias("h2"), "df"), F.col("h") == F.col("h2"))
        parts.append(settled(with_df.select("doc", _ordered(F.col("h"), F.col("df")).alias("m")), "jaccard-members"))
        drop_copies(shared)
    listed = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list("m")).alias("shared"))  # one text's members
        .join(sets.select("doc", F.size("set").alias("n")), "doc")
    )
    # members no other set has come first in the order and use up the window
    length = F.floor(F.col("n") * (100 - join.percent) / 100) + 1 - (F.col("n") - F.size("shared"))
    windows = listed.where(length > 0).select("doc", F.explode(F.slice("shared", F.lit(1), length.cast("int"))).alias("m"))
    found = settled(windows.select(F.col("m").alias("h"), "doc"), "jaccard-regions")
    drop_copies(*parts)
    return found, sets


def _ordered(member: Column, df: Column) -> Column:
    """A member in one long that sorts by frequency, in half powers of two, and then by hash.

    It is the same for all sets. Members that agree in the 57 bits kept share a region, which costs
    a comparison and no link: two sets whose windows share a member also share what it maps to.
    """
    level = F.least(F.floor(2 * F.log2(df)), F.lit(63)).cast("long")
    return F.shiftleft(level, 57).bitwiseOR(member.bitwiseAND(F.lit((1 << 57) - 1)))


def _linked(docs, sets, label, side, join: Join) -> list[tuple[int, int]]:
    """Enough links to connect what is linked among the sets of one task.

    With `side` only pairs of different sides are compared. Sets stand in the order of their
    distance to a pivot, and each is compared with those behind it that are no further than the
    limit: members shared with all of them are counted at once from lists of who holds a member.
    """
    pivot = sets[0]
    shares = [similar(pivot, s) for s in sets]
    distance = np.array([1 - both / union for both, union in shares])
    by = np.argsort(distance, kind="stable")
    distance, docs, label = distance[by], docs[by], label[by]
    side = None if side is None else side[by]
    sizes = np.array([len(sets[i]) for i in by])
    members = np.concatenate([sets[i] for i in by])
    holder = np.repeat(np.arange(len(by)), sizes)
    order = np.argsort(members, kind="stable")
    members, holders = members[order], holder[order]
    starts = np.flatnonzero(np.diff(members, prepend=members[0] - 1))
    lengths = np.diff(np.append(starts, len(members)))
    # the list that each member of each set stands in
    list_of = np.empty(len(order), np.int64)
    list_of[order] = np.repeat(np.arange(len(starts)), lengths)
    at = np.concatenate([[0], np.cumsum(sizes)])
    reach = np.searchsorted(distance, distance + (1 - join.percent / 100 + 1e-9), side="right")
    found: list[tuple[int, int]] = []
    for i in range(len(by)):
        if reach[i] <= i + 1:
            continue
        lists = list_of[at[i] : at[i + 1]]
        lists = lists[lengths[lists] > 1]
        n = lengths[lists]
        places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - starts[lists], n)
        both = np.bincount(holders[places], minlength=len(by))[i + 1 : reach[i]]
        union = sizes[i] + sizes[i + 1 : reach[i]] - both
        linked = (100 * both >= join.percent * union) & (label[i + 1 : reach[i]] != label[i])
        if side is not None:
            linked &= side[i + 1 : reach[i]] != side[i]
        for j in np.flatnonzero(linked) + i + 1:
            if label[j] != label[i]:
                found.append((docs[i], docs[j]))
                label[label == label[j]] = label[i]
    return found


def _task_links(join: Join, sided: bool):
    """Links found in one task, which gets at most a leaf, or two of its blocks."""

    def links(group: pa.Table) -> pa.Table:
        let_go()
        docs = group.column("doc").to_numpy()
        order = np.argsort(docs)
        column = group.column("set").combine_chunks()
        sets = [column[int(i)].values.to_numpy(zero_copy_only=False) for i in order]
        label = group.column("component").to_numpy()[order].copy()
        side = group.column("block").to_numpy()[order] if sided else None
        found = _linked(docs[order], sets, label, side, join)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links


def _block_links(members: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links of groups too large for one task: every two blocks of a group meet in a task of their own."""
    half = max(1, join.leaf // 2)
    blocks = F.ceil(F.col("size") / half).cast("int")
    placed = members.withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int")).join(sets, "doc")
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "doc", "component", "set"
    )
    keys = ["group", "low", "high"]
    schema = "a long, b long"
    own = pairs.where("low = high").groupBy(*keys).applyInArrow(_task_links(join, False), schema)
    across = pairs.where("low < high").groupBy(*keys).applyInArrow(_task_links(join, True), schema)
    return own.unionByName(across)


def _overlap(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b))


def _pivot_round(rows: DataFrame, members: DataFrame, sets: DataFrame, join: Join, level: int) -> tuple[DataFrame, DataFrame]:
    """Links of the sets of large groups to pivots, and what is left of their regions.

    A pivot has met its whole group, so it leaves. Regions are cut by the cells of the pivots, for
    groups whose sets lie in two cells each at most on average.
    """
    order = W.partitionBy("group").orderBy("hash", "doc")
    chosen = (
        members.withColumn("hash", F.xxhash64(F.lit(level), "doc"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= join.pivots)
    )
    of = sets.select(F.col("doc").alias("pd"), F.col("set").alias("ps"))
    pivots = stage(
        chosen.join(of, F.col("doc") == F.col("pd")).select(F.col("group").alias("g"), F.col("doc").alias("pivot"), "ps"),
        "jaccard-pivots",
    )
    measured = members.join(sets, "doc").join(pivots, F.col("group") == F.col("g")).withColumn("both", _overlap("set", "ps"))
    union = F.size("set") + F.size("ps") - F.col("both")
    measured = stage(measured.select("doc", "group", "pivot", "both", union.alias("union")), "jaccard-distances")
    links = measured.where((F.col("doc") != F.col("pivot")) & (F.col("both") * 100 >= F.col("union") * join.percent)).select(
        F.col("doc").alias("a"), F.col("pivot").alias("b")
    )
    rows = rows.join(pivots.select("pivot"), F.col("doc") == F.col("pivot"), "left_anti")
    distance = 1 - F.col("both") / F.col("union")
    home = measured.groupBy(F.col("doc").alias("hd")).agg(F.min(distance).alias("home"))
    window = 2 * (1 - join.percent / 100) + 1e-9
    cells = stage(
        measured.join(home, F.col("doc") == F.col("hd")).where(distance <= F.col("home") + window).select("doc", "group", "pivot"),
        "jaccard-cells",
    )
    helped = cells.groupBy(F.col("group").alias("g2")).agg((F.count("*") / F.count_distinct("doc")).alias("cells")).where("cells <= 2")
    cells = cells.join(helped, F.col("group") == F.col("g2"), "left_semi").select(F.col("doc").alias("cd"), F.col("pivot").alias("cell"))
    cut = rows.join(cells, F.col("doc") == F.col("cd"), "left")
    return links, cut.select(F.when(F.col("cell").isNull(), F.col("h")).otherwise(F.xxhash64("h", "cell")).alias("h"), "doc")


def links(rows: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Enough links (a, b) to connect all that are linked, found region by region."""
    found = sets.sparkSession.createDataFrame([], "a long, b long")
    for level in range(join.levels + 1):
        known = rows.withColumn("component", F.col("doc"))
        if level:
            labels = components(found, "a", "b")
            known = rows.join(labels, F.col("doc") == F.col("node"), "left").select(
                "h", "doc", F.coalesce("component", "doc").alias("component")
            )
        # regions whose sets are all connected are done
        ends = known.groupBy(F.col("h").alias("h2")).agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min("doc").alias("first")
        )
        # a written copy, so that its size is known before rows of a hot region are dealt by it
        ends = stage(ends.where("low <> high").select("h2", "first"), "jaccard-ends")
        known = stage(
            known.join(ends, F.col("h") == F.col("h2")).select("h", "doc", "component", "first"), "jaccard-open"
        )
        if known.isEmpty():
            break
        groups = components(known.where("doc <> first").select("doc", "first").distinct(), "doc", "first")
        sizes = groups.groupBy(F.col("component").alias("g2")).agg(F.count("*").alias("size"))
        of = known.select("doc", F.col("component").alias("label")).distinct()
        members = stage(
            groups.select(F.col("node").alias("doc"), F.col("component").alias("group"))
            .join(sizes, F.col("group") == F.col("g2"))
            .join(of, "doc")
            .select("doc", "group", "size", F.col("label").alias("component")),
            "jaccard-groups",
        )
        small = members.where(F.col("size") <= join.leaf).join(sets, "doc").select("group", "doc", "component", "set")
        new = small.groupBy("group").applyInArrow(_task_links(join, False), "a long, b long")
        large = members.where(F.col("size") > join.leaf)
        if large.isEmpty():
            return stage(found.unionByName(new), "jaccard-links")
        if level == join.levels:
            return stage(found.unionByName(new).unionByName(_block_links(large, sets, join)), "jaccard-links")
        rows = known.select("h", "doc").join(large.select("doc"), "doc", "left_semi").select("h", "doc")
        pivot_links, rows = _pivot_round(rows, large, sets, join, level)
        rows = stage(rows, "jaccard-regions")
        found = stage(found.unionByName(new).unionByName(pivot_links), "jaccard-links")
    return found


def join_components(docs: DataFrame, join: Join | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, `n_shingles`, `component_id` and the class of equal sets it belongs to."""
    join = join or Join()
    members = stage(classes(docs, key, text, join), "jaccard-classes")
    rows, sets = regions(docs, members, key, text, join)
    found = links(rows, sets, join)
    drop_copies(rows, sets)  # the links are written
    labels = stage(components(found, "a", "b"), "jaccard-components")
    joined = members.join(labels, F.col("class") == F.col("node"), "left")
    return joined.select(
        F.col("doc").alias(key),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "class").alias("component_id"),
        F.col("class").alias("class_id"),
    )
