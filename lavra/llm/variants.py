"""Spelling variants: words one inserted, deleted or replaced character apart, by pivotal grams.

The bigrams of all words are counted, which gives them one order from rare to frequent (an alphabet
of a characters has at most a * a of them, so their counts may be broadcast, and that bound is
checked). The three rarest bigrams of a word are its prefix, and two disjoint ones of these, chosen
by dynamic programming as the rarest such pair, are its pivots. One edit spoils at most one of two
disjoint bigrams, so of two near words the pivots of the one whose prefix ends earlier in the order
and the prefix of the other share a bigram. Words are therefore found by joining pivots with prefixes.

Position limits. A shared bigram has the edit on one of its sides. The other side is equal, and so
is half of the edited side if that is cut in two. The join key holds where the bigram stands, the
length, and all characters outside the side or half that holds the edit, so the words that meet
already agree in half of their characters; what has to be compared grows with the words that look
alike and not with the square of all words. What meets is verified by edit distance.

Repeated bigrams: of each bigram up to the third rarest, a word's prefix holds the first five
places. A pivot is at most the third place of its bigram, and one edit makes at most two more.

A form is the near word that occurs most often (ties: smallest in code-point order), if it occurs
at least ten times as often. Forms grow tenfold at each step, so a chain has at most as many steps as
the largest count has digits; they are followed by one join each.

Null and empty texts have no words. Repeated rows count each. A null id is spelt as an empty one.
Words of any length are taken whole. Only the key and the text of the table are read, so other
columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.batches import slices
from lavra.llm.common import share_code
from lavra.session import stage

# The characters of a word, lower-cased, and their number.
LETTERS = "a-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = 26 + 64
# Grams in a prefix and pivots among them, for one edit; places of one gram that a prefix holds.
IN_PREFIX, PIVOTS, PLACES = 3, 2, 5


@dataclass(frozen=True)
class Spelling:
    """Words counted: their least length and number of occurrences, and how much more often a form occurs."""

    min_chars: int = 7
    min_count: int = 2
    times: int = 10


def runs(docs: DataFrame, least: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every maximal run of letters of at least `least` characters, lower-cased: (key, run), one row per occurrence."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{least},}}"), 0)
    return docs.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("run"))


def mistyped(found: DataFrame, every: int = 31) -> DataFrame:
    """The runs as words, where one in `every` by the hash of key and run has lost a character: (word)."""
    h = F.crc32(F.concat(F.coalesce("key", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return found.select(F.when(h % every == 0, short).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, spelling: Spelling) -> DataFrame:
    """Each word that is long and frequent enough, with its occurrences: (word, n)."""
    long_enough = words.where(F.length("word") >= spelling.min_chars)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= spelling.min_count)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """The bigrams of the words from rare to frequent; ties in code-point order."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    rows = grams.groupBy("gram").agg(F.count("*").alias("n")).limit(ALPHABET**2 + 1).collect()
    if len(rows) > ALPHABET**2:
        raise ValueError(f"over {ALPHABET**2} bigrams: the words hold other characters than {LETTERS}")
    return {row["gram"]: rank for rank, row in enumerate(sorted(rows, key=lambda r: (r["n"], r["gram"])))}


def rarest_disjoint(places: list[tuple[int, int]], count: int) -> list[int]:
    """Of (position, weight) of bigrams, the positions of `count` disjoint ones of least total weight.

    Places are taken in order of position: the best choice of c among the first j either leaves
    out the j-th or takes it beside the best c - 1 of those that end before it.
    """
    places = sorted(places)
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * count]
    for j, (position, weight) in enumerate(places):
        before = sum(p + 2 <= position for p, _ in places[:j])
        row = list(best[j])
        for c in range(1, count + 1):
            rest = best[before][c - 1]
            if rest is not None and (row[c] is None or rest[0] + weight < row[c][0]):
                row[c] = (rest[0] + weight, [*rest[1], position])
        best.append(row)
    return best[-1][count][1]


@lru_cache(100_000)
def zones(position: int, length: int) -> list[tuple[int, int, bool]]:
    """Where an edit may lie in a word with a bigram unspoilt: (start, end, whether left of it)."""
    out = []
    for lo, hi, left in ((0, position, True), (position + 2, length, False)):
        cuts = [lo, (lo + hi) // 2, hi] if hi - lo > length // 2 else [lo, hi]
        out += [(a, b, left) for a, b in zip(cuts, cuts[1:])]
    return out


def _key(position: int, length: int, zone: int, rest: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{position},{length},{zone},{rest}")


def prefix_of(word: str, ranks: dict[str, int]) -> tuple[list[tuple[int, int]], list[int], int]:
    """The three rarest grams as (position, rank), the positions of all in the prefix, and the rank it ends with."""
    order = sorted((ranks[word[i : i + 2]], i) for i in range(len(word) - 1))
    last = order[IN_PREFIX - 1][0]
    positions, seen = [], {}
    for rank, i in order:
        if rank > last:
            break
        seen[rank] = seen.get(rank, 0) + 1
        if seen[rank] <= PLACES:
            positions.append(i)
    return [(i, rank) for rank, i in order[:IN_PREFIX]], positions, last


def prefix_keys(word: str, ranks: dict[str, int]) -> tuple[set[int], int]:
    """Keys under which other words' pivots find a word."""
    _, positions, last = prefix_of(word, ranks)
    n = len(word)
    return {
        _key(p, n, z, f"{word[:lo]} {word[hi:]}")
        for p in positions
        for z, (lo, hi, _) in enumerate(zones(p, n))
    }, last


def pivot_keys(word: str, ranks: dict[str, int]) -> tuple[set[int], int]:
    """Keys of the words that may be near, seen from a word's pivots.

    For each difference in length: a zone of the other word holds the edit, so cutting this word
    there, shorter or longer by the difference, leaves what the other one has outside the zone.
    """
    rarest, _, last = prefix_of(word, ranks)
    keys = set()
    for p in rarest_disjoint(rarest, PIVOTS):
        for more in (-1, 0, 1):
            n = len(word) + more
            for shift, side in ((more, True), (0, False)):
                if p + shift < 0 or p + shift + 2 > n:
                    continue
                for z, (lo, hi, left) in enumerate(zones(p + shift, n)):
                    if left is side and (hi > lo or more < 0) and hi - more >= lo:
                        keys.add(_key(p + shift, n, z, f"{word[:lo]} {word[hi - more:]}"))
    return keys, last


def _keyed(words: DataFrame, ranks, pivots: bool) -> DataFrame:
    """(key, word, last) of the words, seen from their pivots or from their prefixes."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = pivot_keys if pivots else prefix_keys
        for part in (batch.column(0).slice(*cut) for batch in batches for cut in slices(batch.column(0), 100_000)):
            keys, rows, lasts = [], [], []
            for row, word in enumerate(part.to_pylist()):
                found, last = keys_of(word, ranks.value)
                keys.extend(found)
                rows.extend([row] * len(found))
                lasts.extend([last] * len(found))
            columns = [
                pa.array(np.array(keys, np.uint64).view(np.int64)),
                part.take(pa.array(rows, pa.int64())),
                pa.array(lasts, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "word", "last"])

    return words.select("word").mapInArrow(of, "key long, word string, last int")


def near_pairs(words: DataFrame) -> DataFrame:
    """Every two of the distinct words (three characters or more) that are one edit apart, once: (a, b), a < b."""
    share_code(words.sparkSession)
    ranks = words.sparkSession.sparkContext.broadcast(gram_ranks(words))
    pivots = _keyed(words, ranks, True).select("key", F.col("word").alias("p"), F.col("last").alias("p_last"))
    prefixes = _keyed(words, ranks, False).select("key", F.col("word").alias("q"), F.col("last").alias("q_last"))
    met = pivots.join(prefixes, "key").where("p_last <= q_last and p <> q")
    near = met.where(F.levenshtein("p", "q", 1) == 1)
    return near.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def spelling_forms(words: DataFrame, spelling: Spelling | None = None) -> DataFrame:
    """Of counted words (word, n): form, root, n, n_near and form_n of each."""
    spelling = spelling or Spelling()
    pairs = stage(near_pairs(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of = words.select(F.col("word").alias("b"), (-F.col("n")).alias("less"))
    best = F.min(F.struct("less", "b")).alias("best")
    around = both.join(of, "b").groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    formed = F.col("n_near").isNotNull() & (-F.col("best.less") >= spelling.times * F.col("n"))
    known = stage(
        words.join(around, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best.b")).alias("form"),
            F.when(formed, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    return known.join(_roots(known), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(known: DataFrame) -> DataFrame:
    """The last form of every word that has one: (word, root)."""
    links = known.where("form is not null").select(F.col("word").alias("from"), F.col("form").alias("to"))
    at = known.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = at.join(links, F.col("root") == F.col("from"), "left")
        at = stage(step.select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("on")), "roots")
        if at.where("on").isEmpty():
            return at.drop("on")
        at = at.drop("on")


def spelling_variants(docs: DataFrame, spelling: Spelling | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The spelling forms of a table's words as they stand."""
    spelling = spelling or Spelling()
    found = runs(docs, spelling.min_chars, key, text).select(F.col("run").alias("word"))
    return spelling_forms(stage(counted(found, spelling), "words"), spelling)
