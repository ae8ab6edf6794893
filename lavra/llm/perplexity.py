"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of characters.

Counts of character n-grams of all trusted text, by language, are summed before and after one
shuffle. Continuation counts, discounts, context totals and the interpolated probabilities are
Spark aggregations and joins of count tables that are partitioned by n-gram, so the model may
grow with the text. For scoring it is cut into shards by the last two characters of the context;
all look-ups of a position fall into one shard. Shards have a checked size and are broadcast one
after the other, and each text's log probability is the sum of what it gets from every shard.

A text is rejected where its perplexity is above its language's limit: the `quantile` of trusted
texts that were kept out of training. The mean of a short text strays further, so on the log scale
distances from the median count as if each text had `prior` more characters at the median; the
limit of a text follows from its length. Where a language has too few trusted texts to keep some
out, those of the training set the limit, which then moves up by `slack` times their spread.

Characters, not words, are the units: their counts are dense enough that unseen words of a
trusted language stay likely, and their tables are far smaller than the text. White space counts
as single blanks. Null and blank text has no perplexity and is rejected; a language without
trusted text has no model and its texts are kept. A null language is a language of its own.
Repeated rows are judged alike, each on its own.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import filtered_joins, settled, share_code, short_batches, worker_keeps
from lavra.session import drop_copies, stage

_START = "\x02"  # stands before a text
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.uint64(pow(int(_BASE), i, 1 << 64)) for i in range(16)]
_CHARS = 400_000  # characters handled at a time
_BLANKS = re.compile(r"\s+")
# Steps of log perplexity in which limits are looked for.
_STEP = 0.002


@dataclass(frozen=True)
class Judge:
    """Parameters of model and limits."""

    order: int = 5
    quantile: float = 0.99
    prior: float = 50.0
    slack: float = 1.0
    held_out: int = 8  # one in so many trusted texts sets the limit instead of training
    min_held_out: int = 20  # with fewer, all trusted texts of the language set it
    shard_entries: int = 4_000_000


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Normal texts in groups of bounded length, with the row each group starts at."""
    start, size, group = 0, 0, []
    for i, value in enumerate(column):
        text = _BLANKS.sub(" ", value.as_py() or "").strip(" ")
        if group and size + len(text) > _CHARS:
            yield start, group
            start, size, group = i, 0, []
        group.append(text)
        size += len(text)
    if group:
        yield start, group


def _codes(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after `order - 1` start marks, and where texts' characters stand."""
    pad = _START * (order - 1)
    joined = "".join(pad + t for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + order - 1) - lengths
    places = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    return codes, places


def gram_counts(docs: DataFrame, language: str, text: str, order: int) -> DataFrame:
    """Occurrences of each n-gram of the highest order, by language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column(0).to_pylist()
            for start, texts in _slices(batch.column(1)):
                by: dict[str | None, list[str]] = {}
                for name, value in zip(languages[start : start + len(texts)], texts, strict=True):
                    by.setdefault(name, []).append(value)
                for name, own in by.items():
                    codes, places = _codes(own, order)
                    if len(places):
                        grams, n = _unique(codes, places, order)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(n, pa.int64())],
                            ["lang", "gram", "n"],
                        )

    share_code(docs.sparkSession)
    found = docs.select(F.col(language).cast("string").alias("lang"), F.col(text)).mapInArrow(
        count, "lang string, gram string, n long"
    )
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _unique(codes: np.ndarray, places: np.ndarray, order: int) -> tuple[list[str], np.ndarray]:
    """Distinct n-grams that end at the places, and how often."""
    alphabet, dense = np.unique(codes, return_inverse=True)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if bits * order <= 63:
        packed = np.zeros(len(places), np.int64)
        for back in range(order - 1, -1, -1):
            packed = (packed << bits) | dense[places - back]
        found, n = np.unique(packed, return_counts=True)
        columns = [(found >> (bits * back)) & ((1 << bits) - 1) for back in range(order - 1, -1, -1)]
        spelled = alphabet[np.column_stack(columns)]
    else:
        rows = np.column_stack([codes[places - back] for back in range(order - 1, -1, -1)])
        spelled, n = np.unique(rows, axis=0, return_counts=True)
    joined = np.ascontiguousarray(spelled).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [joined[i : i + order] for i in range(0, len(joined), order)], n


def _discounts(counts: DataFrame) -> DataFrame:
    """The three discounts of each language, from how many n-grams occur one to four times."""
    n = counts.groupBy("lang").agg(*[F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in range(1, 5)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        value = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        whole = (F.col("n1") > 0) & (F.col(f"n{k}") > 0) & (value > 0)
        return F.when(whole, F.least(value, F.lit(float(k)))).otherwise(F.lit(0.5))

    return n.select(F.col("lang").alias("dl"), *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])


def language_model(counts: DataFrame, order: int) -> DataFrame:
    """Rows (lang, size, gram, logp, back): the model in back-off form.

    `logp` is the interpolated log probability of the last character of a gram, `back` the log
    weight a context leaves to lower orders. The gram of size 0 holds what an unseen character gets.
    """
    kinds = {order: counts}
    for size in range(order - 1, 0, -1):
        longer = kinds[size + 1]
        kinds[size] = stage(
            longer.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n")), f"kn-{size}"
        )
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    parts = []
    lower = None
    for size in range(1, order + 1):
        grams = kinds[size].withColumn("context", F.expr(f"substring(gram, 1, {size - 1})"))
        cut = F.when(F.col("n") >= 3, F.col("d3")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d1"))
        cut_grams = grams.join(F.broadcast(_discounts(kinds[size])), same("lang", "dl")).withColumn("d", cut)
        contexts = cut_grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("left"))
        back = contexts.select(
            F.col("lang").alias("cl"), F.col("context").alias("c"), "total", (F.col("left") / F.col("total")).alias("gamma")
        )
        joined = cut_grams.join(back, same("lang", "cl") & (F.col("context") == F.col("c")))
        if size == 1:
            unseen = kinds[1].groupBy(F.col("lang").alias("ul")).agg((1.0 / (F.count("*") + 1)).alias("q"))
            joined = joined.join(F.broadcast(unseen), same("lang", "ul"))
            root = back.join(F.broadcast(unseen), same("cl", "ul")).select(
                F.col("cl").alias("lang"), F.lit(0).alias("size"), F.lit("").alias("gram"),
                F.log(F.col("gamma") * F.col("q")).alias("logp"), F.lit(None).cast("double").alias("back"),
            )
            parts.append(root)
        else:
            joined = joined.join(lower, same("lang", "ll") & (F.expr("substring(gram, 2)") == F.col("lg")))
        p = stage(
            joined.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("q")).alias("p")),
            f"kn-p{size}",
        )
        parts.append(p.select("lang", F.lit(size).alias("size"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("back")))
        if size > 1:
            parts.append(
                back.select(
                    F.col("cl").alias("lang"), F.lit(size - 1).alias("size"), F.col("c").alias("gram"),
                    F.lit(None).cast("double").alias("logp"), F.log("gamma").alias("back"),
                )
            )
        lower = p.select(F.col("lang").alias("ll"), F.col("gram").alias("lg"), F.col("p").alias("q"))
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    return model


def _seed(language: str | None) -> np.uint64:
    value = 14695981039346656037
    for byte in ("\x00" if language is None else language).encode():
        value = ((value ^ byte) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(value)


def _mix(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def _kind(size: int, context: bool) -> np.uint64:
    return np.uint64((2 * size + context + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)


def _sums(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each size the hash of the gram that ends at each place; the last character has the lowest power."""
    out = [np.zeros(len(codes), np.uint64)]
    for back in range(order):
        moved = np.zeros(len(codes), np.uint64)
        moved[back:] = codes[: len(codes) - back] if back else codes
        out.append(out[-1] + (moved + np.uint64(1)) * _POWERS[back])
    return out


def _entries(model: DataFrame) -> DataFrame:
    """Every value of the model under its 64-bit key, with the context's end that decides its shard."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = {name: _seed(name) for name in set(batch.column(0).to_pylist())}
            seed = np.array([seeds[name] for name in batch.column(0).to_pylist()], np.uint64)
            size = batch.column(1).to_numpy()
            grams = batch.column(2).to_pylist()
            logp, back = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.float32) for i in (3, 4))
            key = np.zeros(len(seed), np.uint64)
            pair = np.full(len(seed), -1, np.int64)
            for s in map(int, np.unique(size)):
                at = np.flatnonzero(size == s)
                if s:
                    codes = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", "surrogatepass"), np.uint32)
                    codes = codes.reshape(len(at), s).astype(np.uint64)
                    for back_by in range(s):
                        key[at] += (codes[:, s - 1 - back_by] + np.uint64(1)) * _POWERS[back_by]
                    # the last two characters of the context: before the predicted one, or of a context itself
                    for rows, end in ((np.isnan(back[at]), s - 1), (~np.isnan(back[at]), s)):
                        if end >= 2:
                            pair[at[rows]] = _pair(codes[rows, end - 2], codes[rows, end - 1])
                context = ~np.isnan(back[at])
                key[at] = _mix(key[at] + np.where(context, _kind(s, True), _kind(s, False)) + seed[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(np.where(np.isnan(back), logp, back)), pa.array(pair)],
                ["key", "value", "pair"],
            )

    return model.select("lang", "size", "gram", "logp", "back").mapInArrow(keyed, "key long, value float, pair long")


def _pair(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    mixed = _mix((before + np.uint64(1)) * _BASE + last + np.uint64(7))
    return (mixed >> np.uint64(40)).astype(np.int64)


class Table:
    """Look-up of 64-bit keys in an open-addressed array."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(len(keys) * 2).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, np.uint64)
        self.values = np.full(size, np.nan, np.float32)
        waiting = np.arange(len(keys))
        slot = keys & self.mask
        while len(waiting):
            free = self.keys[slot] == 0
            # the last of several takes the slot; the others see it taken and move on
            self.keys[slot[free]] = keys[waiting[free]]
            placed = self.keys[slot] == keys[waiting]
            self.values[slot[placed]] = values[waiting[placed]]
            waiting, slot = waiting[~placed], (slot[~placed] + np.uint64(1)) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN where a key is missing."""
        out = np.full(len(keys), np.nan, np.float32)
        slot, open_ = keys & self.mask, np.arange(len(keys))
        while len(open_):
            held = self.keys[slot]
            same = held == keys[open_]
            out[open_[same]] = self.values[slot[same]]
            on = ~same & (held != 0)
            open_, slot = open_[on], (slot[on] + np.uint64(1)) & self.mask
        return out


def _table(name: str, shared) -> Table:
    """The table of one shard, made once per worker; reached by name, since what a closure holds is copied for every task."""
    return worker_keeps(name, lambda: Table(*shared.value))


def _score_texts(texts, languages, table: Table, order: int, shard: int, shards: int) -> np.ndarray:
    """Sum of the log probabilities of those characters of each text whose context is in this shard."""
    codes, places = _codes(texts, order)
    total = np.zeros(len(texts))
    if not len(places):
        return total
    lengths = np.array([len(t) for t in texts])
    row = np.repeat(np.arange(len(texts)), lengths)
    if shards > 1:
        wide = codes.astype(np.uint64)
        own = _pair(wide[places - 2], wide[places - 1]) % shards == shard
        places, row = places[own], row[own]
    sums = _sums(codes.astype(np.uint64), order)
    seeds = np.array([_seed(name) for name in languages], np.uint64)
    out = np.zeros(len(places))
    open_ = np.arange(len(places))
    for size in range(order, -1, -1):
        at, seed = places[open_], seeds[row[open_]]
        value = table.find(_mix(sums[size][at] + _kind(size, False) + seed))
        hit = ~np.isnan(value)
        out[open_[hit]] += value[hit]
        open_ = open_[~hit]
        if size > 1:
            at, seed = places[open_], seeds[row[open_]]
            back = table.find(_mix(sums[size - 1][at - 1] + _kind(size - 1, True) + seed))
            out[open_] += np.where(np.isnan(back), 0, back)
    # what even the root does not know belongs to a language without a model
    out[open_] = np.nan
    return np.bincount(row, out, len(texts))


def log_perplexity(docs: DataFrame, model: DataFrame, judge: Judge, language: str, text: str) -> DataFrame:
    """`docs` with `_logp`, the log probability per character with its sign turned, and the number `_chars` of these.

    `_logp` is null without a model.
    """
    spark = docs.sparkSession
    share_code(spark)
    entries = stage(_entries(model), "kn-entries")
    count = entries.count()
    shards = 1
    while count > shards * judge.shard_entries or _largest_shard(entries, shards) > judge.shard_entries:
        shards *= 2
        if shards > 4096:
            raise ValueError("one end of a context has more n-grams than a shard may hold")
    scored = docs
    for shard in range(shards):
        own = entries.where((F.col("pair") == -1) | (F.col("pair") % shards == shard)).select("key", "value").toArrow()
        keys = own.column("key").to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast((keys, own.column("value").to_numpy()))  # a shard: size checked above
        part = _score_column(shared, judge.order, shard, shards)(F.col(language).cast("string"), F.col(text))
        scored = scored.withColumn("_logp", part if not shard else F.col("_logp") + part)
    drop_copies(entries)  # every shard is sent
    length = F.length(F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?U)\s+", " ")))
    scored = scored.withColumn("_chars", length)
    mean = -F.col("_logp") / F.when(F.col("_chars") > 0, F.col("_chars"))
    return scored.withColumn("_logp", F.when(~F.isnan("_logp"), mean))


def _largest_shard(entries: DataFrame, shards: int) -> int:
    sizes = entries.groupBy(F.when(F.col("pair") >= 0, F.col("pair") % shards).alias("s")).agg(F.count("*").alias("n"))
    rows = sizes.agg(F.sum(F.when(F.col("s").isNull(), F.col("n"))).alias("all"), F.max(F.when(F.col("s").isNotNull(), F.col("n"))).alias("most")).first()
    return (rows["all"] or 0) + (rows["most"] or 0)


def _score_column(shared, order: int, shard: int, shards: int):
    name = uuid.uuid4().hex  # under which a worker keeps the table

    @F.arrow_udf("double")
    def scores(languages: pa.Array, texts: pa.Array) -> pa.Array:
        names, parts, table = languages.to_pylist(), [], _table(name, shared)
        for start, group in _slices(texts):
            parts.append(_score_texts(group, names[start : start + len(group)], table, order, shard, shards))
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64(), from_pandas=False)

    return scores


def _quantile(rows: DataFrame, value: Column, quantile: float, judge: Judge, language: str) -> DataFrame:
    """Rows (_l, edge, few): a quantile of held-out texts per language, of all trusted ones where those are few."""
    bins = rows.groupBy(F.col(language).alias("_l"), F.floor(value / _STEP).cast("long").alias("bin")).agg(
        F.count_if("_held").alias("held"), F.count("*").alias("all")
    )
    per = W.partitionBy("_l")
    run = bins.withColumn("few", F.sum("held").over(per) < judge.min_held_out)
    run = run.withColumn("n", F.when(F.col("few"), F.col("all")).otherwise(F.col("held")))
    run = run.withColumn("upto", F.sum("n").over(per.orderBy("bin"))).withColumn("of", F.sum("n").over(per))
    edge = F.min(F.when(F.col("upto") >= quantile * F.col("of"), (F.col("bin") + 1) * _STEP))
    return run.groupBy("_l").agg(edge.alias("edge"), F.first("few").alias("few"))


def limits(scored: DataFrame, judge: Judge, language: str) -> DataFrame:
    """Rows (_l, _middle, _reach): median log perplexity, and how far above it a text of endless length may lie.

    From rows with `_logp`, `_chars`, `_trusted`, `_held`.
    """
    rows = scored.where("_trusted and _logp is not null")
    middle = stage(_quantile(rows, F.col("_logp"), 0.5, judge, language).select(F.col("_l").alias("_m"), F.col("edge").alias("_middle")), "kn-middle")
    near = rows.join(F.broadcast(middle), F.col(language).eqNullSafe(F.col("_m")))  # a row per language
    away = (F.col("_logp") - F.col("_middle")) * F.col("_chars") / (F.col("_chars") + judge.prior)
    found = _quantile(near, away, judge.quantile, judge, language)
    reach = F.col("edge") * F.when(F.col("few"), 1 + judge.slack).otherwise(1.0)
    return found.join(F.broadcast(middle), F.col("_l").eqNullSafe(F.col("_m"))).select("_l", "_middle", reach.alias("_reach"))


def classify(
    docs: DataFrame,
    trusted: DataFrame,
    judge: Judge | None = None,
    key: str = "doc_id",
    language: str = "lang",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row's columns `keep` (all where not given) in the struct `_row`, with `_perplexity`, `_limit` and `_kept`.

    `_limit` is that of the row's language and length, null without characters. `trusted` holds the ids of trusted texts in its column `key`.
    """
    short_batches(docs.sparkSession)
    judge, kept_columns = judge or Judge(), keep or docs.columns
    # the text travels once: within the row where that keeps it
    own = [] if text in kept_columns else [F.col(text).alias("_text")]
    rows = docs.select(
        F.struct(*kept_columns).alias("_row"), F.col(key).alias("_key"), F.col(language).cast("string").alias("_lang"), *own
    )
    text = "_text" if own else f"_row.`{text}`"
    ids = trusted.select(F.col(key).alias("_id")).where("_id is not null")
    held = F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(judge.held_out)) == 0
    trusted_rows = rows.select("_key", "_lang", F.col(text).alias("_text")).join(
        ids.hint("merge"), F.col("_key") == F.col("_id"), "left_semi"
    )
    with filtered_joins(docs.sparkSession):
        counts = settled(gram_counts(trusted_rows.where(~held), "_lang", "_text", judge.order), "kn-grams")
    model = stage(language_model(counts, judge.order), "kn-model")
    drop_copies(counts)
    # the limits ask for the scores of trusted texts alone; no copy of all texts is kept
    with filtered_joins(docs.sparkSession):
        known = log_perplexity(trusted_rows, model, judge, "_lang", "_text").select("_key", "_lang", "_logp", "_chars")
        marked = stage(known.withColumns({"_trusted": F.lit(True), "_held": held}), "kn-trusted")
    found = stage(limits(marked, judge, "_lang"), "kn-limits")
    scored = log_perplexity(rows, model, judge, "_lang", text)
    drop_copies(marked, model)
    judged = scored.join(F.broadcast(found), F.col("_lang").eqNullSafe(F.col("_l")), "left")  # a row per language
    limit = F.col("_middle") + F.col("_reach") * (1 + judge.prior / F.when(F.col("_chars") > 0, F.col("_chars")))
    # no reach: a language without trusted text; no value with a reach: a text without characters
    kept = F.when(F.col("_reach").isNull(), F.lit(True)).otherwise(F.coalesce(F.col("_logp") <= limit, F.lit(False)))
    return judged.select("_row", F.exp("_logp").alias("_perplexity"), F.exp(limit).alias("_limit"), kept.alias("_kept"))
