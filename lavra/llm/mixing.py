"""Temperature mixing: sources weighted by their token shares to a power, then dealt into blocks.

The weight of a source is `tokens ** a`, normalised. The exponent `a` is found by bisection in
[0, 1]: the largest that reaches a target entropy, or the flattest that keeps every source within
a limit of repetitions; with both targets the limit binds. Without targets it is 1. Without a budget the source with the fewest repetitions is used exactly once and so
no text is lost; with one, sources may also be used in part.

Realisation: in each epoch the texts of a source stand in the order of a hash of seed, epoch and
id. Whole epochs use all of them, the last one those whose running token sum stays within what
is left of the source's budget. A text's place in its source's run, as a fraction, is its place
in the whole mixture, which is cut into blocks of `block_tokens`.

Only DataFrame functions. Sources can be as skewed as they like: tokens are summed before the
shuffle, and the order within a source is only looked at inside one slice of the hash range.
Null text has no tokens; a null source is a source of its own; a source without tokens is used
once. Rows that share an id share their fate. An empty table gives an empty mixture.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import WHITE
from lavra.session import stage

# A pass over the shares tries so many exponents at once, as many as six bisections would.
POINTS = 64
PASSES = 4


@dataclass(frozen=True)
class Mixture:
    """Targets of a mixture; entropy as a share of that of equal weights."""

    entropy_share: float | None = 0.95
    max_repeats: float | None = 2.0
    budget: int | None = None
    block_tokens: int = 100_000
    seed: int = 17


def count_tokens(text: Column) -> Column:
    """Words of a text, by white space."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("long")


def token_shares(docs: DataFrame, source: str, tokens: str) -> DataFrame:
    """Tokens and rows per source."""
    return docs.groupBy(source).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("rows"))


def exponent(shares: DataFrame, target: Mixture) -> float:
    """The largest exponent in [0, 1], in steps of 2**-24, that meets the targets.

    Repetitions fall and entropy falls as the exponent grows, so each is a bisection of its own:
    the limit of repetitions asks for an exponent not below one value, the entropy for one not
    above another. Where they conflict the limit of repetitions wins.
    """
    used = shares.where("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    top = used.agg(F.max("t").alias("top"), F.min("t").alias("low"), F.count("*").alias("n")).first()
    if not top["n"] or top["n"] == 1:
        return 1.0
    x = F.log(F.col("t") / F.lit(top["top"]))
    at = 1.0
    if target.entropy_share is not None:
        goal = target.entropy_share * math.log(top["n"])
        logs = stage(used.select(F.log(F.col("t") / F.lit(top["top"])).alias("x")), "mix-logs")

        def met(points: list[float]) -> list[bool]:
            at = F.element_at(F.array(*[F.lit(p) for p in points]), F.col("i"))
            power = F.exp(F.col("x") * F.col("a"))
            found = (
                logs.select("x", F.explode(F.sequence(F.lit(1), F.lit(len(points)))).alias("i"))
                .withColumn("a", at)
                .groupBy("i", "a")
                .agg(F.sum(power).alias("z"), F.sum(power * F.col("x")).alias("y"))
                .select("i", (F.log("z") - F.col("a") * F.col("y") / F.col("z")).alias("h"))
            )
            entropy = {r["i"]: r["h"] for r in found.collect()}  # one row per point
            return [entropy[i + 1] >= goal for i in range(len(points))]

        at = _largest(met)
    if target.max_repeats is not None:
        spread = top["top"] / top["low"]
        need = _largest(lambda points: [spread ** (1 - a) >= target.max_repeats for a in points])
        if target.entropy_share is None or spread ** (1 - at) > target.max_repeats:
            at = need
    return at


def _largest(met) -> float:
    """Largest grid point up to which `met` holds; 0 where it never does."""
    low, width = 0.0, 1.0
    for _ in range(PASSES):
        width /= POINTS
        points = [low + width * i for i in range(1, POINTS + 1)]
        low = max([low, *[p for p, ok in zip(points, met(points), strict=True) if ok]])
    return min(low, 1.0)


def _order(seed: int, epoch: Column, key: str) -> Column:
    """The place of a text in the permutation of an epoch: 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def weights(shares: DataFrame, target: Mixture, source: str) -> DataFrame:
    """Per source: tokens, rows, weight, and the epochs it is used for."""
    a = exponent(shares, target)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a))).otherwise(F.lit(0.0))
    sums = shares.select(power.alias("p"), F.when(F.col("tokens") > 0, F.col("tokens") / power).alias("r")).agg(
        F.sum("p").alias("z"), F.max("r").alias("m")
    )
    # without a budget the source that is repeated least is used exactly once
    scale = F.col("m") if target.budget is None else F.lit(float(target.budget)) / F.col("z")
    return (
        shares.join(F.broadcast(sums), how="cross")  # sums is one row
        .withColumn("weight", F.when(F.col("tokens") > 0, power / F.col("z")).otherwise(0.0))
        .withColumn(
            "epochs",
            F.when(F.col("tokens") > 0, F.round(power * scale / F.col("tokens"), 9)).otherwise(F.lit(1.0)),
        )
        .select(
            F.col(source),
            "tokens",
            "rows",
            F.lit(a).alias("exponent"),
            "weight",
            "epochs",
            F.floor("epochs").cast("int").alias("whole"),
            F.floor((F.col("epochs") - F.floor("epochs")) * F.col("tokens") + F.lit(1e-6)).cast("long").alias("quota"),
        )
    )


def _cutoffs(docs: DataFrame, plan: DataFrame, source: str, key: str, seed: int, rows: int) -> DataFrame:
    """Per source the last hash that still fits into the part of an epoch it gets."""
    digits = 1
    while 16**digits * 50_000 < rows:
        digits += 1
    part = (
        docs.join(plan.where("quota > 0").select(F.col(source).alias("_s"), "whole", "quota"),
                  F.col(source).eqNullSafe(F.col("_s")))
        .withColumn("at", _order(seed, F.col("whole"), key))
        .withColumn("slice", F.substring("at", 1, digits))
    )
    slices = part.groupBy(source, "quota", "slice").agg(F.sum("_tok").alias("tok"))
    before = F.sum("tok").over(W.partitionBy(source).orderBy("slice")) - F.col("tok")
    # the slice in which the quota ends: the last one that starts within it
    ends = (
        slices.withColumn("before", before)
        .where("before <= quota")
        .groupBy(F.col(source).alias("_e"))
        .agg(F.max_by(F.struct("slice", "before", "quota"), "slice").alias("e"))
        .select("_e", F.col("e.slice").alias("end"), F.col("e.before").alias("before"), F.col("e.quota").alias("quota"))
    )
    inside = (
        part.drop("quota")
        .join(ends, F.col(source).eqNullSafe(F.col("_e")) & (F.col("slice") == F.col("end")))
        .groupBy(source, "quota", "end", "before", "at")
        .agg(F.sum("_tok").alias("tok"))
    )
    sums = F.col("before") + F.sum("tok").over(W.partitionBy(source).orderBy("at"))
    fits = inside.withColumn("sum", sums).where("sum <= quota").groupBy(source).agg(F.max("at").alias("last"))
    return (
        ends.join(fits.withColumnRenamed(source, "_f"), F.col("_e").eqNullSafe(F.col("_f")), "left")
        .select(F.col("_e").alias(source), F.coalesce("last", "end").alias("cutoff"))
    )


def mixture_plan(
    docs: DataFrame, target: Mixture, source: str = "source", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per source: weight, epochs, and where its last epoch ends."""
    narrow = stage(docs.select(F.col(source), F.col(key), count_tokens(F.col(text)).alias("_tok")), "mix-tokens")
    shares = stage(token_shares(narrow, source, "_tok"), "mix-shares")
    plan = weights(shares, target, source)
    rows = shares.agg(F.max("rows")).first()[0] or 0
    cutoffs = _cutoffs(narrow, plan, source, key, target.seed, rows).withColumnRenamed(source, "_c")
    joined = plan.join(cutoffs, F.col(source).eqNullSafe(F.col("_c")), "left").drop("_c")
    return stage(joined, "mix-plan")


def mix(
    docs: DataFrame, target: Mixture | None = None, source: str = "source", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The mixture: each row, in the struct `_row`, as often as it is used, with `_epoch` and `_block`."""
    target = target or Mixture()
    plan = mixture_plan(docs, target, source, key, text)
    total = plan.agg(F.sum(F.col("epochs") * F.col("tokens"))).first()[0] or 0.0
    blocks = max(1, int(-(-total // target.block_tokens)))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(source).alias("_from"), F.col(key).alias("_key"))
    used = rows.join(
        plan.select(F.col(source).alias("_source"), "whole", "epochs", "cutoff"), F.col("_from").eqNullSafe(F.col("_source"))
    )
    last = F.col("cutoff").isNotNull() & (_order(target.seed, F.col("whole"), "_key") <= F.col("cutoff"))
    copies = F.col("whole") + F.when(last, 1).otherwise(0)
    dealt = used.withColumn("_copies", copies).where("_copies > 0").withColumn(
        "_epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    )
    place = F.conv(F.substring(_order(target.seed, F.col("_epoch"), "_key"), 1, 8), 16, 10).cast("double") / 2.0**32
    block = F.floor((F.col("_epoch") + place) / F.greatest("epochs", F.col("_copies")) * blocks)
    return dealt.withColumn("_block", F.least(block, F.lit(blocks - 1)).cast("int")).select("_row", "_epoch", "_block")
