"""Quality rules on lines: lines that fail go, texts that lose too much of themselves go.

Only built-in column functions; every text is handled within its own row, so there is no
shuffle and nothing depends on how rows are grouped.

Null or blank text has no words and fails the base rule. Repeated rows get the same result
each. Columns of the input other than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import WHITE, let, words

# The symbols that the base statistics count.
SYMBOLS = "#*$%&|<>"
# Characters of the line rules, as a class of regular expressions: marks of markup and emphasis, bars of menus.
MARKS = r"#*$%&|<>!?{}\[\]\\^~=_"
BARS = "|»›"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of what a text may lose."""

    min_words: int = 50
    max_repeat_pct: int = 50
    # punctuation: symbols and marks of emphasis per 100 characters of a line
    max_mark_pct: int = 12
    # navigation: a line with this many bars between its parts
    min_nav_bars: int = 3
    # boilerplate: phrases that no running text has
    boilerplate: tuple[str, ...] = (
        "accept all cookies",
        "all rights reserved",
        "click here to",
        "enable javascript",
        "lorem ipsum",
        "privacy policy",
        "sign up for our newsletter",
        "terms of use",
    )
    # a text that keeps less than this share of its word characters is rejected
    min_kept_pct: int = 50


def repeated_words(found: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    Windows are compared by 64-bit hash. Sorted, equal ones stand together; their places are
    looked for only in texts that have any.
    """

    def of(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)),
        )
        return let(hashes, any_twice)

    def any_twice(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(places(h))

    def places(h: Column) -> Column:
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)

    def covered(s: Column) -> Column:
        twice = F.filter(
            s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
        )
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), width)

    def width(at: Column) -> Column:
        # each place covers three words, or as many as stand before the next place
        steps = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return F.when(F.size(found) < 3, F.lit(0)).otherwise(let(found, of))


def without(text: Column, characters: str) -> Column:
    return F.regexp_replace(text, f"[{characters}]+", "")


def line_passes(line: Column, rules: LineRules) -> Column:
    """Whether a line passes the punctuation, navigation and boilerplate rules."""
    marks = F.length(line) - F.length(without(line, MARKS))
    bars = F.length(line) - F.length(without(line, BARS))
    boilerplate = let(F.lower(line), lambda x: reduce(or_, [F.contains(x, F.lit(p)) for p in rules.boilerplate]))
    return (marks * 100 <= F.length(line) * rules.max_mark_pct) & (bars < rules.min_nav_bars) & ~boilerplate


def clean_lines(docs: DataFrame, rules: LineRules | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: the base statistics, the cleaned text, and whether it is kept."""
    rules = rules or LineRules()
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        F.col(key),
        "text",
        words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{WHITE}]")).alias("lines"),
    )
    stats = rows.select(
        F.col(key),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.array_join("lines", "")).cast("long").alias("line_chars"),
        F.filter("lines", lambda x: line_passes(x, rules)).alias("passed"),
    )
    left = stats.withColumns(
        {
            "clean_text": F.array_join("passed", "\n"),
            "kept_chars": F.length(F.array_join("passed", "")).cast("long"),
            "n_lines_removed": (F.col("n_lines") - F.size("passed")).cast("long"),
            "base_failed": (F.col("n_words") < rules.min_words)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_pct),
        }
    )
    return left.select(
        F.col(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("kept_chars") * 100 >= F.col("line_chars") * rules.min_kept_pct)).alias("kept"),
        "n_lines",
        "n_lines_removed",
        "line_chars",
        "kept_chars",
        "clean_text",
    )
