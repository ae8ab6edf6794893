"""License scans: identifier tags, notice phrases and license expressions.

Two Aho-Corasick automata go over each text once. The first one runs over the text's words, set
apart by single blanks, and reports every place where the words of a phrase stand one after the
other, overlapping places included. The second one runs over the lower-cased text itself and finds
tags after which an identifier or an expression stands (`SPDX-License-Identifier: MIT OR (ISC AND
Zlib)`). What follows a tag, up to the end of its line, is read as an expression: a shunting-yard
parser puts it in postfix order (`with` binds closest, then `and`, then `or`) and the postfix form
is evaluated with a stack.

An expression's value is how much a license asks of its users, a number from 0 (permissive) over
weak and strong copyleft to 1 (no free use): `and` takes the larger of its sides, `or` the smaller,
and `with` an exception lowers strong copyleft to weak. An unknown identifier counts as 1.

Results per text: `labels` are the phrases' and identifiers' labels, `base_labels` those of the
base phrases. Of places that the method's own phrases share, only the longest phrase gives its
label; base phrases all do. `score` says how sure the scan is that the text states a license: 1 for
a tag whose expression is known throughout, 0.9 where part of it is unknown or for the wording of a
license, 0.8 for a license's name near a word of licensing, 0.5 for its name alone, 0 for nothing.
A tag without any known identifier after it is no statement. `terms` is the largest value among
the text's expressions, null without one.

Every row stands for itself: no shuffle, and repeated rows get the same result each. Null text
counts as empty: no words, no places, empty labels, score 0, null terms. Texts are never cut;
a batch is worked on in slices of bounded bytes. Only A-Z are lower-cased.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.llm.batches import by_slices
from lavra.llm.common import share_code

# What stands between words, and the base phrases with their labels.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Names of licenses and wordings that only their texts have.
NAMES = {
    "affero general public license": "agpl",
    "artistic license": "artistic",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "cc by": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by nc nd": "cc-by-nc-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "mozilla public license": "mpl",
    "open software license": "osl",
    "the unlicense": "unlicense",
    "zlib license": "zlib",
}
WORDINGS = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this software is provided as is without any express or implied warranty in no event will the authors": "zlib",
}
# Words of licensing that may stand up to five words before a name.
LICENSING = ("licence", "licenced", "licensed", "released", "distributed", "available", "terms", "under")
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:", '"license":', "license =", "license=")
# First words of identifiers with their label and what they ask: permissive 0, weak 0.4, strong 0.7, no free use 1.
FAMILIES = {
    "0bsd": ("bsd", 0.0),
    "agpl": ("agpl", 0.8),
    "apache": ("apache", 0.0),
    "artistic": ("artistic", 0.2),
    "bsd": ("bsd", 0.0),
    "bsl": ("bsl", 0.0),
    "cc0": ("cc0", 0.0),
    "cc-by": ("cc-by", 0.1),
    "cc-by-nc": ("cc-by-nc", 1.0),
    "cc-by-nc-nd": ("cc-by-nc-nd", 1.0),
    "cc-by-nc-sa": ("cc-by-nc-sa", 1.0),
    "cc-by-nd": ("cc-by-nd", 0.9),
    "cc-by-sa": ("cc-by-sa", 0.6),
    "epl": ("epl", 0.4),
    "eupl": ("eupl", 0.6),
    "gpl": ("gpl", 0.7),
    "isc": ("isc", 0.0),
    "lgpl": ("lgpl", 0.4),
    "mit": ("mit", 0.0),
    "mpl": ("mpl", 0.4),
    "osl": ("osl", 0.7),
    "unlicense": ("unlicense", 0.0),
    "zlib": ("zlib", 0.0),
}
UNKNOWN, STRONG, WEAK = 1.0, 0.7, 0.4
# Operators with how close they bind.
BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[ \t]*([()]|[0-9a-z][0-9a-z.+:-]*)")

KIND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("expressions", pa.list_(pa.string())),
        ("terms", pa.float64()),
    ]
)


def postfix(line: str) -> tuple[list[str], str]:
    """The longest expression at the start of a lower-cased line, in postfix order and as it stands there.

    Operands and operators go where Dijkstra's shunting yard puts them. Whatever cannot follow ends
    the expression; an operator or a bracket without its other half is left out with all after it.
    """
    out: list[str] = []
    yard: list[str] = []
    whole, rest, stop = 0, [], 0  # the longest expression so far: operands out, operators in the yard, its end
    at, depth, operand_next = 0, 0, True
    while found := _TOKEN.match(line, at):
        token = found[1]
        if operand_next:
            if token == "(":
                yard.append(token)
                depth += 1
            elif token == ")" or token in BINDS:
                break
            else:
                out.append(token)
                operand_next = False
        elif token == ")":
            if not depth:
                break
            while (top := yard.pop()) != "(":
                out.append(top)
            depth -= 1
        elif token in BINDS:
            while yard and BINDS.get(yard[-1], 0) >= BINDS[token]:
                out.append(yard.pop())
            yard.append(token)
            operand_next = True
        else:
            break
        at = found.end()
        if not operand_next and not depth:
            whole, rest, stop = len(out), yard[::-1], at
    return out[:whole] + rest, " ".join(line[:stop].split())


def family(identifier: str) -> tuple[str, float] | None:
    """Label and demand of a known identifier such as `gpl-3.0-or-later`."""
    parts = identifier.rstrip("+").split("-")
    for size in range(len(parts), 0, -1):
        known = FAMILIES.get("-".join(parts[:size]))
        if known:
            return known
    return None


class Value(NamedTuple):
    """What a part of an expression comes to: labels, demand, and whether all of it is known."""

    labels: frozenset[str]
    demand: float
    known: bool


def evaluate(order: list[str]) -> Value:
    """The value of a postfix expression."""
    stack: list[Value] = []
    for token in order:
        if token not in BINDS:
            found = family(token)
            stack.append(Value(frozenset([found[0]]), found[1], True) if found else Value(frozenset(), UNKNOWN, False))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":  # the right side names an exception
            stack.append(left._replace(demand=WEAK if left.demand == STRONG else left.demand))
        else:
            demand = (max if token == "and" else min)(left.demand, right.demand)
            stack.append(Value(left.labels | right.labels, demand, left.known and right.known))
    return stack[0]


@cache
def phrase_automaton() -> ahocorasick.Automaton:
    """Phrases between blanks, each with its length, label, and kind: 0 base, 1 name, 2 wording."""
    automaton = ahocorasick.Automaton()
    for kind, phrases in ((2, WORDINGS), (1, NAMES), (0, BASE)):
        for phrase, label in phrases.items():
            automaton.add_word(f" {phrase} ", (len(phrase) + 2, phrase.count(" ") + 1, label, kind))
    automaton.make_automaton()
    return automaton


@cache
def tag_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for tag in TAGS:
        automaton.add_word(tag, len(tag))
    automaton.make_automaton()
    return automaton


def places(words: str) -> list[tuple[int, int, str, int]]:
    """First word, number of words, label and kind of every phrase in words set apart by single blanks."""
    found, at, word = [], 0, 0
    hits = sorted((end - value[0] + 1, value) for end, value in phrase_automaton().iter(words))
    for start, (_, size, label, kind) in hits:
        word += words.count(" ", at, start)
        at = start
        found.append((word, size, label, kind))
    return found


def tagged(text: str) -> dict[str, Value]:
    """The expressions with a known identifier after the tags of a lower-cased text, each with its value."""
    found = {}
    for end, _ in tag_automaton().iter(text):
        stop = text.find("\n", end)
        line = text[end + 1 : stop if stop >= 0 else len(text)].lstrip(" \t\"'")
        order, shown = postfix(line)
        if order and (value := evaluate(order)).labels:
            found[shown] = value
    return found


def _longest(own: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Places that lie in no longer one; they come in order of their first word."""
    kept: list[tuple[int, int, str, int]] = []
    for place in sorted(own, key=lambda p: (p[0], -p[1])):
        if not kept or place[0] + place[1] > kept[-1][0] + kept[-1][1]:
            kept.append(place)
    return kept


def scan(words: str, text: str) -> dict:
    """The result for one text, given as words between blanks and as lower-cased text."""
    found = places(words)
    base = [p for p in found if p[3] == 0]
    own = _longest([p for p in found if p[3]])
    values = tagged(text)
    near = False
    if base or own:
        split = words.split()
        near = any(w in LICENSING for p in [*base, *own] for w in split[max(0, p[0] - 5) : p[0]])
    score = max(
        [0.0]
        + [1.0 if v.known else 0.9 for v in values.values()]
        + [0.9 for p in own if p[3] == 2]
        + [0.8 if near else 0.5 for _ in [*base, *own][:1]]
    )
    base_labels = {p[2] for p in base}
    labels = base_labels | {p[2] for p in own} | {label for v in values.values() for label in v.labels}
    return {
        "n_words": max(0, words.count(" ") - 1),
        "n_base": len(base),
        "first_word": base[0][0] if base else None,
        "last_word": max(p[0] for p in base) if base else None,
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": score,
        "expressions": sorted(values),
        "terms": max((v.demand for v in values.values()), default=None),
    }


def scanned(texts: pa.Array) -> pa.Array:
    """A struct per text."""
    lowered = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
    words = pc.utf8_trim(pc.replace_substring_regex(lowered, BETWEEN, " "), " ")
    spaced = pc.if_else(pc.equal(words, ""), " ", pc.binary_join_element_wise(" ", words, " ", ""))
    rows = [scan(w, t) for w, t in zip(spaced.to_pylist(), lowered.to_pylist(), strict=True)]
    return pa.array(rows, KIND)


def scan_licenses(text: Column) -> Column:
    """Per text a struct of n_words, n_base, first_word, last_word, base_labels, labels, score, expressions and terms."""
    share_code()

    @F.arrow_udf(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, expressions array<string>, terms double"
    )
    def found(texts: pa.Array) -> pa.Array:
        return by_slices(scanned, KIND, texts)

    return found(text)
