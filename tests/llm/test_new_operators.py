"""Spelling variants, license scans and fill-in-middle against plain versions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lavra.llm import batches, infill, licenses, variants
from lavra.llm.queries import op12_licenses

SCHEMA = "doc_id long, text string, word string, key string, run string, n string, found string, f string, _row string"
LONG = "the License licence of a lesser general publication, and so onwards. " * 4000
ROWS = [
    (1, "Released under the MIT License."),
    (1, "Released under the MIT License."),
    (2, None),
    (3, ""),
    (4, " \n\t\x0b "),
    (None, "a text without an identifier, under the Apache License"),
    (5, LONG),
    (6, LONG),
    (7, "日本語 𝔘nicode é \x00 word<P>"),
    (8, "  two\tlines\nand a tail \r\n "),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([r + ("clash",) * 7 for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- spelling variants


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_pairs(words) -> set[tuple[str, str]]:
    words = sorted(words)
    return {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}


def met_pairs(words) -> set[tuple[str, str]]:
    """What pivots and prefixes bring together, verified."""
    grams = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    ranks = {g: k for k, (_, g) in enumerate(sorted((n, g) for g, n in grams.items()))}
    index: dict[int, set[tuple[str, int]]] = {}
    for w in words:
        keys, last = variants.prefix_keys(w, ranks)
        for key in keys:
            index.setdefault(key, set()).add((w, last))
    found = set()
    for w in words:
        keys, last = variants.pivot_keys(w, ranks)
        for key in keys:
            found |= {(min(w, o), max(w, o)) for o, end in index.get(key, ()) if last <= end and one_edit(w, o)}
    return found


edits = st.tuples(st.integers(0, 20), st.sampled_from(["cut", "put", "swap"]), st.sampled_from("abz"))


def edited(word: str, edit) -> str:
    at, kind, letter = edit[0] % len(word), edit[1], edit[2]
    return word[:at] + {"cut": "", "put": letter + word[at], "swap": letter}[kind] + word[at + 1 :]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=7, max_size=14), st.lists(edits, max_size=4)), max_size=8))
def test_pivots_meet_every_near_word(seeds):
    words = {v for w, es in seeds for v in [w, *(edited(w, e) for e in es)] if len(v) >= 4}
    assert met_pairs(words) == plain_pairs(words)


def test_pivots_are_the_rarest_disjoint_pair():
    for places in ([(0, 5), (1, 1), (2, 4)], [(3, 1), (4, 1), (9, 9)], [(0, 1), (1, 2), (2, 30)]):
        pairs = [(a + b, [p, q]) for p, a in places for q, b in places if q - p >= 2]
        assert variants.rarest_disjoint(places, 2) == min(pairs)[1]


def plain_forms(texts: list[tuple[int, str]], spelling: variants.Spelling) -> dict[str, tuple]:
    runs = [r for _, t in texts for r in re.findall("[a-zÀ-ÿ]+", (t or "").translate(str.maketrans(variants.UPPER, variants.LOWER)))]
    n = {w: c for w, c in Counter(r for r in runs if len(r) >= spelling.min_chars).items() if c >= spelling.min_count}
    out = {}
    for w in n:
        near = sorted((o for o in n if one_edit(w, o)), key=lambda o: (-n[o], o))
        out[w] = (near[0] if near and n[near[0]] >= spelling.times * n[w] else None, n[w], len(near))
    return out


def test_forms_and_roots(spark):
    texts = [(1, "Wordings " * 400 + "wordingz " * 30 + "wordinggz wordinggz wordinggz"), (2, "wordinks wordinks élevées ÉLEVÉES élevéés élevéés")]
    texts += [(3, "between between betwean betwean betweem betweem")]
    got = {r["word"]: r for r in variants.spelling_variants(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    want = plain_forms(texts, variants.Spelling())
    assert {w: (r["form"], r["n"], r["n_near"]) for w, r in got.items()} == want
    assert got["wordinggz"]["form"] == "wordingz" and got["wordinggz"]["root"] == "wordings"
    assert got["wordingz"]["form_n"] == 400 and got["wordings"]["root"] == "wordings"
    assert got["wordinks"]["form"] == "wordings" and got["between"]["form"] is None and got["between"]["n_near"] == 2
    # É is not lower-cased, so it is another letter
    assert "élevées" not in got and got["élevéés"]["n_near"] == 0


def test_forms_equal_the_plain_version_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang = 'fr'")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r["word"]: (r["form"], r["n"], r["n_near"]) for r in variants.spelling_variants(docs).collect()}
    assert got == plain_forms(texts, variants.Spelling())


def test_tied_forms_and_hot_words(spark):
    texts = [(i, "constant constanz constanz") for i in range(3)] + [(9, "constans " * 60 + "constand " * 60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    got = {r["word"]: r for r in variants.spelling_variants(docs).collect()}
    assert got["constant"]["form"] == "constand" and got["constanz"]["form"] == "constand"
    assert got["constans"]["form"] is None


def test_variants_of_odd_rows(odd, none, spark):
    got = {r["word"]: r["n"] for r in variants.spelling_variants(odd).collect()}
    assert got["license"] == 8003 and got["released"] == 2 and "identifier" not in got
    assert variants.spelling_variants(none).count() == 0
    long = "ab" * 9000
    docs = spark.createDataFrame([(1, f"{long} {long} {long[1:]} {long[1:]}")], "doc_id long, text string")
    assert {r["n_near"] for r in variants.spelling_variants(docs).collect()} == {1}


def test_other_characters_are_refused(spark):
    words = spark.createDataFrame([(chr(0x4E00 + i) + chr(0x4E00 + i // 7) + "x", 2) for i in range(9000)], "word string, n long")
    with pytest.raises(ValueError, match="bigrams"):
        variants.gram_ranks(words)


# ---- license scans


def plain_base(text: str | None) -> tuple:
    lowered = (text or "").translate(str.maketrans(variants.UPPER, variants.LOWER))
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    at = [
        (i, label)
        for phrase, label in licenses.BASE.items()
        for i in range(len(words))
        if words[i : i + phrase.count(" ") + 1] == phrase.split(" ")
    ]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_base_equals_the_plain_version_on_a_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    found = op12_licenses(spark, folder).collect()
    assert len(found) == len(texts)
    hits = 0
    for r in found:
        assert tuple(r[1:6]) == plain_base(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
        hits += r["n_base"] > 0
    assert hits > 5


def test_labels_equal_the_plain_version_on_a_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    for r in op12_licenses(spark, folder).collect():
        lowered = texts[r["doc_id"]].translate(str.maketrans(variants.UPPER, variants.LOWER))
        words = " " + " ".join(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)) + " "
        spans = []
        for phrases in (licenses.NAMES, licenses.WORDINGS):
            for phrase, label in phrases.items():
                spans += [(m.start(), m.start() + len(phrase), label) for m in re.finditer(f"(?= {re.escape(phrase)} )", words)]
        own = {s[2] for s in spans if not any(o is not s and o[0] <= s[0] and s[1] <= o[1] and o[:2] != s[:2] for o in spans)}
        base = {label for phrase, label in licenses.BASE.items() if f" {phrase} " in words}
        assert "license:" not in lowered and "spdx" not in lowered
        assert r["labels"] == ",".join(sorted(base | own))


ids = st.sampled_from(["mit", "isc", "gpl-2.0", "mpl-2.0", "agpl-3.0", "cc-by-nc-4.0", "nonesuch"])
trees = st.recursive(ids, lambda t: st.tuples(t, st.sampled_from(["and", "or"]), t), max_leaves=12)


def shown(tree, above: int = 0) -> str:
    if isinstance(tree, str):
        return tree
    binds = licenses.BINDS[tree[1]]
    text = f"{shown(tree[0], binds)} {tree[1]} {shown(tree[2], binds + 1)}"
    return f"({text})" if binds < above else text


def demand(tree) -> float:
    if isinstance(tree, str):
        known = licenses.family(tree)
        return known[1] if known else licenses.UNKNOWN
    return (max if tree[1] == "and" else min)(demand(tree[0]), demand(tree[2]))


@settings(max_examples=300, deadline=None)
@given(trees)
def test_expressions_evaluate_like_their_tree(tree):
    order, text = licenses.postfix(shown(tree) + "; the rest")
    assert text == shown(tree)
    assert licenses.evaluate(order).demand == demand(tree)


@pytest.mark.parametrize(
    ("line", "read", "terms"),
    [
        ("gpl-2.0-only with classpath-exception-2.0 or agpl-3.0 */", "gpl-2.0-only with classpath-exception-2.0 or agpl-3.0", 0.4),
        ("mit or isc and gpl-3.0+", "mit or isc and gpl-3.0+", 0.0),
        ("mit applies here", "mit", 0.0),
        ("mit or", "mit", 0.0),
        ("mit) or isc", "mit", 0.0),
        ("((mit)) or lgpl-2.1", "((mit)) or lgpl-2.1", 0.0),
    ],
)
def test_expression_ends(line, read, terms):
    order, text = licenses.postfix(line)
    assert text == read and licenses.evaluate(order).demand == terms


@pytest.mark.parametrize("line", ["", ")", "(mit or isc", "and mit", "/* none */"])
def test_no_expression(line):
    assert licenses.postfix(line) == ([], "")


def test_long_expression_and_brackets():
    order, text = licenses.postfix(" or ".join(["mit"] * 50_000))
    assert len(order) == 99_999 and licenses.evaluate(order).labels == {"mit"}
    assert licenses.postfix("(" * 50_000 + "mit" + ")" * 50_000)[0] == ["mit"]


def test_scan_of_odd_rows(odd, none):
    rows = odd.select("doc_id", licenses.scan_licenses(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    for r, (_, text) in zip(rows, ROWS, strict=True):
        assert tuple(r[1:6]) == plain_base(text)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["labels"] == "mit" and by_id[1]["score"] == 0.8
    assert by_id[2]["labels"] == by_id[3]["labels"] == by_id[5]["labels"] == "" and by_id[2]["score"] == 0
    assert by_id[None]["base_labels"] == "apache"
    assert none.select(licenses.scan_licenses(F.col("text"))).count() == 0


def test_tags_and_notices(spark):
    texts = [
        "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\ncode",
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
        "the GNU Lesser General Public License",
        "CC BY-NC-SA 4.0",
        "license: nonesuch",
        "SPDX-License-Identifier: MIT AND nonesuch",
        "a limit license for MITigation",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r[0] for r in docs.orderBy("doc_id").select(licenses.scan_licenses(F.col("text"))).collect()]
    assert [g["labels"] for g in got] == ["apache,bsd,mit", "mit", "gpl,lgpl", "cc-by-nc-sa", "", "mit", ""]
    assert [g["score"] for g in got] == [1.0, 0.9, 0.5, 0.5, 0.0, 0.9, 0.0]
    assert got[0]["expressions"] == ["(mit or apache-2.0) and bsd-3-clause"] and got[0]["terms"] == 0.0
    assert got[2]["base_labels"] == "gpl" and got[5]["terms"] == 1.0


# ---- fill-in-middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_told(key, text) -> tuple:
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def told_and_back(df):
    told = df.withColumn("told", infill.fill_in_middle(F.col("doc_id"), F.col("text")))
    return told.withColumn("back", infill.restore(F.col("told.output"), F.col("told.form"))).select("doc_id", "text", "told", "back")


def test_infill_of_odd_rows(spark, odd, none):
    texts = ROWS * 6 + [(100 + i, t) for i, (_, t) in enumerate(ROWS * 5)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = told_and_back(df).collect() + told_and_back(odd).collect()
    assert len(rows) == len(texts) + len(ROWS) and {r["told"]["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert tuple(r["told"]) == plain_told(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert told_and_back(none).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é𝔘\t\n\x0b\x1c\x85\x00<PSM>"), max_size=30), max_size=8), st.integers(0, 10**6))
def test_infill_equals_the_plain_version(texts, first):
    keys = [first + i for i in range(len(texts))]
    digests = [hashlib.sha256(f"42:{k}".encode()).hexdigest() for k in keys]
    hashes = [pa.array([int(d[8 * i : 8 * i + 8], 16) for d in digests], pa.int64()) for i in range(4)]
    plan = infill.Infilling()
    column = pa.array(texts, pa.string())
    told = batches.by_slices(lambda *c: infill.infilled(*c, plan), infill.KIND, column, *hashes)
    assert [tuple(t.values()) for t in told.to_pylist()] == [plain_told(k, t) for k, t in zip(keys, texts, strict=True)]
    back = batches.by_slices(infill.told_back, pa.string(), told.field("output"), told.field("form"))
    assert back.to_pylist() == texts


def test_what_cannot_be_told_back_is_null():
    got = infill.told_back(pa.array(["<P>a<S>b", None, "x", "<P>a<S>b<M>c"]), pa.array(["psm", "spm", None, "psm"]))
    assert got.to_pylist() == [None, None, None, "acb"]


def test_slices_hold_every_row_once():
    texts = pa.array(["x" * 10, None, "", "y" * 100, "z", "z" * 49, "w"], pa.string())
    cuts = list(batches.slices(texts, 50))
    assert [i for at, n in cuts for i in range(at, at + n)] == list(range(7))
    assert max(sum(len(t or "") for t in texts.slice(*c).to_pylist()) for c in cuts if c[1] > 1) <= 50
    assert list(batches.slices(texts.slice(0, 0))) == []
