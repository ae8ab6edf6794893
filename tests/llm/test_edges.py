"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra.llm import chat, cleaning, jaccard, mixing, neighbours, pages, perplexity, pieces, secrets, toxicity

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _id string, _row string, _key string,"
    " _text string, h string, n string, doc string, tokens string, weight string"
)
LONG = "the cat sat on the mat and the dog lay by the door of it " * 3000
ROWS = [
    (1, "the cat sat on the mat and saw the dog", "en", "a"),
    (1, "the cat sat on the mat and saw the dog", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \n\t ", "en", "b"),
    (None, "a text without an id stands here today", "en", "b"),
    (5, LONG, "en", "b"),
    (6, LONG, "en", None),
    (7, "日本語 𝔘nicode é \x00 word", "xx", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([r + (9,) + ("clash",) * 9 for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return sorted(((r[0], *r[1:]) for r in df.select("doc_id", *columns).collect()), key=str)


def test_line_rules(odd, none):
    rows = by_id(cleaning.clean_lines(odd), "n_words", "word_chars", "n_repeat_words", "base_failed", "kept")
    assert len(rows) == len(ROWS)
    assert rows.count((1, 10, 29, 0, True, False)) == 2
    assert (2, 0, 0, 0, True, False) in rows and (3, 0, 0, 0, True, False) in rows and (4, 0, 0, 0, True, False) in rows
    assert (5, 45000, 126000, 45000, True, False) in rows
    assert cleaning.clean_lines(none).count() == 0


def test_classifier(odd, none, spark):
    trusted = spark.createDataFrame([(1,), (5,), (1,), (None,)], "doc_id long")
    found = perplexity.classify(odd, trusted).select("_row.*", "_perplexity", "_kept")
    rows = by_id(found, "_perplexity", "_kept", "weight")
    assert len(rows) == len(ROWS)
    kept = {r[0]: r[2] for r in rows}
    # blank text in a known language goes; a language without trusted text stays
    assert not kept[2] and not kept[4] and kept[3] and kept[7] and kept[5]
    assert {r[1] for r in rows if r[0] in (2, 3, 4, 7)} == {None}
    assert perplexity.classify(none, trusted).count() == 0
    assert perplexity.classify(odd, trusted.limit(0)).where("_kept").count() == len(ROWS)


def test_join(odd, none):
    rows = by_id(jaccard.join_components(odd), "n_shingles", "component_id")
    assert len(rows) == len(ROWS)
    assert rows.count((1, 6, 1)) == 2
    assert (2, 0, 2) in rows and (3, 0, 3) in rows and (4, 0, 4) in rows and (None, 4, None) in rows
    assert (6, 15, 5) in rows and (7, 1, 7) in rows
    assert jaccard.join_components(none).count() == 0


def test_pieces(odd, none, spark):
    encoded = odd.withColumn("ids", pieces.encode(spark, F.col("text")))
    back = encoded.withColumn("back", pieces.decode(spark, F.col("ids")))
    assert back.where("not (back <=> text)").count() == 0
    assert back.where("doc_id = 2 and ids is null").count() == 1
    assert back.where("doc_id = 3 and size(ids) = 0").count() == 1
    assert none.withColumn("ids", pieces.encode(spark, F.col("text"))).count() == 0


def test_secrets(odd, none):
    scanner = secrets.scanner_for(odd)
    assert secrets.findings(odd, scanner).count() == 0
    masked = odd.withColumn("masked", secrets.mask(scanner, F.col("text")))
    assert masked.where("not (masked <=> text)").count() == 0
    empty = secrets.scanner_for(none)
    assert secrets.findings(none, empty).count() == 0


def test_toxicity(odd, none, spark):
    labels = spark.createDataFrame([(1, 0), (5, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    scores = [r[0] for r in odd.select(toxicity.score(model, F.col("text"))).collect()]
    assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
    one_sided = toxicity.train(odd, labels.where("toxic = 0"))
    assert {round(r[0], 4) for r in odd.select(toxicity.score(one_sided, F.col("text"))).collect()} == {0.0}
    assert none.select(toxicity.score(toxicity.train(none, labels), F.col("text"))).count() == 0


def test_mixing(odd, none):
    mixed = mixing.mix(odd, mixing.Mixture(max_repeats=None, entropy_share=None)).select("_row.*", "_epoch", "_block")
    # the exponent stays at one: every row once, also those without tokens
    assert sorted(by_id(mixed, "_epoch"), key=str) == sorted([(r[0], 0) for r in ROWS], key=str)
    assert mixing.mix(none).count() == 0


def test_pages(spark):
    html = [(1, None), (2, ""), (3, "<p"), (4, "<!-- open"), (5, "<article><p>" + LONG + "</p>"), (6, "<article>x")]
    df = spark.createDataFrame(html, "page_id long, html string")
    got = dict(df.select("page_id", pages.extract(F.col("html"))).collect())
    assert got[1] == got[2] == got[3] == got[4] == ""
    assert got[5] == LONG.strip() and got[6] == "x"
    assert df.limit(0).select(pages.extract(F.col("html"))).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "<|x"), (None, 3, "bot", "b"), (2, 0, "system", "s")]
    df = spark.createDataFrame([r + ("clash",) for r in rows], "conv_id long, turn int, role string, text string, side string")
    got = {(r["conv_id"], r["participant"]): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, "user"), (1, "unknown"), (None, "bot")}
    assert got[1, "user"]["n_messages"] == 3  # equal messages all stay
    assert "< |x" in got[1, "unknown"]["text"]
    assert chat.rotate(df.limit(0)).count() == 0


def plain_sides(rows, length):
    """Rows (conversation, turn, role, text) without nulls but in turn, from each speaker's side, one message after the other."""
    out = {}
    for conv in {r[0] for r in rows}:
        told = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        for side in {r[1] for r in told}:
            for at in range(0, len(told), length):
                text, spans = "", []
                for _, role, body in told[at : at + length]:
                    name = "assistant" if role == side else f"user name={role}"
                    if role == side:
                        spans.append((len(text) + len("<|im_start|>assistant\n"), len(text) + len(f"<|im_start|>assistant\n{body}<|im_end|>")))
                    text += f"<|im_start|>{name}\n{body}<|im_end|>\n"
                out[conv, side, at // length] = (text, spans)
    return out


def test_long_chats_with_equal_messages(spark):
    """Over 256 turns, and many equal messages on one turn or none, all stand in their place."""
    rows = [(1, i, ("ann", "bob")[i % 2], f"line {i}") for i in range(300)]
    rows += [(2, None, "ann", "ok")] * 37 + [(2, 4, "bob", "ok")] * 25 + [(2, 4, "ann", "x"), (3, 0, "ann", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    for length in (10, 1024):
        found = chat.rotate(df, segment_messages=length).collect()
        got = {(r["conv_id"], r["participant"], r["segment"]): (r["text"], [tuple(s) for s in r["trained"]]) for r in found}
        assert len(found) == len(got) and got == plain_sides(rows, length)
    assert sum(r["conv_id"] == 1 for r in found) == 2  # one row for each side


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i), 1.0]) for i in range(4)] + [(4, [1.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0])]
    rows += [(8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash"))
    got = neighbours.search(df, F.col("vec_id") % 2 == 0, k=10)
    of = {}
    for r in got.orderBy("query_id", "rank").collect():
        of.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 6)))
    assert set(of) == {0, 2, 4}
    assert of[4] == [(1, 0.0), (1, 0.0), (0, 1.0), (2, 1.0), (3, 2.0)]
    assert neighbours.search(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0


def test_neighbours_of_several_lengths(spark):
    """A stray vector of another length, wherever its id stands, costs the others nothing."""
    rows = [(i, [float(i), 1.0]) for i in range(8)] + [(-1, [1.0, 1.0, 1.0]), (100, [1.0, 2.0, 2.0]), (50, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 2 == 0, k=2).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 6)))
    assert got == {
        0: [(1, 1.0), (2, 2.0)], 2: [(1, 1.0), (3, 1.0)], 4: [(3, 1.0), (5, 1.0)], 6: [(5, 1.0), (7, 1.0)],
        100: [(-1, 1.414214)],
    }


def test_a_worker_frees_the_classifiers_table_when_the_join_comes():
    import weakref

    import numpy as np
    import pyarrow as pa

    from lavra.llm import jaccard, perplexity

    class Shared:
        value = (np.arange(1, 100, dtype=np.uint64), np.zeros(99, np.float32))

    kept = weakref.ref(perplexity._table("a", Shared))
    assert kept() is not None and perplexity._table("a", Shared) is kept()
    jaccard._task_links(jaccard.Join(), False)(
        pa.table({"doc": [1, 2], "set": pa.array([[1, 2], [1, 2]], pa.list_(pa.int64())), "component": [1, 2]})
    )
    assert kept() is None


def test_a_text_is_encoded_once_for_its_ids_and_their_decoding(spark, tmp_path):
    from lavra.llm import queries

    texts = ["The quick  brown fox", " lead", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op9_pieces"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    asked = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(asked) == 1 and asked[0].count("(text#") == 1, plan
    assert {r["doc_id"]: r["round_trip"] for r in found.collect()} == dict.fromkeys(range(4), True)


def test_the_join_takes_members_in_parts_and_frees_its_copies(spark):
    import random
    from pathlib import Path

    from lavra import session

    rng = random.Random(6)
    texts = []
    for k in range(30):
        words = [f"w{rng.randrange(400)}" for _ in range(60)]
        texts += [" ".join(words), " ".join([*words[:-1], f"z{k}"]), " ".join(words)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = set(session._staged)
    found = by_id(jaccard.join_components(docs), "n_shingles", "component_id")
    assert {r[0]: r[2] for r in found} == {i: i - i % 3 for i in range(len(texts))}
    left = {Path(path).name.rsplit("-", 1)[0] for path in session._staged if path not in before}
    assert "jaccard-components" in left
    assert not left & {"jaccard-shared", "jaccard-near", "jaccard-sets", "jaccard-df", "jaccard-members", "jaccard-regions"}
    assert by_id(jaccard.join_components(docs, jaccard.Join(parts=1)), "n_shingles", "component_id") == found


def test_the_classifier_frees_its_copies(spark):
    from pathlib import Path

    from lavra import session

    docs = spark.createDataFrame([(i, "en", f"the text of day {i} is here") for i in range(40)], "doc_id long, lang string, text string")
    before = set(session._staged)
    assert perplexity.classify(docs, docs.select("doc_id")).count() == 40
    left = {Path(path).name.rsplit("-", 1)[0] for path in session._staged if path not in before}
    assert not left & {"kn-grams", "kn-model", "kn-entries", "kn-trusted"}
