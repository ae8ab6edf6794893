"""Each method against a plain version of itself, a round trip, or accuracy on data held out."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lavra.llm import components, jaccard, mixing, neighbours, pages, perplexity, pieces, secrets, toxicity

WORDS = "alder birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew ash beech".split()


def prose(rng, n, words=WORDS):
    return " ".join(rng.choices(words, k=n))


# --- classifier


def plain_kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over characters, by the book, as a function of context and character."""
    counts = {order: Counter()}
    for t in texts:
        padded = "\x02" * (order - 1) + t
        for i in range(order - 1, len(padded)):
            counts[order][padded[i - order + 1 : i + 1]] += 1
    for size in range(order - 1, 0, -1):
        counts[size] = Counter(g[1:] for g in counts[size + 1])
    cut = {}
    for size, c in counts.items():
        n = [sum(v == k for v in c.values()) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        cut[size] = []
        for k in (1, 2, 3):
            d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] and n[1] else 0
            cut[size].append(min(d, k) if d > 0 and n[k] and n[1] else 0.5)

    def p(context, char, size):
        if size == 0:
            return 1 / (len(counts[1]) + 1)
        context = context[len(context) - size + 1 :] if size > 1 else ""
        own = {g: v for g, v in counts[size].items() if g[:-1] == context}
        if not own:
            return p(context, char, size - 1)
        d = lambda v: cut[size][min(v, 3) - 1] if v else 0
        total, left = sum(own.values()), sum(d(v) for v in own.values())
        v = own.get(context + char, 0)
        return (v - d(v)) / total + left / total * p(context, char, size - 1)

    return p


@pytest.mark.parametrize("entries", [4_000_000, 400])
def test_kneser_ney_equals_the_plain_model(spark, entries):
    rng = random.Random(2)
    texts = [prose(rng, 12) for _ in range(25)]
    judge = perplexity.Judge(order=4, shard_entries=entries)
    train = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    counts = perplexity.gram_counts(train, "lang", "text", 4)
    model = perplexity.language_model(counts, 4)
    asked = ["oak and pine", "zzz oak", "w", "  maple\n\noak "]
    rows = spark.createDataFrame([(t, "en") for t in asked], "text string, lang string")
    got = [r[0] for r in perplexity.log_perplexity(rows, model, judge, "lang", "text").select("_logp").collect()]
    p = plain_kneser_ney(texts, 4)
    for text, value in zip(asked, got, strict=True):
        text = re.sub(r"\s+", " ", text).strip()
        padded = "\x02" * 3 + text
        expected = -sum(math.log(p(padded[i - 3 : i], padded[i], 4)) for i in range(3, len(padded))) / len(text)
        assert value == pytest.approx(expected, rel=1e-5)


def test_classifier_rejects_junk_and_keeps_clean_text(spark):
    rng = random.Random(3)
    clean = [(i, prose(rng, 40), "en") for i in range(300)]
    junk = [(1000 + i, re.sub(r"(\w+)", r"\1&&&", prose(rng, 40)).upper(), "en") for i in range(60)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    trusted = docs.where("doc_id < 150").select("doc_id")
    kept = {r[0] for r in perplexity.classify(docs, trusted).where("_kept").select("_row.doc_id").collect()}
    assert {i for i, *_ in clean} == kept


def test_limit_is_the_held_out_quantile_whatever_short_texts_do(spark):
    rng = random.Random(5)
    names = ["".join(rng.choices("abcdeilmnorst", k=rng.randint(4, 8))) for _ in range(3000)]
    clean = [(i, prose(rng, 2 if i % 20 == 0 else 60, WORDS * 2000 + names), "en") for i in range(1200)]
    junk = [(5000 + i, " | ".join(rng.choices(WORDS, k=60)), "en") for i in range(60)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    trusted = docs.where("doc_id < 800").select("doc_id")
    kept = {r[0] for r in perplexity.classify(docs, trusted).where("_kept").select("_row.doc_id").collect()}
    assert not any(i >= 5000 for i in kept)
    assert len(kept) >= 0.97 * len(clean)
    assert sum(i in kept for i in range(0, 1200, 20)) >= 57  # of 60 short texts


# --- join


def plain_components(texts, words=5, percent=80):
    sets = {}
    for i, t in texts.items():
        found = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]
        grams = [tuple(found[k : k + words]) for k in range(len(found) - words + 1)] or ([tuple(found)] if found else [])
        sets[i] = frozenset(grams)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def planted_texts(rng):
    """Copies, chains of near copies, a large near group, shared passages and short texts."""
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [prose(rng, rng.randint(3, 120), vocabulary) for _ in range(60)]
    passage = prose(rng, 60, vocabulary)
    texts += [f"{prose(rng, 20, vocabulary)} {passage} {prose(rng, 20, vocabulary)}" for _ in range(40)]
    base = prose(rng, 150, vocabulary).split()
    for _ in range(90):  # some within the limit of each other, some only by way of others
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    chain = prose(rng, 200, vocabulary).split()
    for k in range(12):
        chain[15 * k : 15 * k + 2] = [f"x{k}", f"y{k}"]
        texts.append(" ".join(chain))
    texts += [texts[0], texts[0].upper(), texts[1] + "\n", "a b", "A  b", "one", ""]
    return dict(enumerate(texts))


@pytest.mark.parametrize("options", [{}, {"leaf": 8, "pivots": 3}, {"leaf": 7, "pivots": 2, "levels": 0}])
def test_join_equals_all_pairs(spark, options):
    texts = planted_texts(random.Random(4))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = jaccard.join_components(docs, jaccard.Join(**options))
    assert {r[0]: (r[1], r[2]) for r in got.select("doc_id", "n_shingles", "component_id").collect()} == plain_components(texts)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 90), (7, 7)], "a long, b long")
    got = dict(components.components(edges, "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 90: 90}


# --- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href=/>Site</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice">We use the cookies of this site for all of you and it is in the law.</div>
<!-- <p>not shown</p> --><main><article class="post"><header><h1>Head &amp; tail</h1></header>
<p>The first   line of the text is here&nbsp;and it is for the reader to see,
with a <a href="x">link</a> in it.<br>After the break.</p><p>Short one.</p>
<div class="ad">Buy the thing now as it is on offer for you and the family.</div>
<script>var t = "</p>";</script><p>1 &lt; 2 and 3 &gt; 2 &#233;</p><p hidden>gone</p>
<form><p>Your name</p><input></form>
<section id="comments"><p>A reader says that this is the best of all the texts in the world.</p></section></article></main>
<aside><p>The related texts of the day are here for you to see and to read on.</p></aside>
<footer><p>The end of the page is for the lawyers of the site.</p></footer></body></html>"""


def test_article_of_a_page():
    assert pages.main_text(PAGE).split("\n") == [
        "Head & tail",
        "The first line of the text is here and it is for the reader to see, with a link in it. After the break.",
        "Short one.",
        "1 < 2 and 3 > 2 é",
    ]


def test_page_without_landmarks_goes_by_its_blocks():
    text = "The story of the day is told here to all of the people who have come to hear it in the hall."
    html = f"<div><a href=1>A</a> <a href=2>B</a></div><div><p>{text}</p><p>So it is.</p><p>{text}</p></div><p><a href=3>More texts</a></p>"
    assert pages.main_text(html) == f"{text}\nSo it is.\n{text}"


def test_article_by_its_name():
    html = """<div id=menu><a href=1>Home</a></div><div class="content wide"><h2>Title</h2><p>Short.</p>
    <div class="share-buttons">Share this with all of the friends that you have in the world.</div></div><p>Outside.</p>"""
    assert pages.main_text(html) == "Title\nShort."
    assert pages.main_text(html.replace("<h2>", "<article><h2>").replace("Short.</p>", "Short.</p></article><p>Not in it.</p>")) == "Title\nShort."


NAMED = "The text of the day is for all of the people who have come to read it in the hall of the town."


@pytest.mark.parametrize(
    "tag",
    ['div class="overflow-hidden"', 'article class="post comments-open"', 'div class="entry-content no-sidebar"',
     'div id="search-results"', 'div class="post social-science"', 'article class="notice"', 'main class="page menu"'],
)
def test_a_word_within_a_name_drops_no_text(tag):
    end = tag.split()[0]
    assert pages.main_text(f'<{tag}><p>{NAMED}</p><p class="notice-board">{NAMED}</p></{end}>') == f"{NAMED}\n{NAMED}"


@pytest.mark.parametrize(
    "tag",
    ['div class="cookie-notice"', 'div class="siteFooter"', 'div id=adSlot', 'section class="related-posts"', 'div role=banner',
     'div class="x comment-list"', 'div hidden', 'div style="display: none"', 'article class="comment-body"', 'div class="page-header"',
     'div class="ad-container wide"', 'ul class="main-nav"', 'div class="sidebar"', 'div class="SIDEBAR"'],
)
def test_names_of_furniture_as_a_whole(tag):
    end = tag.split()[0]
    assert pages.main_text(f"<{tag}><p>{NAMED}</p></{end}><div><p>{NAMED} Yes.</p></div>") == f"{NAMED} Yes."


def test_densities_and_neighbours_decide(monkeypatch):
    """Without the rules of the two passes, link lists and their captions would stay."""
    links = " ".join(f"<a href={i}>Other page {i}</a>" for i in range(4))
    html = f"<div><p>Read on</p><p>{links}</p></div><p>{NAMED}</p><p>Brief.</p><p>{NAMED}</p><div>{links}</div><p>More</p>"
    assert pages.main_text(html) == f"{NAMED}\nBrief.\n{NAMED}"
    monkeypatch.setattr(pages, "first_pass", lambda block, rules: not block.furniture)
    assert pages.main_text(html) != f"{NAMED}\nBrief.\n{NAMED}"


def test_of_equally_near_neighbours_the_later_counts():
    links = " ".join(f"<a href={i}>Other page {i}</a>" for i in range(4))
    assert pages.main_text(f"<p>{NAMED}</p><p>Between</p><p>{links}</p>") == NAMED
    assert pages.main_text(f"<p>{links}</p><p>Between</p><p>{NAMED}</p>") == f"Between\n{NAMED}"


def test_repeated_pages_and_columns_of_the_same_name(spark):
    df = spark.createDataFrame([(1, PAGE, "t"), (1, PAGE, "t"), (2, None, None)], "page_id long, html string, text string")
    got = [tuple(r) for r in df.select("page_id", pages.extract(F.col("html")).alias("text"), F.col("text").alias("mine")).collect()]
    assert sorted(got, key=str) == [(1, pages.main_text(PAGE), "t")] * 2 + [(2, "", None)]


# --- pieces


def plain_viterbi(segmenter, chunk, pieces_, scores, kinds):
    place = {p: (i, s) for i, (p, s, k) in enumerate(zip(pieces_, scores, kinds, strict=True)) if k == 0}
    best, back = [0.0] + [-math.inf] * len(chunk), [None] * (len(chunk) + 1)
    for j in range(1, len(chunk) + 1):
        for i in range(j):  # the longest piece first
            if chunk[i:j] in place and best[i] + place[chunk[i:j]][1] > best[j]:
                best[j], back[j] = best[i] + place[chunk[i:j]][1], (i, [place[chunk[i:j]][0]])
        if chunk[j - 1] not in segmenter.single and best[j - 1] + segmenter.unknown > best[j]:
            best[j], back[j] = best[j - 1] + segmenter.unknown, (j - 1, [segmenter.bytes[b] for b in chunk[j - 1].encode()])
    out, j = [], len(chunk)
    while j:
        j, ids = back[j]
        out = ids + out
    return out


def test_segmentation_equals_the_plain_search():
    vocabulary = pieces.load_pieces(pieces.default_model())
    segmenter = pieces.Segmenter(*vocabulary)
    texts = ["The quick  brown fox", "日本語 x", "a\nb\t𝔘", "   ", "unbelievably", "été où ñandú", "x" * 70, "THE!! END###"]
    flat, counts = segmenter.encode(texts)
    for text, ids in zip(texts, np.split(flat, np.cumsum(counts)[:-1]), strict=True):
        assert ids.tolist() == plain_viterbi(segmenter, "▁" + text.replace(" ", "▁"), *vocabulary)


def test_ids_are_those_of_the_model_itself(spark):
    import sentencepiece

    rng = random.Random(8)
    alphabet = "aabcdeeefghiiilmnooprsttuwyz  \n\tÉñß日本語𝔘▁.,#|0123"
    texts = ["The quick  brown fox and the products", " lead", "trail  ", "x" * 70, "a\x00b", "<s> <0x41> </s>", "   ", ""]
    texts += [prose(rng, 30), *("".join(rng.choices(alphabet, k=rng.randint(1, 200))) for _ in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(docs.select("doc_id", pieces.encode(spark, F.col("text"))).collect())
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for i, text in enumerate(texts):
        assert list(got[i]) == model.encode(text), text


def test_scores_and_ids_of_the_query_equal_the_plain_version(spark):
    rng = random.Random(5)
    texts = ["The quick  brown fox and the products", " lead", "x" * 70, "a\x00b", "日本語 𝔘 été", "   ", "", None]
    texts += [prose(rng, 40) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    names, own, kinds = pieces.load_pieces(pieces.default_model())
    counts = {p: 1 for p, k in zip(names, kinds, strict=True) if k == 0}
    longest = max(map(len, counts))
    for text in filter(None, texts):
        whole = "▁" + text.replace(" ", "▁")
        for i in range(len(whole)):
            for j in range(i + 1, min(len(whole), i + longest) + 1):
                if whole[i:j] in counts:
                    counts[whole[i:j]] += 1
    total = sum(counts.values()) + sum(k != 0 for k in kinds)
    scores = pieces.piece_scores(docs)
    for name, score, kind in zip(names, scores, kinds, strict=True):
        assert score == pytest.approx(math.log((counts[name] if kind == 0 else 1) / total))
    segmenter = pieces.Segmenter(names, scores, kinds)
    got = dict(docs.select("doc_id", pieces.encode(spark, F.col("text"), scores=scores)).collect())
    for i, text in enumerate(texts):
        plain = plain_viterbi(segmenter, "▁" + text.replace(" ", "▁"), names, scores, kinds) if text else text and []
        assert got[i] == ([] if text == "" else plain), text
    assert len(got[0]) < len(texts[0]) / 2  # whole words, not letters


# --- secrets


def test_forest_on_findings_held_out():
    context = secrets.Context(frozenset(WORDS), np.full((27, 27), math.log(1 / 27)))
    scanner = secrets.train(context)
    held_out = secrets.labelled_findings(WORDS, per_kind=40, seed=99)
    x = np.array([secrets.features(f.before, f.value, f.after, context) for f in held_out])
    said = scanner.forest.predict(x) >= scanner.threshold
    assert np.mean(said == [f.secret for f in held_out]) > 0.97


def test_mask_keeps_everything_but_the_secret():
    context = secrets.Context(frozenset(WORDS), np.full((27, 27), math.log(1 / 27)))
    scanner = secrets.train(context)
    value = "3f" * 20
    text = f'oak pine token = "{value}" é 4929348385146306 123.43.25.46 a@mail4.example.com'
    assert scanner.mask(text) == text.replace(value, secrets.MASK)
    assert [(text[a:b], s >= 0.5) for a, b, s in scanner.scan(text)][0] == (value, True)


def test_values_behind_names_and_equals_signs():
    context = secrets.Context(frozenset(WORDS), np.full((27, 27), math.log(1 / 27)))
    scanner = secrets.train(context)
    value = "3f9a04bd" * 5
    spoken = {
        f"oak token={value} pine": value,
        f"oak API_KEY={value}, pine": value,
        "elm password: hunter2024 maple": "hunter2024",
        'elm password = "Xk9#mQ2v!pT" maple': "Xk9#mQ2v!pT",
        f"elm secret='{value}' maple": value,
        "key=QWxhZGRpbjpvcGVuIHNlc2FtZQ== oak": "QWxhZGRpbjpvcGVuIHNlc2FtZQ==",
    }
    for text, secret in spoken.items():
        assert scanner.mask(text) == text.replace(secret, secrets.MASK), text
    for text in (
        "", "oak pine", f"oak commit {value} pine", "elm password: 2024-11-12 maple", "elm password: ******** maple",
        "elm password: maple", f"oak {value[:32]} pine", "oak key: token= pine",
    ):
        assert scanner.mask(text) == text, text


def test_candidates_in_order_and_apart():
    rng = random.Random(3)
    alphabet = ["key", "token", "=", ":", '"', "'", " ", "a1", "b-", "9f", "/", ".", "é", "password: ", "#", "\n", "abcdefgh1"]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 30)))
        spans = secrets.candidates(text)
        assert all(0 <= a < b <= len(text) for a, b in spans)
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_held_out_findings_as_the_scan_meets_them():
    context = secrets.Context(frozenset(WORDS), np.full((27, 27), math.log(1 / 27)))
    scanner = secrets.train(context)
    held_out = secrets.labelled_findings(WORDS, per_kind=40, seed=99)
    seen = [(x, f.secret) for f in held_out if (x := secrets.scanned(f, context))]
    x, y = (np.array(part, float) for part in zip(*seen, strict=True))
    assert np.mean((scanner.forest.predict(x) >= scanner.threshold) == (y > 0)) > 0.97
    assert sum(f.secret for f in held_out) == y.sum()  # no secret escapes the candidates


def test_dictionary_and_pairs_of_all_documents(spark):
    spelled = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    rows = [(i, f"oak {spelled(i)} elm") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    context = secrets.corpus_context(docs, "text")
    assert context.dictionary == {spelled(i) for i in range(4000)}
    counts = np.ones((27, 27))
    for i in range(4000):
        for a, b in zip(spelled(i), spelled(i)[1:]):
            counts[ord(a) - 97, ord(b) - 97] += 1
    assert np.allclose(context.pairs, np.log(counts / counts.sum(axis=1, keepdims=True)))
    assert secrets.corpus_context(docs, "text", least_share=0.001).dictionary == set()


# --- toxicity


def test_insults_held_out_gapped_and_spaced():
    rng = random.Random(6)
    insults = ["blockhead", "numbskull"]
    texts, labels = [], []
    for i in range(400):
        found = prose(rng, 40).split()
        if i % 4 == 0:
            found.insert(rng.randrange(40), rng.choice(insults))
        texts.append(". ".join(" ".join(found[k : k + 10]) for k in range(0, len(found), 10)))
        labels.append(int(i % 4 == 0))
    model = toxicity.fit(texts[:300], labels[:300], (225, 75))
    scores = model.scores(texts[300:])
    assert ((scores >= 0.3) == np.array(labels[300:], bool)).all()
    hidden = ["oak b.l.o.c.k.h.e.a.d pine", "oak b l o c k h e a d pine", "oak blockxhead pine", "oak Numbskull!!", "NUMB-SKULL"]
    assert (model.scores(hidden) >= 0.3).all()
    assert (model.scores(["oak pine", "", None, "block head of maple"])[:3] < 0.3).all()


def test_kernel_is_the_plain_one():
    def plain(a, b):
        def grams(s):
            found = defaultdict(float)
            for i in range(len(s)):
                for j in range(i + 1, len(s)):
                    for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                        found[s[i], s[j], s[k]] += toxicity.DECAY ** (k - i + 1)
            return found

        x, y = grams(a), grams(b)
        dot = lambda p, q: sum(v * q.get(g, 0) for g, v in p.items())
        return dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))

    words = toxicity.edged(["idiot", "idxiot", "banana", "idiots"])
    got = toxicity._kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(plain(a, b), abs=1e-5)


# --- neighbours


def test_recall_against_all_pairs(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 32))
    x[100:160] = x[5]  # a vector that many rows share
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    hits = total = 0
    for q in range(0, 3000, 50):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        nearest = sorted((d, i) for i, d in enumerate(distance) if i != q)[:10]
        assert all(math.isclose(s, distance[i]) for s, i in got[q]) and got[q] == sorted(got[q]) and len(got[q]) == 10
        hits += sum(s <= nearest[-1][0] + 1e-12 for s, _ in got[q])
        total += 10
    assert hits / total >= 0.9
    assert [i for _, i in got[100]] == [5, *range(101, 110)]


# --- mixing


def test_limits_and_budget_of_a_mixture(spark):
    rows = [(i, "a" if i < 900 else "b" if i < 980 else "c", "w " * 10) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plain = mixing.mix(docs, mixing.Mixture(entropy_share=None, max_repeats=3.0)).select("_row.*")
    counts = Counter(r["source"] for r in plain.collect())
    # the exponent that lets the smallest source repeat three times: the largest once
    a = 1 - math.log(3) / math.log(45)
    assert counts["a"] == 900 and counts["c"] == 60
    assert counts["b"] == pytest.approx(80 * (900 / 80) ** (1 - a), abs=1)
    level = mixing.mix(docs, mixing.Mixture(entropy_share=0.999, max_repeats=None, budget=6000)).select("_row.*")
    shares = np.array([c for c in Counter(r["source"] for r in level.collect()).values()]) / 600
    assert -(shares * np.log(shares)).sum() >= 0.998 * math.log(3) and abs(shares.sum() - 1) < 0.01
    spread = mixing.mix(docs, mixing.Mixture(block_tokens=1000, max_repeats=3.0, entropy_share=None))
    blocks = spread.groupBy("_block").agg(F.count("*").alias("n")).collect()
    assert min(b["n"] for b in blocks) > 50 and max(b["n"] for b in blocks) < 160
