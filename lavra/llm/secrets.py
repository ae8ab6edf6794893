"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of key-like characters, or what stands behind a name such as `password:` and
need not be long; `=` parts a name from its value and belongs to it at the end only. The forest looks at its length, its character
transitions (against bigrams of the corpus), how much of it dictionary words cover, whether it
sits in a path, and the words beside it. It is trained from labelled findings: given ones, or
those of `labelled_findings`, which spells secrets and look-alikes by rule with a fixed seed.
Dictionary and bigrams are counted over all documents; only the words that make at least `least_share`
of all words are sent to the tasks. Every document is scanned whole.

Null and empty text has no findings. Spans count code points. Equal rows have equal findings.
"""

from __future__ import annotations

import math
import random
import re
import string
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import share_code, words
from lavra.session import stage

MASK = "[SECRET]"
# Words beside a value that speak for a secret, and against one.
SECRET_WORDS = frozenset(
    "access api apikey auth authorization bearer client credential credentials key passwd password private pwd secret"
    " signing token".split()
)
HARMLESS_WORDS = frozenset(
    "build call card checksum commit digest etag fax file hash href id image ip isbn mail md5 order phone revision sha"
    " sha1 sha256 src tel url uuid version www".split()
)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.\-]{12,}(?:={1,2}(?![A-Za-z0-9+/_=.\-]))?")
_NAMED = re.compile(
    r"(?i)(?:auth|credentials?|key|passwd|password|pwd|secret|token)[\"']?[ \t]*[=:][ \t]*"
    r"(?=\"([^\s\"]{8,})\"|'([^\s']{8,})'|([^\s\"',;=]{8,}={0,2}))"
)
_SIGNS = frozenset("#$%&*!?@^+~" + string.digits)
_WORD = re.compile(r"[A-Za-z]+")
_CLASSES = np.zeros(128, np.int8)
for _i, _set in enumerate((string.ascii_lowercase, string.ascii_uppercase, string.digits), start=1):
    _CLASSES[[ord(c) for c in _set]] = _i


@dataclass(frozen=True)
class Context:
    """What the features know of the corpus: frequent words, and log odds of letter pairs."""

    dictionary: frozenset[str]
    pairs: np.ndarray  # 27 x 27 log probabilities, 26 being any other character


@dataclass(frozen=True)
class Finding:
    before: str  # text in front of the candidate
    value: str
    after: str
    secret: bool


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans in order: named values of 8 characters with a digit or sign, and other key-like runs of 12 with a digit or of 24."""
    found = []
    for m in _NAMED.finditer(text):
        start, end = m.span(m.lastindex)
        value = text[start:end].rstrip(".:)]}>") if m.lastindex == 3 else text[start:end]
        if len(value) >= 8 and "://" not in value and not _SIGNS.isdisjoint(value):
            if not found or start >= found[-1][1]:
                found.append((start, start + len(value)))
    named, k = len(found), 0
    for m in _CANDIDATE.finditer(text):
        value = m[0].strip("-./_+") if m[0][-1] in "-./_+" or m[0][0] in "-./_+" else m[0]
        if len(value) >= 12 and (len(value) >= 24 or any(c.isdigit() for c in value)):
            start = m.start() + m[0].index(value)
            while k < named and found[k][1] <= start:
                k += 1
            if k == named or found[k][0] >= start + len(value):
                found.append((start, start + len(value)))
    return sorted(found)


def features(before: str, value: str, after: str, context: Context) -> list[float]:
    """The features of one candidate."""
    codes = np.frombuffer(value.encode("ascii", "replace"), np.uint8) & 127
    kinds = _CLASSES[codes]
    n = len(value)
    shares = np.bincount(kinds, minlength=4) / n
    counts = np.unique(codes, return_counts=True)[1] / n
    letters = np.where(kinds == 1, codes - 97, np.where(kinds == 2, codes.astype(int) - 65, 26)).astype(int)
    lower = value.lower()
    near = [w.lower() for w in _WORD.findall(before[-40:])][-3:]
    glued = before[-1:]
    return [
        float(n),
        float(shares[3]),
        float(shares[2]),
        float(shares[0]),
        float(np.count_nonzero(np.diff(kinds)) / max(n - 1, 1)),
        float(-(counts * np.log2(counts)).sum()),
        float(context.pairs[letters[:-1], letters[1:]].mean()) if n > 1 else 0.0,
        _coverage(lower, context.dictionary),
        float(value.count("/") + before[-1:].count("/") + after[:1].count("/")),
        float(value.count(".") + value.count("-")),
        float(all(c in "0123456789abcdef" for c in lower)),
        float(any(w in SECRET_WORDS for w in near)),
        float(any(w in HARMLESS_WORDS for w in near)),
        float(glued in "\"'" and bool(glued)),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float("@" in before[-24:] and not before[-24:].rpartition("@")[2].strip(string.ascii_letters + string.digits + ".-")),
        float(bool(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", lower))),
    ]


def _coverage(lower: str, dictionary: frozenset[str]) -> float:
    """Share of the characters that words of four letters or more cover, longest first."""
    covered = at = 0
    while at < len(lower):
        for size in range(min(12, len(lower) - at), 3, -1):
            if lower[at : at + size] in dictionary:
                covered, at = covered + size, at + size
                break
        else:
            at += 1
    return covered / max(len(lower), 1)


def labelled_findings(dictionary: Sequence[str], per_kind: int = 150, seed: int = 11) -> list[Finding]:
    """Secrets and look-alikes in typical surroundings, spelled by rule."""
    rng = random.Random(seed)
    vocabulary = sorted(dictionary) or ["word"]
    text = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    prose = lambda n=3: " ".join(rng.choices(vocabulary, k=n))
    hexes, mixed = "0123456789abcdef", string.ascii_letters + string.digits
    cased = lambda s: s.upper() if rng.random() < 0.3 else s
    found = []
    for _ in range(per_kind):
        name = cased(rng.choice(["token", "api_key", "secret", "password", "auth_token", "access-key", "private key"]))
        sign = rng.choice([" = ", "=", ": ", ' = "', '="', ': "', " = '"])
        end = sign[-1] if sign[-1] in "\"'" else rng.choice([" ", "\n", ", "])
        for value in (
            cased(text(hexes, rng.choice([32, 40, 64]))),
            text(mixed, rng.randint(20, 44)),
            "AKIA" + text(string.ascii_uppercase + string.digits, 16),
            "ghp_" + text(mixed, 36),
            text(string.ascii_lowercase, rng.randint(5, 8)) + text(string.digits, rng.randint(3, 4)),
            text(mixed, rng.randint(4, 7)) + text("#$%!?@^~", 2) + text(mixed, rng.randint(3, 7)),
        ):
            found.append(Finding(f"{prose()} {name}{sign}", value, f"{end} {prose()}", True))
        for before, value, after in (
            (f"{prose()} commit ", text(hexes, 40), f" {prose()}"),
            (f"{prose()} sha256:", text(hexes, 64), f" {prose()}"),
            (f"{prose()} /static/js/", text(hexes, 20) + ".js", f" {prose()}"),
            (f"{prose()} src=\"/img/", f"{'/'.join(rng.choices(vocabulary, k=3))}{rng.randint(1, 99)}.png", '" '),
            (f"{prose()} id ", str(uuid.UUID(int=rng.getrandbits(128))), f" {prose()}"),
            (f"{prose()} ", text(string.digits, 16), f" {prose()}"),
            (f"{prose()} ", ".".join(str(rng.randint(100, 255)) for _ in range(4)), f" {prose()}"),
            (f"{prose()} {rng.choice(vocabulary)}@", f"mail{rng.randint(1, 9)}.example.com", f" {prose()}"),
            (f"{prose()} https:/", f"/www{rng.randint(1, 9)}.example.org/{rng.choice(vocabulary)}/{rng.randint(1, 999)}", " "),
            (f"{prose()} ", "".join(rng.choices(vocabulary, k=6))[:40].ljust(24, "e"), f" {prose()}"),
            (f"{prose()} ", "-".join(rng.choices(vocabulary, k=4)) + str(rng.randint(1, 99)), f" {prose()}"),
            (f"{prose()} ", text(hexes, 32), f" {prose()}"),
            (f"{prose()} {name}{sign}", f"20{rng.randint(10, 40)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{end} {prose()}"),
            (f"{prose()} {name}{sign}", rng.choice("*#?") * rng.randint(8, 16), f"{end} {prose()}"),
            (f"{prose()} {name} ", "_".join(rng.choices(vocabulary, k=4)) + str(rng.randint(1, 9)), f" {prose()}"),
        ):
            found.append(Finding(before, value, after, False))
    return found


class Forest:
    """Bagged trees on random features, grown by Gini impurity; arrays only, so cheap to send."""

    def __init__(self, trees: int = 15, depth: int = 7, cuts: int = 12, seed: int = 5):
        self.trees, self.depth, self.cuts, self.seed = trees, depth, cuts, seed
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        tried = max(1, round(math.sqrt(x.shape[1])) + 1)
        for _ in range(self.trees):
            size = 2 ** (self.depth + 1)
            feature, cut, value = np.full(size, -1), np.zeros(size), np.full(size, float(y.mean()) if len(y) else 0.0)
            rows = {1: rng.integers(0, len(x), len(x))}
            while rows:
                node, own = rows.popitem()
                value[node] = y[own].mean()
                if node * 2 >= size or 0 < min(value[node], 1 - value[node]) * len(own) < 1 or value[node] in (0.0, 1.0):
                    continue
                best = (np.inf, -1, 0.0)
                for f in rng.choice(x.shape[1], tried, replace=False):
                    column = x[own, f]
                    for c in np.unique(np.quantile(column, np.linspace(0, 1, self.cuts + 2)[1:-1])):
                        left = column <= c
                        n = left.sum()
                        if 0 < n < len(own):
                            p, q = y[own][left].mean(), y[own][~left].mean()
                            impurity = n * p * (1 - p) + (len(own) - n) * q * (1 - q)
                            best = min(best, (impurity, int(f), float(c)))
                if best[1] >= 0:
                    feature[node], cut[node] = best[1], best[2]
                    left = x[own, best[1]] <= best[2]
                    rows[node * 2], rows[node * 2 + 1] = own[left], own[~left]
            self.nodes.append((feature, cut, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of secret findings in the leaves a row reaches, over all trees."""
        total = np.zeros(len(x))
        for feature, cut, value in self.nodes:
            node = np.ones(len(x), int)
            for _ in range(self.depth):
                f = feature[node]
                go = f >= 0
                right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
                node = np.where(go, node * 2 + right, node)
            total += value[node]
        return total / max(len(self.nodes), 1)


@dataclass(frozen=True)
class Scanner:
    context: Context
    forest: Forest
    threshold: float = 0.5

    def scan(self, text: str | None) -> list[tuple[int, int, float]]:
        """Start, end and score of every candidate of a text."""
        spans = candidates(text) if text else []
        if not spans:
            return []
        x = [_at(text, a, b, self.context) for a, b in spans]
        return [(a, b, float(s)) for (a, b), s in zip(spans, self.forest.predict(np.array(x)), strict=True)]

    def mask(self, text: str | None) -> str | None:
        """The text with each secret replaced."""
        out, last = [], 0
        for a, b, score in self.scan(text):
            if score >= self.threshold:
                out += [text[last:a], MASK]
                last = b
        return text if not out else "".join(out) + text[last:]


def corpus_context(docs: DataFrame, text: str, least_share: float = 1e-6) -> Context:
    """Frequent words of all documents, and the letter pairs of all their words."""
    found = (
        docs.select(F.explode(words(F.lower(F.col(text)))).alias("w"))
        .where(F.col("w").rlike("^[a-z]{4,12}$"))
        .groupBy("w")
        .agg(F.count("*").alias("n"))
    )
    found = stage(found, "secret-words")
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substr("w", i, F.lit(2))))
    counts = np.ones((27, 27))
    for row in found.select("n", pair.alias("pair")).groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 26 x 26 at most
        counts[ord(row["pair"][0]) - 97, ord(row["pair"][1]) - 97] += row["n"]
    total = found.agg(F.sum("n")).first()[0] or 0
    frequent = found.where(F.col("n") >= least_share * total).select("w").collect()  # 1 / `least_share` words at most
    return Context(frozenset(r["w"] for r in frequent), np.log(counts / counts.sum(axis=1, keepdims=True)))


def train(context: Context, findings: Sequence[Finding] | None = None, threshold: float = 0.5) -> Scanner:
    """A scanner from labelled findings."""
    rows = list(findings) if findings is not None else labelled_findings(sorted(context.dictionary))
    seen = [(x, r.secret) for r in rows if (x := scanned(r, context))]
    x, y = (np.array(part, float) for part in zip(*seen, strict=True))
    return Scanner(context, Forest().fit(x, y), threshold)


def scanned(finding: Finding, context: Context) -> list[float] | None:
    """The features under which a scan of the finding in its place meets it; None if it is no candidate there."""
    text, start = finding.before + finding.value + finding.after, len(finding.before)
    for a, b in candidates(text):
        if a < start + len(finding.value) and start < b:
            return _at(text, a, b, context)
    return None


def _at(text: str, a: int, b: int, context: Context) -> list[float]:
    return features(text[max(0, a - 64) : a], text[a:b], text[b : b + 8], context)


def scanner_for(docs: DataFrame, text: str = "text", **options) -> Scanner:
    return train(corpus_context(docs, text), **options)


def scan(scanner: Scanner, text: Column) -> Column:
    """All candidates of each text with their scores."""
    share_code()

    @F.arrow_udf("array<struct<start:int,end:int,score:double>>")
    def found(column: pa.Array) -> pa.Array:
        rows = [
            [{"start": a, "end": b, "score": s} for a, b, s in scanner.scan(t.as_py())] for t in column
        ]
        kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        return pa.array(rows, pa.list_(kind))

    return found(text)


def mask(scanner: Scanner, text: Column) -> Column:
    """Each text with its secrets replaced; null stays null."""
    share_code()

    @F.arrow_udf("string")
    def masked(column: pa.Array) -> pa.Array:
        return pa.array([scanner.mask(t.as_py()) for t in column], pa.string())

    return masked(text)


def findings(docs: DataFrame, scanner: Scanner, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate: where it is, its score, and whether it is taken for a secret."""
    return (
        docs.select(F.col(key), F.explode(scan(scanner, F.col(text))).alias("f"))
        .select(F.col(key), "f.*")
        .withColumn("secret", F.col("score") >= scanner.threshold)
    )
