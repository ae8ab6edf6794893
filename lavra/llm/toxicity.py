"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel of two strings compares their subsequences of three characters, each weighted by
`DECAY` to the power of its span, so gaps and inserted characters cost but do not hide a word.
Landmarks are the words and word starts that tell labels apart best; the Nyström map turns the kernel to them
into a few numbers per word, on which a linear machine with squared hinge loss is trained. As the
machine is linear in the subsequences, scoring needs one look-up for each subsequence.

A text is a bag of sentences and a sentence a bag of words: it is as toxic as its worst word.
Labels belong to texts, so training keeps of a toxic text the sentence it finds worst, and of
others all sentences, and repeats that. A logistic curve over the worst word gives the score,
fitted on the same texts with the labels' own shares.

At most `bound` texts of each label are used for fitting, those with the smallest id hash; all
texts are scored whole. Null and empty texts score as one without any word. Without texts of both
labels every score is the share of label 1. Nothing but the text enters a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.common import share_code
from lavra.llm.sampling import bounded_ids, rows_of
from lavra.session import stage

DECAY = 0.6
SPAN = 6  # characters a subsequence may stretch over
_TABLE = 1 << 21  # hashed subsequences
_OFFSETS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_EDGE = "\x02", "\x03"
_BLANK = re.compile(r"[ \t\n\x0b\x0c\r]+")
_SENTENCE = re.compile(r"(?<=[.!?])[ \t]+|\n+")
_SPACED = re.compile(r"(?:(?<=[ \t\n])|^)\w(?:[ \t\n.\-_*]\w){2,}(?=[ \t\n.,!?]|$)")
_LONGEST = 32  # longer words are read in overlapping stretches


def forms(token: str) -> list[str]:
    """What a token is compared as: without marks around it, and its letters and digits alone."""
    token = token.lower()
    bare = token.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    if not bare:
        return []
    plain = "".join(c for c in bare if c.isalnum())
    found = [bare] if plain == bare else [bare, plain]
    return [f[i : i + _LONGEST] for f in found if f for i in range(0, max(1, len(f) - _LONGEST // 2), _LONGEST // 2)]


def tokens(text: str) -> list[str]:
    """Blank-separated tokens, and runs of single characters joined to one more token each."""
    found = _BLANK.split(text)
    return found + ["".join(c for c in m if c.isalnum()) for m in _SPACED.findall(text)]


def edged(strings: list[str]) -> list[str]:
    """Words with a mark for their start and end."""
    return [_EDGE[0] + s + _EDGE[1] for s in strings]


def subsequences(marked: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hashed subsequence and weight of every string; equal ones of a string summed, rows of length 1."""
    lengths = np.array([len(s) for s in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(marked)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters to the end of the string
    rows, keys, weights = [], [], []
    for i, j in _OFFSETS:
        at = np.flatnonzero(left > j)
        key = (codes[at] * np.uint64(0x9E3779B1) + codes[at + i]) * np.uint64(0x85EBCA77) + codes[at + j]
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        rows.append(row[at])
        keys.append((key >> np.uint64(43)).astype(np.int64))
        weights.append(np.full(len(at), DECAY ** (j + 1)))
    pair = np.concatenate(rows) * _TABLE + np.concatenate(keys)
    unique, inverse = np.unique(pair, return_inverse=True)
    weight = np.bincount(inverse, np.concatenate(weights), len(unique))
    row, key = unique // _TABLE, unique % _TABLE
    norm = np.sqrt(np.bincount(row, weight**2, len(marked)))
    return row, key, weight / norm[row]


@dataclass
class Model:
    """Weight of each hashed subsequence, offset, and the curve from the worst word to the score."""

    weight: np.ndarray
    offset: float
    slope: float
    base: float
    floor: float  # value of a text without words
    seen: dict[str, float] = field(default_factory=dict)

    def values(self, strings: list[str]) -> np.ndarray:
        if not strings:
            return np.zeros(0)
        row, key, weight = subsequences(edged(strings))
        return np.bincount(row, weight * self.weight[key], len(strings)) + self.offset

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The value of the worst word of each text."""
        bags = [set(tokens(t)) if t else set() for t in texts]
        new = list(set().union(*bags).difference(self.seen))
        if len(self.seen) + len(new) > 1_000_000:
            self.seen.clear()
            new = list(set().union(*bags))
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            spelled = [forms(t) for t in part]
            flat = self.values([f for fs in spelled for f in fs])
            ends = np.cumsum([len(fs) for fs in spelled])
            for t, fs, end in zip(part, spelled, ends, strict=True):
                self.seen[t] = float(flat[end - len(fs) : end].max()) if fs else self.floor
        return np.array([max([self.floor, *map(self.seen.__getitem__, bag)]) for bag in bags])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.worst(texts) + self.base)))

    def __getstate__(self):
        return {**self.__dict__, "seen": {}, "weight": self.weight.astype(np.float32)}


def _machine(x: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and offset of a linear machine with squared hinge loss, by Newton steps.

    `cost` has for each instance what it costs on the wrong side of label 0 and of label 1.
    """
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        value = x @ w
        pull = np.zeros(len(x))
        active = np.zeros(len(x))
        for y, c in ((-1, cost[0]), (1, cost[1])):
            gap = 1 - y * value
            on = (gap > 0) & (c > 0)
            pull[on] += c[on] * y * gap[on]
            active[on] += c[on]
        used = np.flatnonzero(active)
        gradient = penalty * w - 2 * (x[used].T @ pull[used])
        hessian = np.diag(penalty) + 2 * ((x[used] * active[used, None].astype(x.dtype)).T @ x[used]).astype(float)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _curve(value: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number, with a little shrinkage."""
    x, w = np.column_stack([value, np.ones(len(value))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (cost * (p - y)) + 1e-3 * w
        hessian = (x * (cost * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _starts(word: str) -> set[str]:
    """A word with its edges, and its first letters, four to eight of them."""
    marked = _EDGE[0] + word + _EDGE[1]
    return {marked} | {marked[: n + 1] for n in range(4, min(8, len(word)) + 1)}


def _landmarks(bags: list[np.ndarray], vocabulary: list[str], y: np.ndarray, n: int) -> list[str]:
    """The words and word starts whose share of texts differs most between the labels, in units of its error."""
    starts = [_starts(w) for w in vocabulary]
    place = {s: i for i, s in enumerate(sorted(set().union(*starts)))}
    of = [np.array([place[s] for s in own]) for own in starts]
    counts = np.zeros((2, len(place)))
    for bag, label in zip(bags, y, strict=True):
        if len(bag):
            counts[int(label), np.unique(np.concatenate([of[i] for i in bag]))] += 1
    total = np.array([max(1, (y == 0).sum()), max(1, y.sum())])
    share = counts.sum(axis=0) / total.sum()
    error = np.sqrt(share * (1 - share) * (1 / total).sum()) + 1e-9
    z = np.where(counts.sum(axis=0) >= 3, (counts[1] / total[1] - counts[0] / total[0]) / error, 0.0)
    names = sorted(place)
    order = sorted(range(len(names)), key=lambda i: (-z[i], -len(names[i]), names[i]))
    picked: list[str] = []
    seen: set[tuple] = set()
    for i in order:
        same = (counts[0, i], counts[1, i], names[i][:5])  # starts of the same words tell the same
        if same not in seen and len(picked) < n - n // 4:
            seen.add(same)
            picked.append(names[i])
    return picked + [names[i] for i in order[::-1][: n // 4] if names[i] not in seen]


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel of every word to every landmark, some thousand words at a time."""
    row, key, weight = subsequences(landmarks)
    keys, column = np.unique(key, return_inverse=True)
    table = np.zeros((len(keys), len(landmarks)), np.float32)
    table[column, row] = weight
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for start in range(0, len(words), 4000):
        part = words[start : start + 4000]
        row, key, weight = subsequences(part)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[at] == key
        row, at, weight = row[hit], at[hit], weight[hit]
        if len(row):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            out[start + row[first]] = np.add.reduceat(table[at] * weight[:, None].astype(np.float32), first)
    return out


def fit(texts: list[str], labels: list[int], shares: tuple[int, int], landmarks: int = 128, rounds: int = 3) -> Model:
    """A model from labelled texts; `shares` are how many texts have label 0 and 1 in all."""
    y = np.array(labels, float)
    prior = min(max(shares[1] / max(1, sum(shares)), 1e-6), 1 - 1e-6)
    constant = Model(np.zeros(_TABLE), 0.0, 0.0, float(np.log(prior / (1 - prior))), 0.0)
    place: dict[str, int] = {}
    # a text as sentences, a sentence as the places of its words
    ids = []
    for text in texts:
        bags = [{f for t in tokens(s) for f in forms(t)} for s in _SENTENCE.split(text or "")]
        ids.append([np.array(sorted(place.setdefault(w, len(place)) for w in b)) for b in bags if b])
    if len(set(labels)) < 2 or not place:
        return constant
    vocabulary = list(place)
    words_of = [np.unique(np.concatenate(of)) if of else np.zeros(0, int) for of in ids]
    marks = _landmarks(words_of, vocabulary, y, landmarks)
    value, vector = np.linalg.eigh(_kernel(marks, marks).astype(float))
    good = value > 1e-4
    root = vector[:, good] / np.sqrt(value[good])  # the Nyström map
    kernel = _kernel(edged(vocabulary), marks)
    # words unlike every landmark are one instance at the origin
    near = np.flatnonzero(kernel.max(axis=1) >= 0.1)
    mapped = np.vstack([kernel[near] @ root.astype(np.float32), np.zeros((1, root.shape[1]), np.float32)])
    row_of = np.full(len(vocabulary), len(near))
    row_of[near] = np.arange(len(near))
    del kernel
    ids = [[np.unique(row_of[b]) for b in of] for of in ids]
    words_of = [np.unique(np.concatenate(of)) if of else np.zeros(0, int) for of in ids]
    cost = np.zeros((2, len(mapped)))
    for own, label in zip(words_of, y, strict=True):
        cost[int(label), own] += 1
    # before the first round a word counts for label 1 as far as it is more frequent there than by chance
    expected = cost[0] * y.sum() / max(1, (y == 0).sum())
    cost[1] = np.maximum(cost[1] - expected - 2 * np.sqrt(expected + 1), 0)
    for step in range(rounds):
        if not cost[1].any():
            return constant
        w = _machine(mapped, cost)
        values = mapped @ w[:-1] + w[-1]
        if step + 1 < rounds:
            cost[1] = 0
            for of, label in zip(ids, y, strict=True):
                if label and of:
                    worst = max((b[values[b].argmax()] for b in of), key=lambda i: values[i])
                    if values[worst] > -0.5:
                        cost[1, worst] += 1
    alpha = root @ w[:-1]
    row, key, weight = subsequences(marks)
    folded = np.zeros(_TABLE)
    np.add.at(folded, key, alpha[row] * weight)
    floor = float(values.min())
    worst = np.array([values[own].max() if len(own) else floor for own in words_of])
    share = np.where(y == 1, shares[1] / y.sum(), shares[0] / (y == 0).sum())
    slope, base = _curve(worst, y, share / share.mean())
    return Model(folded, float(w[-1]), slope, base, floor)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          bound: int = 1000, **options) -> Model:
    """A model from at most `bound` texts of each label; rows without id or label take no part."""
    known = labels.select(F.col(key), F.col(label).cast("int").alias("_label")).where(f"{key} is not null and _label in (0, 1)")
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    picked = [
        bounded_ids(known.where(F.col("_label") == v), key, bound).withColumn("_label", F.lit(v)) for v in (0, 1)
    ]
    ids = stage(picked[0].unionByName(picked[1]), "toxic-ids")
    rows = (
        docs.select(F.col(key), F.col(text).alias("_text"))
        .join(F.broadcast(ids), F.col(key) == F.col("_id"))
        .orderBy(key, "_label")
        .select("_text", "_label")
        .collect()  # at most `bound` texts of each label
    )
    return fit([r[0] or "" for r in rows], [r[1] for r in rows], (counts.get(0, 0), counts.get(1, 0)), **options)


def score(model: Model, text: Column) -> Column:
    """The score of each text, 0 to 1."""
    share_code()
    shared = SparkSession.active().sparkContext.broadcast(model)  # a table of fixed size

    @F.arrow_udf("double")
    def scores(column: pa.Array) -> pa.Array:
        parts = [
            shared.value.scores(column.slice(start, 256).to_pylist()) for start in range(0, len(column), 256)
        ]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scores(text)


