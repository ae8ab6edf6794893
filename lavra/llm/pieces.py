"""SentencePiece encoding and decoding with the pieces of a given model.

The best-scored segmentation of a text is found in one pass: an Aho-Corasick automaton over the
pieces reports at each position every piece that ends there (the longest first, then along its
output links), and each of them relaxes the best score of that position. A character without a
piece costs the lowest score less ten and is spelled in byte pieces. Equal scores: the longer last
piece stays.

The scores of a unigram model are log probabilities. Those of a BPE model are ranks of its merges,
which do not add up; `piece_scores` counts instead, over all documents, the places where each
piece stands, and gives the logarithm of its share. Pieces and ids stay those of the model, nothing
is trained; but the segmentation is the likeliest one and not the one that the merges end in, so
ids differ from `SentencePieceProcessor.encode` here and there. Without scores the merges of a BPE
model are followed, and ids equal those of that function.

No piece holds a word boundary after another character, or a letter beside a full stop, so the
segmentation of a text is that of its words and their parts one after the other; a worker keeps the
segmentation of parts it has seen.
The model is a fixed vocabulary file; its pieces are sent to the workers, not the file.

Null text gives null ids, empty text an empty list, and neither counts. Texts are never cut.
Repeated rows count each and are encoded alike; ties among segmentations are settled as said.
Decoding gives back the text, but for U+2581 in it, which reads as a blank, as the format has it.
"""

from __future__ import annotations

import heapq
import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.common import share_code, short_batches

SPACE = "▁"
# Fixed value: how much a character without a piece costs below the worst piece.
UNKNOWN_PENALTY = 10.0
# Words whose segmentation a worker keeps before it starts anew.
KEPT_WORDS = 1_000_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@cache
def load_pieces(path: str) -> tuple[tuple[str, ...], tuple[float, ...], tuple[int, ...]]:
    """Pieces by id, their scores, and their kinds: 0 text, 1 byte, 2 neither."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = tuple(
        1 if model.is_byte(i) else 2 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else 0
        for i in ids
    )
    return tuple(model.id_to_piece(i) for i in ids), tuple(model.get_score(i) for i in ids), kinds


@cache
def is_bpe(path: str) -> bool:
    """Whether the scores of a model rank merges."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec = model.trainer_spec
    if spec.model_type == spec.BPE and any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces):
        raise ValueError("merges with user-defined or unused pieces are not supported")
    return spec.model_type == spec.BPE


class _Kept(dict):
    """Numbers of chunks, each made when it is first asked for."""

    def __init__(self, make: Callable[[str], int]):
        self.make = make

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = self.make(chunk)
        return number


class Segmenter:
    """Viterbi over the matches of the automaton, with the words seen so far."""

    def __init__(self, pieces, scores, kinds):
        self.automaton = ahocorasick.Automaton()
        self.single = set()
        lowest = 0.0
        for i, (piece, score, kind) in enumerate(zip(pieces, scores, kinds, strict=True)):
            if kind == 0 and piece:
                self.automaton.add_word(piece, (len(piece), score, i))
                lowest = min(lowest, score)
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()
        self.unknown = lowest - UNKNOWN_PENALTY
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == 1}
        self.unknown_id = next((i for i, p in enumerate(pieces) if kinds[i] == 2 and p == "<unk>"), 0)
        self.word = re.compile(_part(pieces, kinds))
        self._forget()

    def _forget(self):
        self.starts, self.flat = array("q", [0]), array("i")
        self.at = _Kept(self._keep)

    def _keep(self, chunk: str) -> int:
        """The number of a chunk that is met for the first time."""
        self.flat.extend(self.segment(chunk))
        self.starts.append(len(self.flat))
        return len(self.starts) - 2

    def segment(self, chunk: str) -> list[int]:
        """Ids of the best segmentation of one chunk."""
        n = len(chunk)
        # by the last character of a way; the last place, read as -1, is the empty one
        best = [float("-inf")] * n + [0.0]
        back: list = [None] * n  # the last piece of the best way here
        if self.single.issuperset(chunk):
            for end, value in self.automaton.iter(chunk):
                size, score, _ = value
                total = best[end - size] + score
                if total > best[end]:
                    best[end], back[end] = total, value
        else:
            done = 0
            for end, value in self.automaton.iter(chunk):
                if end > done:
                    self._spell(chunk, done, end, best, back)
                    done = end
                size, score, _ = value
                total = best[end - size] + score
                if total > best[end]:
                    best[end], back[end] = total, value
            self._spell(chunk, done, n, best, back)
        ids: list[int] = []
        j = n - 1
        while j >= 0:
            size, _, piece = back[j]
            if piece >= 0:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(chunk[j].encode("utf-8", "replace")))
            else:
                ids.append(self.unknown_id)
            j -= size
        ids.reverse()
        return ids

    def _spell(self, chunk: str, start: int, stop: int, best: list[float], back: list) -> None:
        """Relax the characters from `start` to `stop` that have no piece of their own."""
        for j in range(start, stop):
            if chunk[j] not in self.single and best[j - 1] + self.unknown > best[j]:
                best[j], back[j] = best[j - 1] + self.unknown, (1, self.unknown, -1)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids per text."""
        if len(self.at) > KEPT_WORDS:
            self._forget()
        found, counts = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                chunks = self.word.findall(SPACE + text.replace(" ", SPACE))
                found.append(np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks)))
                counts[k] = len(chunks)
        words = np.concatenate(found)
        if not len(words):
            return np.zeros(0, np.int32), counts
        starts, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.flat, np.int32)
        lengths = starts[words + 1] - starts[words]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) - np.repeat(ends - lengths - starts[words], lengths)
        text_ends = np.concatenate([[0], ends])[np.cumsum(counts)]
        ids = flat[places]
        del starts, flat  # what they look into grows with the next texts
        return ids, np.diff(text_ends, prepend=0)


class Merger(Segmenter):
    """The merges of a BPE model instead of the search, with the words seen so far."""

    def __init__(self, pieces, scores, kinds):
        super().__init__(pieces, scores, kinds)
        found = enumerate(zip(pieces, scores, kinds, strict=True))
        self.place = {piece: (-score, i) for i, (piece, score, kind) in found if kind == 0 and piece}

    def segment(self, chunk: str) -> list[int]:
        """Ids of what the merges leave of one chunk."""
        n, place = len(chunk), self.place
        symbols = list(chunk)  # a merged symbol stands where its first character was
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        open_ = [(v[0], i, i + 1, 2) for i in range(n - 1) if (v := place.get(chunk[i : i + 2]))]
        heapq.heapify(open_)
        while open_:
            _, i, j, size = heapq.heappop(open_)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one of the two was merged otherwise
            symbols[i] += symbols[j]
            symbols[j] = ""
            after = right[i] = right[j]
            if after < n:
                left[after] = i
            for a, b in ((left[i], i), (i, after)):
                if a >= 0 and b < n and (v := place.get(merged := symbols[a] + symbols[b])):
                    heapq.heappush(open_, (v[0], a, b, len(merged)))
        ids: list[int] = []
        for symbol in filter(None, symbols):
            if symbol in place:
                ids.append(place[symbol][1])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in symbol.encode("utf-8", "replace"))
            else:
                ids.append(self.unknown_id)
        return ids


def _chunk(pieces, kinds) -> str:
    """What is segmented by itself: words with the boundary before them, or whole texts where a piece holds a boundary inside."""
    inner = any(SPACE in piece.lstrip(SPACE) for piece, kind in zip(pieces, kinds, strict=True) if kind == 0)
    return "(?s).+" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+"


def _part(pieces, kinds) -> str:
    """A word as `_chunk` has it, cut also between neighbours that stand beside each other in no piece."""
    if any(SPACE in piece.lstrip(SPACE) for piece, kind in zip(pieces, kinds, strict=True) if kind == 0):
        return _chunk(pieces, kinds)
    group: dict[str, set[str]] = {}  # of each character, those it hangs together with by pieces
    for piece, kind in zip(pieces, kinds, strict=True):
        inner = piece.lstrip(SPACE) if kind == 0 else ""
        for a, b in zip(inner, inner[1:], strict=False):
            one, other = group.setdefault(a, {a}), group.setdefault(b, {b})
            if one is not other:
                one |= other
                group.update(dict.fromkeys(other, one))
    together = sorted({id(g): "".join(sorted(g)) for g in group.values()}.values(), key=lambda g: (-len(g), g))
    runs = "".join(f"[{re.escape(g)}]+|" for g in together)
    return f"(?s){SPACE}*(?:{runs}[^{SPACE}])|{SPACE}+"


def piece_scores(docs: DataFrame, text: str = "text", model: str | None = None) -> tuple[float, ...]:
    """The log of each piece's share among all places where a piece stands in the texts, one place more for each piece.

    Words are counted before and after one shuffle, and each distinct word runs through the
    automaton once. What comes back is a number per piece of the vocabulary.
    """
    spark = docs.sparkSession
    share_code(spark)
    short_batches(spark)
    vocabulary = load_pieces(model or default_model())
    shared = spark.sparkContext.broadcast(vocabulary)  # one vocabulary file: some MB at most
    key = uuid.uuid4().hex
    spelled = F.concat(F.lit(SPACE), F.replace(F.col(text), F.lit(" "), F.lit(SPACE)))
    words = docs.where(F.col(text) != "").select(
        F.explode(F.regexp_extract_all(spelled, F.lit(_chunk(vocabulary[0], vocabulary[2])), 0)).alias("word")
    )

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _segmenter(key, shared.value, Segmenter).automaton
        found = [0] * len(shared.value[0])
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for _, value in automaton.iter(word):
                    found[value[2]] += n
        ids = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(np.array(found)[ids], pa.int64())], ["id", "n"])

    counted = words.groupBy("word").agg(F.count("*").alias("n")).mapInArrow(places, "id int, n long")
    counts = np.ones(len(vocabulary[0]))
    for row in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():  # a row per piece at most
        counts[row["id"]] += row["n"]
    return tuple(np.log(counts / counts.sum()).tolist())


_segmenters: dict[tuple, Segmenter] = {}


def _segmenter(key, vocabulary, kind: type[Segmenter]) -> Segmenter:
    """One per worker process and model."""
    if key not in _segmenters:
        _segmenters.clear()
        _segmenters[key] = kind(*vocabulary)
    return _segmenters[key]


def encode(spark: SparkSession, text: Column, model: str | None = None, scores: tuple[float, ...] | None = None) -> Column:
    """The ids of each text: the best segmentation by `scores` or by those of the model, where these can be added up."""
    encoded = _encoder(spark, model, scores)

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        parts = [encoded(part) for part in _parts(column)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return ids(text)


def decode(spark: SparkSession, ids: Column, model: str | None = None) -> Column:
    """The text of each list of ids; control pieces are silent, wrong bytes read as U+FFFD."""
    decoded = _decoder(spark, model)

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        parts = [decoded(part) for part in _parts(column)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return texts(ids)


def encode_and_decode(spark: SparkSession, text: Column, model: str | None = None, scores: tuple[float, ...] | None = None) -> Column:
    """A struct of `ids` and the text `back` from them. Spark would encode a text twice for a column of its ids and one that decodes them."""
    encoded, decoded = _encoder(spark, model, scores), _decoder(spark, model)

    @F.arrow_udf("struct<ids:array<int>,back:string>")
    def both(column: pa.Array) -> pa.Array:
        parts = []
        for part in _parts(column):
            ids = encoded(part)
            parts.append(pa.StructArray.from_arrays([ids, decoded(ids)], ["ids", "back"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("ids", pa.list_(pa.int32())), ("back", pa.string())]))

    return both(text)


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    """Few texts at a time, which bounds the memory."""
    for start in range(0, len(column), 256):
        yield column.slice(start, 256)


def _encoder(spark: SparkSession, model: str | None, scores: tuple[float, ...] | None) -> Callable[[pa.Array], pa.Array]:
    """What a task makes of texts: their ids."""
    share_code(spark)
    short_batches(spark)
    model = model or default_model()
    pieces, own, kinds = load_pieces(model)
    kind = Merger if scores is None and is_bpe(model) else Segmenter
    shared = spark.sparkContext.broadcast((pieces, scores or own, kinds))  # one vocabulary file: some MB at most
    name = uuid.uuid4().hex  # under which a worker keeps what it has made of it

    def encoded(part: pa.Array) -> pa.Array:
        flat, counts = _segmenter(name, shared.value, kind).encode(part.to_pylist())
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        missing = pa.array(np.asarray(part.is_null()))
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()), mask=missing)

    return encoded


def _decoder(spark: SparkSession, model: str | None) -> Callable[[pa.Array], pa.Array]:
    """What a task makes of lists of ids: their texts."""
    share_code(spark)
    short_batches(spark)
    shared = spark.sparkContext.broadcast(load_pieces(model or default_model()))
    spelled: list[pa.Array] = []  # made once in a task

    def decoded(part: pa.Array) -> pa.Array:
        if not spelled:
            pieces, _, kinds = shared.value
            found = [
                bytes([int(p[3:5], 16)]) if k == 1 else b"" if k == 2 else p.replace(SPACE, " ").encode()
                for p, k in zip(pieces, kinds, strict=True)
            ]
            spelled.append(pa.array(found, pa.large_binary()))
        counts = np.asarray(pc.fill_null(pc.list_value_length(part), 0))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        lists = pa.LargeListArray.from_arrays(pa.array(offsets), spelled[0].take(part.flatten()))
        out: list[str | None] = []
        for row, whole in zip(part, pc.binary_join(lists, pa.scalar(b"", pa.large_binary())).to_pylist(), strict=True):
            text = whole.decode("utf-8", "replace")
            # the boundary put before the text goes
            out.append((text[1:] if text.startswith(" ") else text) if row.is_valid else None)
        return pa.array(out, pa.string())

    return decoded
