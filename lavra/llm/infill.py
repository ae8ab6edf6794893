"""Fill-in-middle: a text is cut in three and told in another order, and told back.

A unit is a word with the white space before it; white space at the end of a text is a unit of its
own. A batch runs through `pyarrow.compute` as a whole: texts are split into lists of units, the
lists flattened beside the row each unit came from, every unit gets its ordinal within its row and
by it the role of prefix, middle or suffix; each role is filtered out, its lists are rebuilt and
joined. There is no loop over rows. Slices of a batch bound the memory; a text is never cut, so one
very long text is a slice of its own.

What a row becomes depends on its id and the seed alone, so tasks that run again give the same.
Every row stands for itself: repeated rows get the same result each, and there is no shuffle.

* Null text counts as empty; an empty text stays as it is (form `plain`, no units).
* A null id is hashed as an empty one.
* A text that holds a marker stays plain, so that telling back finds the markers that were put in.
* `restore` of null is null, and so is that of a text that lacks the markers of its form.
* Columns go in and a column comes out, so no name of the table can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.llm.batches import by_slices
from lavra.llm.common import share_code

# The markers before each part, and what words are made of.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
INK = r"[^\x20\x09-\x0D]+"

KIND = pa.struct(
    [
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output", pa.string()),
    ]
)


@dataclass(frozen=True)
class Infilling:
    """Of 100 texts `rate_pct` are cut, and of 100 of these `suffix_first_pct` begin with the suffix."""

    rate_pct: int = 50
    suffix_first_pct: int = 80
    seed: int = 42


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)


def unit_lists(texts: pa.Array) -> pa.ListArray:
    """The units of every text; together they are the text."""
    blanks = pc.split_pattern_regex(texts, INK)  # one before each word and one at the end
    words = pc.list_flatten(pc.ascii_split_whitespace(texts))  # that class exactly
    words = pc.filter(words, pc.not_equal(words, ""))
    rows = pc.list_parent_indices(blanks).to_numpy()
    last = np.append(rows[1:] != rows[:-1], True) if len(rows) else np.zeros(0, bool)
    # the k-th blank stands before the k-th word, the last one of a row before none
    place = pa.array(np.cumsum(~last) - 1, pa.int64(), mask=last)
    joined = pc.binary_join_element_wise(
        pc.list_flatten(blanks), pc.take(words, place), "", null_handling="replace", null_replacement=""
    )
    real = pc.not_equal(joined, "").to_numpy(zero_copy_only=False)
    counts = np.bincount(rows[real], minlength=len(texts))
    return pa.ListArray.from_arrays(pa.array(_offsets(counts)), joined.filter(pa.array(real)))


def _remainder(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def cut_parts(units: pa.ListArray, low: pa.Array, high: pa.Array) -> list[pa.Array]:
    """The texts of prefix, middle and suffix, cut after `low` and `high` units."""
    flat, rows = pc.list_flatten(units), pc.list_parent_indices(units)
    starts = pa.array(np.asarray(units.offsets)[:-1], pa.int64())
    ordinal = pc.subtract(pa.array(np.arange(len(flat)), pa.int64()), pc.take(starts, rows))
    after = [pc.cast(pc.greater_equal(ordinal, pc.take(bound, rows)), pa.int8()) for bound in (low, high)]
    role = pc.add(*after)
    bounds = [pa.scalar(0, pa.int64()), low, high, pc.cast(pc.list_value_length(units), pa.int64())]
    parts = []
    for k in range(3):
        counts = np.broadcast_to(pc.subtract(bounds[k + 1], bounds[k]).to_numpy(zero_copy_only=False), len(units))
        lists = pa.ListArray.from_arrays(pa.array(_offsets(counts)), pc.filter(flat, pc.equal(role, k)))
        parts.append(pc.binary_join(lists, ""))
    return parts


def infilled(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array, plan: Infilling) -> pa.Array:
    """A struct per text: units, form, lengths of prefix and middle, and the text as told."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    units = unit_lists(texts)
    n = pc.cast(pc.list_value_length(units), pa.int64())
    a, b = (_remainder(h, pc.add(n, 1)) for h in (h1, h2))
    prefix, middle, suffix = cut_parts(units, pc.min_element_wise(a, b), pc.max_element_wise(a, b))
    marked = pc.or_(pc.or_(*(pc.match_substring(texts, m) for m in (PREFIX, SUFFIX))), pc.match_substring(texts, MIDDLE))
    kept = pc.greater_equal(_remainder(h3, pa.scalar(100, pa.int64())), plan.rate_pct)
    plain = pc.or_(pc.or_(pc.equal(texts, ""), marked), kept)
    suffix_first = pc.less(_remainder(h4, pa.scalar(100, pa.int64())), plan.suffix_first_pct)
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    none = pa.scalar(None, pa.int64())
    columns = [
        n,
        pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm")),
        pc.if_else(plain, none, pc.cast(pc.utf8_length(prefix), pa.int64())),
        pc.if_else(plain, none, pc.cast(pc.utf8_length(middle), pa.int64())),
        pc.if_else(plain, texts, pc.if_else(suffix_first, spm, psm)),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(KIND))


def told_back(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts that were told in the given forms."""
    outputs = outputs.cast(pa.string())
    told, rows = [], []
    for form, first, second in (("plain", "", ""), ("psm", PREFIX, SUFFIX), ("spm", SUFFIX, PREFIX)):
        of_form = pc.indices_nonzero(pc.fill_null(pc.equal(forms, form), False))
        rows.append(of_form.to_numpy())
        whole = pc.take(outputs, of_form)
        if form != "plain":
            parts = pc.extract_regex(whole, rf"(?s)\A{first}(?P<a>.*?){second}(?P<b>.*?){MIDDLE}(?P<m>.*)\z")
            a, b, m = (pc.struct_field(parts, name) for name in ("a", "b", "m"))
            whole = pc.binary_join_element_wise(*((a, m, b) if form == "psm" else (b, m, a)), "")
        told.append(whole)
    order = np.concatenate(rows).astype(np.int64)
    place = np.full(len(outputs), -1)
    place[order] = np.arange(len(order))
    return pc.take(pa.concat_arrays(told), pa.array(place, pa.int64(), mask=place < 0))


def fill_in_middle(key: Column, text: Column, plan: Infilling | None = None) -> Column:
    """Per text a struct of n, form, prefix_chars, middle_chars and output."""
    share_code()
    plan = plan or Infilling()
    digest = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]

    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def told(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        return by_slices(lambda *columns: infilled(*columns, plan), KIND, texts, h1, h2, h3, h4)

    return told(text, *hashes)


def restore(output: Column, form: Column) -> Column:
    """The text that `fill_in_middle` told in a form."""
    share_code()

    @F.arrow_udf("string")
    def text(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return by_slices(told_back, pa.string(), outputs, forms)

    return text(output, form)
