"""Key uniqueness without gathering a key's rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.operators.keys import ROW_ID, left_lookup, semi, with_row_id
from lavra.session import stage

# Bits of a position that number a file's rows.
_ROW_BITS = 40
# Rows of a file whose marks lie in one row, 64 to a word: 2 KB.
_WORDS = 256
# Rows of marks that go to every task: 64 MB, for some 500 million rows.
MOST_MARKS = 1 << 15


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count.

    Counted before the shuffle, so a hot key moves one row per input task.
    """
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1").select(*keys, "copies")


def row_order(order_by: Sequence[str]) -> Column:
    """What rows are ordered by: `order_by`, then the input position."""
    return F.struct(*[F.col(c) for c in order_by], F.col(ROW_ID))


def first_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """For each repeated key, the order value of the row that comes first.

    All rows are only counted by key. The order is looked at for the rows of
    repeated keys alone, where a minimum is again taken before the shuffle.
    """
    narrow = df.select(*keys, row_order(order_by).alias("_order"))
    return semi(narrow, repeated_keys(df, keys), keys).groupBy(*keys).agg(F.min("_order").alias("_first"))


def _shifted(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits.cast("int"))


def first_marks(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), known: DataFrame | None = None
) -> DataFrame:
    """A bit per row position, set for the first row of each key that is not `known`: (_file, _block, _bits).

    Keys and order values move once, after a minimum before the shuffle; what comes out is an
    eighth of a byte per row, whatever the width of rows and keys and however many of these repeat.
    """
    own = df.select(*keys, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], F.col(ROW_ID).alias("_at"))
    # files by number, in the order of their names, so that a position is one long
    numbered = own.select(F.col("_at.file").alias("_file")).distinct()
    files = stage(numbered.withColumn("_no", F.row_number().over(W.orderBy("_file"))), "files")
    place = _shifted(F.col("_no").cast("long"), F.lit(_ROW_BITS)).bitwiseOR(F.col("_at.row"))
    order = F.struct(*[F.col(f"_o{i}") for i in range(len(order_by))], place.alias("place"))
    narrow = own.join(F.broadcast(files), F.col("_at.file") == F.col("_file")).select(*keys, order.alias("_order"))  # a row per file
    firsts = narrow.groupBy(*keys).agg(F.min("_order").alias("_first"))
    firsts = firsts if known is None else semi(firsts, known, keys, "left_anti")
    at = firsts.select(F.col("_first.place").alias("at"))
    word = F.shiftright(F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)), 6)
    words = (
        at.select(
            F.shiftright("at", _ROW_BITS).cast("int").alias("no"),
            F.floor(word / _WORDS).alias("_block"),
            (word % _WORDS).cast("int").alias("word"),
            _shifted(F.lit(1).cast("long"), F.col("at") % 64).alias("mask"),
        )
        .groupBy("no", "_block", "word")
        .agg(F.bit_or("mask").alias("mask"))
    )
    held = F.collect_list(F.struct("word", "mask"))  # at most _WORDS
    dense = F.transform(
        F.array(F.map_from_entries("held")),
        lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda w: F.coalesce(F.try_element_at(m, w), F.lit(0).cast("long"))
        ),
    )[0]
    blocks = words.groupBy("no", "_block").agg(held.alias("held")).select("no", "_block", dense.alias("_bits"))
    return blocks.join(F.broadcast(files), F.col("no") == F.col("_no")).select("_file", "_block", "_bits")


def flag_marked(df: DataFrame, marks: DataFrame, flag: str = "_repeat") -> DataFrame:
    """Mark every row that staged `marks` of first rows do not hold; rows of `df` do not move while the marks are few.

    Where they are many, the join is spread by blocks of rows, which are alike in size.
    """
    if marks.count() <= MOST_MARKS:
        marks = F.broadcast(marks)  # 2 KB each
    row = F.col(f"l.{ROW_ID}.row")
    word = F.shiftright(row, 6)
    here = (F.col(f"l.{ROW_ID}.file") == F.col("r._file")) & (F.floor(word / _WORDS) == F.col("r._block"))
    bit = _shifted(F.lit(1).cast("long"), row % 64).bitwiseAND(F.get("r._bits", (word % _WORDS).cast("int")))
    # a block without any first row has no marks
    later = F.coalesce(bit == 0, F.lit(True))
    return df.alias("l").join(marks.alias("r"), here, "left").select("l.*", later.alias(flag))


def flag_repeats(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    flag: str = "_repeat",
    marks: DataFrame | None = None,
) -> DataFrame:
    """Mark every row but the first of its key; null keys count as equal.

    Only repeated keys are joined back. Where few keys repeat they are small
    and no row of `df` moves; where many do, the join is spread by key and a
    hot key is split. Pass staged `first_marks` to run the marking more than once.
    """
    df = with_row_id(df)
    if marks is not None:
        return flag_marked(df, marks, flag)
    firsts = first_rows(df, keys, order_by)
    later = F.col("_first").isNotNull() & (row_order(order_by) != F.col("_first"))
    return (
        left_lookup(df, firsts, keys)
        .withColumn(flag, later)
        .drop("_first")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first."""
    return flag_repeats(df, keys, order_by).where("NOT _repeat").drop("_repeat", ROW_ID)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key repeats; none when no key column is present."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.where(F.lit(False))
    return semi(df, repeated_keys(df, present), present)
