"""Exact dedup: a two-pass Bloom filter tells which rows may have an equal, and only those shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import (
    ROW,
    ascii_lower,
    column,
    join_counted,
    nested,
    restored,
    text_of,
)
from voxtable.sources.tables import materialize

BLOCK_BITS = 32_768  # bits of one ``bitmap_construct_agg`` bitmap, 4 KiB


def repeat_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """First pass: the Bloom filter of positions that were hit more than once.

    ``hashes`` has one bigint column ``hash``, repeats included. The filter has one row
    ``(block, bitmap)`` for each block of 32,768 bits with a bit set, ``bits / 8`` bytes at most.
    A hash sets two positions of one block. A hash that occurs twice has hit both of them twice; a
    hash that occurs once passes only if other hashes of its block happen to share both.
    """
    block, first, second = _positions(F.col("hash"), bits)
    hits = hashes.select(
        block.alias("block"), F.explode(F.array_distinct(F.array(first, second))).alias("bit")
    )
    again = hits.groupBy("block", "bit").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return again.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bitmap"))


def _positions(hash_: Column, bits: int) -> tuple[Column, Column, Column]:
    """Block and two bits in it, from different bits of the 64-bit hash."""
    block = F.pmod(F.shiftrightunsigned(hash_, 32), F.lit(bits // BLOCK_BITS))
    low = hash_.bitwiseAND(F.lit(BLOCK_BITS - 1))
    high = F.shiftrightunsigned(hash_, 16).bitwiseAND(F.lit(BLOCK_BITS - 1))
    return block, low, high


def _is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set; false for no bitmap."""
    byte = F.substring(bitmap, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    mask = F.pow(F.lit(2), F.pmod(bit, F.lit(8))).cast("int")
    return F.coalesce(value.bitwiseAND(mask) != 0, F.lit(False))


def filter_bits(rows: int, bits_per_row: int) -> int:
    """Bits of the filter: a power of two, one block at least and as many as there are places for."""
    wanted = max(BLOCK_BITS, rows * bits_per_row)
    return min(1 << (wanted - 1).bit_length(), BLOCK_BITS << 31)


def _grouped(
    df: DataFrame,
    id_col: str,
    text_col: str,
    columns: list[str],
    bits_per_row: int,
    max_filter_bytes: int,
) -> DataFrame:
    """Rows as ``(row, sha, keep_id, n, kept)``."""
    digest = F.sha2(ascii_lower(text_of(text_col)), 256)
    place = F.monotonically_increasing_id()  # stored, so it never changes
    stored = materialize(nested(df, columns, id=column(id_col), sha=digest, place=place))
    total = stored.count()
    bits = filter_bits(total, bits_per_row)
    hash_ = F.xxhash64("sha")
    found = repeat_filter(stored.select(hash_.alias("hash")), bits)

    block, first, second = _positions(hash_, bits)
    # A block's bitmap is one row, so rows of a hot block can be dealt to several tasks.
    found = F.broadcast(found) if bits <= 8 * max_filter_bytes else found.hint("merge")
    tested = stored.withColumn("block", block).join(found, "block", "left")
    maybe = _is_set(F.col("bitmap"), first) & _is_set(F.col("bitmap"), second)
    tested = tested.withColumn("maybe", maybe).drop("block", "bitmap")

    one, keep = F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept")
    alone = tested.where("not maybe").select(ROW, "sha", F.col("id").alias("keep_id"), one, keep)
    repeated = materialize(tested.where("maybe").drop("maybe"))
    best = F.max(F.struct("id", (-F.col("place")).alias("order"))).alias("best")
    groups = materialize(repeated.groupBy("sha").agg(F.count("*").alias("n"), best))
    joined = join_counted(repeated, groups, "sha", "n", total)
    stays = (F.col("place") == -F.col("best.order")).alias("kept")
    return alone.unionByName(
        joined.select(ROW, "sha", F.col("best.id").alias("keep_id"), "n", stays)
    )


def mark_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    bits_per_row: int = 16,
    max_filter_bytes: int = 256 << 20,
) -> DataFrame:
    """Every row with its group of equal texts and whether it is the one that stays.

    Texts are equal when identical after lower-casing A-Z; a null text equals the empty one. Of
    equal texts the row with the largest id stays; null ids are smaller than any other. Rows that
    repeat id and text are rows of a group like any other, and one of them stays. An empty table
    gives an empty table.

    Returns the columns named in ``carry`` (all by default) followed by ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256``; an input column of such a name gives way.

    The carried columns are stored once with the digest of the text, which is read only once. The
    filter takes ``bits_per_row`` bits for each row. Up to ``max_filter_bytes`` it is broadcast, and
    rows that it rejects have no equal and are neither shuffled nor grouped; a larger one is joined
    block by block, for which all rows are shuffled once, and those that it rejects are not grouped.
    """
    columns = df.columns if carry is None else carry
    return restored(
        _grouped(df, id_col, text_col, columns, bits_per_row, max_filter_bytes),
        columns,
        keep_id=F.col("keep_id"),
        group_size=F.col("n"),
        kept=F.col("kept"),
        text_sha256=F.col("sha"),
    )


def drop_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 16,
    max_filter_bytes: int = 256 << 20,
) -> DataFrame:
    """The rows that ``mark_duplicates`` keeps, with exactly the columns of the input."""
    rows = _grouped(df, id_col, text_col, df.columns, bits_per_row, max_filter_bytes)
    return restored(rows.where("kept"), df.columns)
