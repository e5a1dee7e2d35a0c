"""What the operators on documents share: rows kept whole, ASCII case folding, hot-key joins."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "row"
# What separates words: the space and the characters 0x09 to 0x0D.
WORD_BREAKS = " \t\n\x0b\x0c\r"


def nested(df: DataFrame, columns: list[str], **own: Column) -> DataFrame:
    """Columns of the input as one struct ``row`` beside an operator's own columns.

    Whatever the input's columns are called, they cannot clash with the operator's.
    """
    row = F.struct(*[column(c).alias(c) for c in columns]) if columns else F.struct(F.lit(0))
    return df.select(row.alias(ROW), *_aliased(own))


def restored(df: DataFrame, columns: list[str], **own: Column) -> DataFrame:
    """The input's columns again, followed by result columns.

    An input column with the name of a result column (in any case) gives way to it.
    """
    taken = {name.lower() for name in own}
    kept = [F.col(ROW).getField(c).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *_aliased(own))


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def column(name: str) -> Column:
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` is the cheap way for texts of ASCII alone, which have as many bytes as characters.
    """
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(lowered)


def join_counted(
    rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, share: int = 1000
) -> DataFrame:
    """Left join of ``rows`` to one row per ``key``, where a key may hold a third of the rows.

    ``groups`` has the number of rows of each key in ``size``; ``total`` is their sum. Fewer than
    ``share`` keys can have more than ``total / share`` rows. These go through a broadcast, whose
    size is thereby bounded, and no key of the shuffled rest has more than that share.
    Both inputs are read twice and should be stored tables.
    """
    is_hot = F.col(size) * share > F.lit(total)
    hot = F.broadcast(groups.where(is_hot))
    cold = groups.where(~is_hot)
    rest = rows.join(F.broadcast(groups.where(is_hot).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold, key, "left"))


def with_results(df: DataFrame, result: Column, names: list[str]) -> DataFrame:
    """The input's columns followed by the named fields of a struct column."""
    rows = nested(df, df.columns, result=result)
    return restored(rows, df.columns, **{n: F.col("result").getField(n) for n in names})
