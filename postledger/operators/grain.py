"""Bring a table to a declared grain."""

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What ends a text among packed ones. It sorts before all that a packed text holds.
_END = "\0"


def packed(texts: Sequence[str]) -> Column:
    """Columns of text as one, which sorts as they do one behind the other; NULLs sort first."""
    cells = []
    for name in texts:
        # The two characters that sort first are written as two each, in the order that they have.
        plain = F.replace(F.replace(F.col(name), F.lit("\1"), F.lit("\1\2")), F.lit(_END), F.lit("\1\1"))
        cells.append(F.coalesce(F.concat(F.lit("+"), plain), F.lit("")))
    return F.concat_ws(_END, *cells)


def unpacked(text: Column) -> Column:
    """The texts as they were before they were packed, as an array."""

    def plain(cell: Column) -> Column:
        return F.replace(F.replace(cell, F.lit("\1\1"), F.lit(_END)), F.lit("\1\2"), F.lit("\1"))

    def kept(cell: Column) -> Column:
        return F.when(cell != "", plain(F.substring(cell, 2, 2**31 - 1)))

    return F.transform(F.split(text, _END), kept)


def smallest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the one that sorts first by ``order``, then by all other columns.

    The order is total, so every run keeps the same row. An aggregate rather than a ranking
    window: each task keeps one candidate per key before the shuffle, so a key that holds
    a third of the table sends one row per task, and no group is ever gathered whole.
    NULL keys form a group, NULLs sort first. The hash in front of the keys lets the sort
    around the aggregate compare one number for most pairs of rows, where keys that start
    alike, as URLs do, would be compared in full. Texts that stand side by side are sorted,
    shuffled and compared as one, without the room that each column of a row takes.
    """
    ranked = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    cells, found, arrays = [], {}, {}
    for is_text, run in groupby(ranked, lambda c: df.schema[c].dataType == StringType()):
        names = list(run)
        if is_text and len(names) > 1:
            cell = f"_packed_{len(cells)}"
            found |= {c: F.get(cell, F.lit(place)) for place, c in enumerate(names)}
            arrays[cell] = unpacked(F.col("_kept")[cell])
            cells.append(packed(names).alias(cell))
        else:
            found |= {c: F.col("_kept")[c] for c in names}
            cells += [F.col(c) for c in names]
    kept = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.min(F.struct(*cells)).alias("_kept"))
    return kept.withColumns(arrays).select(*[c if c in keys else found[c].alias(c) for c in df.columns])
