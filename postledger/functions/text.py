"""Text helpers shared by the conforming rules."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postledger.fixed_values import BLANKS


def strip_blanks(text: Column) -> Column:
    """Strip every Unicode blank from both ends (``trim`` alone strips U+0020 only)."""
    return F.btrim(text, F.lit(BLANKS))


def fold_case(text: Column) -> Column:
    """Lower case for comparing: sharp s, final sigma and long s count as their plain forms."""
    lowered = F.replace(F.lower(text), F.lit("\u00df"), F.lit("ss"))
    return F.translate(lowered, "\u03c2\u017f", "\u03c3s")


def lookup(table: dict[str, str], token: Column) -> Column:
    """Value of ``token`` in a small constant table, NULL when it is not there."""
    pairs = ", ".join(f"'{part}'" for entry in table.items() for part in entry)
    return F.expr(f"map({pairs})")[token]


def one_of(name: str, values: Iterable[str]) -> Column:
    """Whether the column ``name`` holds one of ``values``; many are looked up in a hash set."""
    return F.expr(f"{name} IN ({', '.join(f"'{value}'" for value in values)})")
