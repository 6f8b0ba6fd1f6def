"""Salary figures as doubles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.fixed_values import AMOUNT_PATTERN
from postledger.functions.text import strip_blanks


def amount(raw: Column) -> Column:
    """The figure in ``raw``, NULL when it states none. Never zero in place of missing.

    The cast alone would take "1d" and hexadecimal figures, so the shape is checked first.
    """
    text = strip_blanks(raw)
    figure = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    return F.when(
        text.rlike(AMOUNT_PATTERN) & (F.abs(figure) < float("inf")), figure
    )


def with_amounts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add one figure per entry of ``columns``, which maps new names to text columns."""
    return df.withColumns({new: amount(F.col(old)) for new, old in columns.items()})
