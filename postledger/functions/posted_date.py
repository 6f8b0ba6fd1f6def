"""Posted dates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.fixed_values import POSTED_DATE_PATTERN
from postledger.functions.text import strip_blanks


def posted_date(raw: Column) -> Column:
    """The ISO date ``raw`` starts with; NULL when it states none or one that cannot be.

    A time of day after the date is cut off, zone included, and converts nothing.
    """
    return F.regexp_extract(strip_blanks(raw), POSTED_DATE_PATTERN, 1).try_cast("date")


def with_posted_date(df: DataFrame, source: str = "date_posted", into: str = "date_posted") -> DataFrame:
    """Add the cleaned date of ``source`` as ``into``."""
    return df.withColumn(into, posted_date(F.col(source)))
