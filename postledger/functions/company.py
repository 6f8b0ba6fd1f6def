"""Company strings to a grouping key and a display name."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.fixed_values import LEGAL_FORMS
from postledger.functions.text import strip_blanks

# Word edges are spelled out, since what \b means depends on the Java release.
_LEGAL_FORM = rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(LEGAL_FORMS)})(?![\p{{L}}\p{{N}}_])\.?"


def _letters_and_digits(text: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(text), "[^a-z0-9]+", ""), F.lit(""))


def with_company(
    df: DataFrame, source: str = "company", key: str = "company_key", name: str = "company_name"
) -> DataFrame:
    """Add the company key and the display name of ``source``.

    The name is the text as written, without outer blanks. The key leaves out legal
    forms, case and everything but ASCII letters and digits; a name made of legal forms
    alone keeps them. Country words stay in the key: a national entity is a company of
    its own.
    """
    named = df.withColumn(name, F.nullif(strip_blanks(F.col(source)), F.lit("")))
    without_forms = F.regexp_replace(F.col(name), _LEGAL_FORM, "")
    return named.withColumn(
        key, F.coalesce(_letters_and_digits(without_forms), _letters_and_digits(F.col(name)))
    )
