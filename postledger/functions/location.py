"""Location strings to city, province and country."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.fixed_values import (
    BLANK_CLASS,
    COUNTRY_BY_TOKEN,
    COUNTRY_NAME,
    KEY_SEPARATOR,
    POSTAL_CODE_PATTERN,
    PROVINCES,
    REMOTE,
    STATES,
    UNRESOLVED_PREFIX,
)
from postledger.functions.text import fold_case, lookup, one_of, strip_blanks

LOCATION_COLUMNS = (
    "location_key", "city", "province_code", "province", "country_code", "country", "resolved",
)

_REGION_NAME = PROVINCES | STATES
_REGION_BY_NAME = {name.upper(): code for code, name in _REGION_NAME.items()}

_COMMAS = f",[{BLANK_CLASS},]*"
# The look-behind lets a match start only where a run of blanks starts, so that a long
# run costs no more than its length.
_BLANKS_AND_COMMA = f"(?<![{BLANK_CLASS}])[{BLANK_CLASS}]*+,"


def _last(tokens: Column) -> Column:
    return strip_blanks(F.substring_index(tokens, ",", -1))


def _all_but_last(tokens: Column) -> Column:
    last = F.substring_index(tokens, ",", -1)
    return F.left(tokens, F.char_length(tokens) - F.char_length(last) - 1)


def _joined(tokens: Column) -> Column:
    """Tokens as one text; most places are one token and need no pattern."""
    several = F.regexp_replace(tokens, _BLANKS_AND_COMMA, ", ")
    return strip_blanks(F.when(F.contains(tokens, F.lit(",")), several).otherwise(tokens))


def with_location(df: DataFrame, source: str = "location") -> DataFrame:
    """Add :data:`LOCATION_COLUMNS` for the text in ``source``.

    Read from the right, the only end with a steady meaning. "CA" is Canada as the last
    token and California before a country. A province that contradicts the country leaves
    the whole text unresolved, keyed by the text itself.

    Each step is a projection over the one before it. The token list stays one string with
    single commas between tokens, so every step compiles to plain string code.
    """
    steps = df.withColumn("_text", strip_blanks(F.coalesce(F.col(source), F.lit(""))))
    steps = steps.withColumn(
        "_tokens", F.btrim(F.regexp_replace("_text", _COMMAS, ","), F.lit(","))
    )
    steps = steps.withColumn("_end", F.upper(_last(F.col("_tokens"))))
    steps = steps.withColumns({
        "_said": lookup(COUNTRY_BY_TOKEN, F.col("_end")),
        "_postal": F.col("_end").rlike(POSTAL_CODE_PATTERN),
    })
    steps = steps.withColumn(
        "_rest",
        F.when(F.col("_said").isNotNull() | F.col("_postal"), _all_but_last(F.col("_tokens")))
        .otherwise(F.col("_tokens")),
    )
    steps = steps.withColumn("_token", F.upper(_last(F.col("_rest"))))
    steps = steps.withColumn(
        "_region",
        F.when(one_of("_token", _REGION_NAME), F.col("_token"))
        .when(one_of("_token", _REGION_BY_NAME), lookup(_REGION_BY_NAME, F.col("_token"))),
    )
    steps = steps.withColumn(
        "_implied",
        F.when(one_of("_region", PROVINCES), F.lit("CA"))
        .when(F.col("_region").isNotNull(), F.lit("US")),
    )
    steps = steps.withColumn(
        "country_code",
        F.when(
            F.coalesce(F.col("_said") == F.col("_implied"), F.lit(True)),
            F.coalesce("_said", "_implied"),
        ),
    )
    known = F.col("country_code").isNotNull()
    place = F.when(F.col("_region").isNotNull(), _all_but_last(F.col("_rest"))).otherwise(F.col("_rest"))
    steps = steps.withColumns({
        "resolved": known,
        "province_code": F.when(known, F.col("_region")),
        "_place": F.when(known, F.nullif(_joined(place), F.lit(""))),
    })
    steps = steps.withColumns({
        "city": F.when(F.lower("_place") != REMOTE, F.col("_place")),
        "province": lookup(_REGION_NAME, F.col("province_code")),
        "country": lookup(COUNTRY_NAME, F.col("country_code")),
    })
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("city", "province_code", "country_code")]
    key = F.when(F.col("resolved"), fold_case(F.concat_ws(KEY_SEPARATOR, *parts))).otherwise(
        F.concat(F.lit(UNRESOLVED_PREFIX), fold_case(F.col("_text")))
    )
    steps = steps.withColumn("location_key", key)
    return steps.select(*df.columns, *LOCATION_COLUMNS)
