"""What a calendar says about a date."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How each column of a calendar reads off its date, in Spark SQL.
_READINGS = {
    "date_key": "CAST({0} AS string)",
    "date": "{0}",
    "year": "extract(YEAR FROM {0})",
    "month": "extract(MONTH FROM {0})",
    "day": "extract(DAY FROM {0})",
    "day_name": "date_format({0}, 'EEEE')",
    "iso_week": "extract(WEEK FROM {0})",
    "is_weekend": "weekday({0}) >= 5",
}


def calendar_of(dates: DataFrame, schema: StructType, column: str = "date") -> DataFrame:
    """For each row of ``dates`` the columns that ``schema`` declares, in its order and types."""
    return dates.select(*[
        F.expr(_READINGS[field.name].format(f"`{column}`")).cast(field.dataType).alias(field.name) for field in schema.fields
    ])
