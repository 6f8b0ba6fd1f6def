"""Landed partitions, read by declared field and never by inference."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from postledger.schemas import LANDED
from postledger.storage import path_exists


# What Spark calls the JSON files that landing writes.
JSON_FILES = "part-*.json.gz"


def landed_fields(line: Column) -> Column:
    """The declared fields of a JSON line; a field it lacks, or a broken line, gives NULLs."""
    return F.from_json(line, LANDED)


def _require_path(spark: SparkSession, landing_dir: str) -> None:
    if not path_exists(spark, landing_dir):
        raise ValueError(f"no landed partitions under {landing_dir}")


def _require_rows(df: DataFrame, landing_dir: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no landed partitions under {landing_dir}")
    return df


def read_landed(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Every landed row in the declared fields; a field that was not landed is NULL.

    Only the declared columns are read, and of those only what a query uses.
    """
    stored = [f for f in LANDED.fields if f.name != "_ingest_date"]
    schema = StructType([*stored, StructField("ingest_date", DateType())])
    _require_path(spark, landing_dir)
    rows = spark.read.schema(schema).parquet(landing_dir).select(
        *[F.col("ingest_date").cast("string").alias(c) if c == "_ingest_date" else c for c in LANDED.names]
    )
    return _require_rows(rows, landing_dir)


def read_landed_json(
    spark: SparkSession, landing_dir: str, pattern: str = JSON_FILES
) -> DataFrame:
    """Landed rows kept as JSON lines in files named by ``pattern``, in the declared fields.

    The pattern is that of the files which landing writes, if none is given.

    A line that is no JSON is kept, as a row of NULLs.
    """
    _require_path(spark, landing_dir)
    lines = spark.read.option("pathGlobFilter", pattern).text(landing_dir)
    return _require_rows(lines.select(landed_fields(F.col("value")).alias("row")).select("row.*"), landing_dir)
