"""Tables of a built model."""

from pyspark.sql import DataFrame, SparkSession

from postledger.schemas import ALL_TABLES, Table


def read_table(spark: SparkSession, model_dir: str, table: Table) -> DataFrame:
    """One table in its declared columns and order; fails when one of them is missing."""
    return spark.read.parquet(f"{model_dir}/{table.name}").select(*table.columns)


def read_model(spark: SparkSession, model_dir: str) -> dict[str, DataFrame]:
    """All six tables by name."""
    return {table.name: read_table(spark, model_dir, table) for table in ALL_TABLES}
