"""Table writes that report how many rows they wrote."""

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postledger.schemas import Table


def write_table(df: DataFrame, model_dir: str, table: Table, also: Sequence[str] = ()) -> int:
    """Replace one table whole, in its declared columns and those of ``also``; the number of rows written.

    Rows are counted while they are written. A partitioned table is first rebalanced by
    its partition column: each date ends up in few files of good size, and adaptive
    execution splits a date that is larger than the others.
    """
    counted = Observation(f"{table.name}-{uuid4().hex}")
    rows = df.select(*table.columns, *also)
    if table.partition_by:
        rows = rows.hint("rebalance", *table.partition_by)
    writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    writer.partitionBy(*table.partition_by).parquet(f"{model_dir}/{table.name}")
    return counted.get["rows"]


def write_together(writes: Mapping[str, Callable[[], int]], spark: SparkSession) -> dict[str, int]:
    """Run writes that do not wait for each other at the same time; the rows of each.

    A small table then fills what a large one leaves idle at its end. The first failure is
    raised once all have ended.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(writes))) as threads:
        started = {name: threads.submit(inheritable_thread_target(spark)(write)) for name, write in writes.items()}
    return {name: write.result() for name, write in started.items()}


def replace_partition(df: DataFrame, table_dir: str, column: str, value: str) -> int:
    """Replace the rows of one partition, and of no other, by ``df``; the rows written.

    A partition that ``df`` has rows for is swapped when the write commits, so a failed
    write leaves the old one. One that it has none for is emptied.
    """
    counted = Observation(f"{column}-{uuid4().hex}")
    rows = df.filter(F.col(column) == F.lit(value).cast(df.schema[column].dataType))
    (
        rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(table_dir)
    )
    written = counted.get["rows"]
    if not written:
        empty_partition(df.sparkSession, df.schema, table_dir, column, value)
    return written


def empty_partition(
    spark: SparkSession, schema: StructType, table_dir: str, column: str, value: str, storage: str = "parquet"
) -> None:
    """Leave one partition without rows; a dynamic overwrite never removes anything."""
    nothing = spark.createDataFrame([], schema).drop(column)
    nothing.write.mode("overwrite").format(storage).save(f"{table_dir}/{column}={value}")
