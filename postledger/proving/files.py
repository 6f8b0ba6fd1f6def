"""Write rows as the CSV files a scraper would have left."""

from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv_cell(cell: Column) -> Column:
    """A value as a cell of a CSV line, quoted where it must be; NULL is an empty cell."""
    text = F.coalesce(cell.cast("string"), F.lit(""))
    doubled = F.replace(text, F.lit('"'), F.lit('""'))
    special = reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in '",\r\n'])
    return F.when(special, F.concat(F.lit('"'), doubled, F.lit('"'))).otherwise(text)


def csv_line(*cells: Column) -> Column:
    """Values as one CSV line."""
    return F.concat_ws(",", *map(csv_cell, cells))


def write_scrapes(rows: DataFrame, lines_of: Callable[[DataFrame], DataFrame], header: Column, directory: str, target: str | None = None) -> None:
    """Write ``rows`` as CSV files to ``target``, by way of ``directory``; ``lines_of`` adds to each row its ``file`` and its ``line``.

    ``header``, an expression over ``file``, gives the first line of each file. Rows are shuffled
    and sorted as they are given and only then made into lines, which are far longer. Spark names
    the files it writes itself, so they are written under one directory per name and renamed.
    Where no ``target`` is named it is a folder of ``directory``.
    """
    spark = rows.sparkSession
    names = lines_of(rows).select(F.col("file").alias("_name")).distinct()
    every = rows.withColumn("_rank", F.lit(1)).unionByName(names.withColumn("_rank", F.lit(0)), allowMissingColumns=True)
    # A hash of the file's name is shuffled, and the name made once more behind it.
    name = F.coalesce("_name", "file")
    dealt = lines_of(every).select(*every.columns, F.xxhash64(name).alias("_hash"))
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_hash")
    # Never NULL, so that the writer takes the order as it is. This is what it calls files without a name.
    whole = F.coalesce(F.nullif(name, F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    ordered = lines_of(dealt).select(*every.columns, whole.alias("_file")).sortWithinPartitions("_file", "_rank")
    lines = lines_of(ordered).drop("file").withColumnRenamed("_file", "file")
    staged = f"{directory}/staged"
    (
        lines.select("file", F.when(F.col("_rank") == 0, header).otherwise(F.col("line")).alias("line"))
        .write.partitionBy("file").text(staged)
    )
    _take_names(spark, staged, target or f"{directory}/scrapes")


def _take_names(spark, staged: str, directory: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(staged)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(directory))
    for group in files.listStatus(root):
        name = group.getPath().getName()
        if not name.startswith("file="):
            continue
        parts = [s.getPath() for s in files.listStatus(group.getPath()) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"{name} was written in {len(parts)} parts")
        files.rename(parts[0], hadoop.Path(f"{directory}/{unquote(name.removeprefix('file='))}"))


def header_of(columns: Sequence[str]) -> Column:
    """A header line."""
    return F.lit(",".join(columns))


def _listed(spark, directory: str):
    """The file system of a directory, and what lies right in it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, [status.getPath() for status in files.listStatus(root)]


def remove_files(spark, directory: str, chosen) -> None:
    """Remove the files of a directory whose names are ``chosen``."""
    files, paths = _listed(spark, directory)
    for path in paths:
        if chosen(path.getName()):
            files.delete(path, False)


def replace_files(spark, source: str, target: str, chosen) -> None:
    """Move the files of ``source`` whose names are ``chosen`` to ``target``, in place of those there."""
    remove_files(spark, target, chosen)
    files, paths = _listed(spark, source)
    for path in paths:
        if chosen(path.getName()):
            files.rename(path, spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{path.getName()}"))
