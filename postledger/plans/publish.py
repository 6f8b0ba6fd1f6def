"""Publish a model: as a whole, or one ingest date of it.

A publication root holds a directory per published version and a log with an entry per
version. An entry names the directory with the tables, and what was written since: for each
date that was swapped the directory with its observations, for a table that was replaced the
directory that counts, and for a table that was changed the directories of its change sets,
which readers apply in order. Entries are never changed, a number is given out once, and
readers follow the last one: they see the old model or the new one, never a mix.

Numbers are kept apart by creating a file only where there is none, which HDFS and local disks
do in one step. A store without that, as some object stores are, needs one publisher at a time.
"""

import json
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from postledger.operators.changes import GONE, applied
from postledger.operators.contracts import require_contracts
from postledger.plans.build import build_with_state
from postledger.plans.write import replace_partition
from postledger.schemas import ALL_TABLES, DIMENSIONS, FACT_OBSERVATION, FACTS, Table
from postledger.sources.model import read_model, read_table
from postledger.storage import create_file, path_exists

# ``following``: postings, dimensions and what is kept beside them follow from the observations.
_LOG = (
    "version long, directory string, swapped array<struct<ingest_date string, directory string>>, "
    "replaced map<string, string>, changes map<string, array<string>>, following boolean"
)


def _last_entry(spark: SparkSession, root: str, version: int | None = None) -> Row | None:
    if not path_exists(spark, f"{root}/versions_log"):
        return None
    # An entry that is being written reads as NULL.
    log = spark.read.schema(_LOG).json(f"{root}/versions_log").filter("version IS NOT NULL")
    if version is not None:
        log = log.filter(F.col("version") == version)
    return log.orderBy(F.desc("version")).first()


def entry_of(last: Row) -> dict:
    """What an entry says but for its number, to be changed for the next one."""
    said = last.asDict(recursive=True)
    return {
        "directory": last.directory,
        "swapped": said["swapped"] or [],
        "replaced": said["replaced"] or {},
        "changes": said["changes"] or {},
        "following": bool(last.following),
    }


def _publish(spark: SparkSession, root: str, entry: Callable[[Row | None], dict]) -> None:
    """Log the entry that ``entry`` makes of the last one, under the number behind it.

    Where another publication took the number, the entry is made again of that one.
    """
    while True:
        last = _last_entry(spark, root)
        version = last.version + 1 if last else 1
        line = json.dumps({"version": version, **entry(last)})
        if create_file(spark, f"{root}/versions_log/{version:012}.json", line + "\n"):
            return


def published_dir(spark: SparkSession, root: str) -> str | None:
    """Directory of the tables that are published under ``root``, None before the first.

    Dates that were swapped since are elsewhere; ``read_published`` follows these, too.
    """
    last = _last_entry(spark, root)
    return f"{root}/{last.directory}" if last else None


def read_published(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The six published tables by name, those of the last version or of an earlier one."""
    last = _last_entry(spark, root, version)
    if last is None:
        raise ValueError(f"nothing published under {root}" + (f" as version {version}" if version is not None else ""))
    return read_entry(spark, root, entry_of(last))


def read_entry(spark: SparkSession, root: str, entry: dict) -> dict[str, DataFrame]:
    """The tables that a log entry names."""
    tables = {table.name: read_table(spark, table_root(root, entry, table), table) for table in ALL_TABLES}
    fact = FACT_OBSERVATION
    swapped = with_swaps(tables[fact.name], entry, lambda directory: read_table(spark, f"{root}/{directory}", fact))
    tables[fact.name] = swapped
    for table in ALL_TABLES:
        if entry["changes"].get(table.name):
            tables[table.name] = applied(tables[table.name], read_changes(spark, root, entry, table), table.key)
    return tables


def table_root(root: str, entry: dict, table: Table) -> str:
    """The directory in which a table of an entry lies, without what was changed or swapped."""
    return f"{root}/{entry['replaced'].get(table.name, entry['directory'])}"


def changes_dir(directory: str, table: Table) -> str:
    """Where ``directory`` keeps a change set of a table."""
    return f"{directory}/_changes_{table.name}"


def read_changes(spark: SparkSession, root: str, entry: dict, table: Table, also: Sequence[str] = ()) -> list[DataFrame]:
    """The change sets of a table, in the order in which they apply."""
    sets = entry["changes"].get(table.name, [])
    return [spark.read.parquet(changes_dir(f"{root}/{d}", table)).select(*table.columns, *also, GONE) for d in sets]


def with_swaps(base: DataFrame, entry: dict, read: Callable[[str], DataFrame]) -> DataFrame:
    """``base``, whose partitions are dates, with swapped dates from where they lie now.

    Dates that share a directory are one branch of the union, so after a compaction there is
    one branch however many dates were swapped.
    """
    if not entry["swapped"]:
        return base
    day = F.col("ingest_date")
    held: dict[str, list[str]] = {}
    for swap in entry["swapped"]:
        if swap["directory"]:
            held.setdefault(swap["directory"], []).append(swap["ingest_date"])
    parts = [base.filter(~day.isin(*dates_of(s["ingest_date"] for s in entry["swapped"])))]
    parts += [read(directory).filter(day.isin(*dates_of(dates))) for directory, dates in held.items()]
    return reduce(DataFrame.unionByName, parts)


def dates_of(dates: Iterable[str]) -> list[Column]:
    return [F.lit(date).cast("date") for date in dates]


def publish_full(spark: SparkSession, landed: DataFrame, root: str) -> dict[str, int]:
    """Replace everything published under ``root`` by the model of ``landed``; the rows of each table.

    The model is built where it will be read. It counts once all its contracts hold; until
    then, or when one is broken, readers keep the version before.
    """
    directory = f"version-{uuid4().hex}"
    counts = build_with_state(landed, f"{root}/{directory}")
    require_contracts(read_model(spark, f"{root}/{directory}"))
    _publish(spark, root, lambda last: {"directory": directory, "swapped": [], "replaced": {}, "changes": {}, "following": True})
    return counts


def publish_partition(
    spark: SparkSession, model_dir: str, root: str, ingest_date: str
) -> dict[str, int]:
    """Replace one ingest date of the published observations by that of a model, and nothing else.

    Only that date is read and written. The new version shares all else with the one before.
    Publishing a date twice is the same as once. Its rows must keep the contracts with the
    dimensions already published, which a full publication before it sees to. Postings and
    dimensions stay as they are; ``publish_date`` brings them up to date, too.
    """
    if published_dir(spark, root) is None:
        raise ValueError(f"nothing published under {root}")
    fact, directory = FACT_OBSERVATION, f"date-{uuid4().hex}"
    rows = read_table(spark, model_dir, fact).filter(F.col("ingest_date") == F.lit(ingest_date).cast("date"))
    written = replace_partition(rows, f"{root}/{directory}/{fact.name}", "ingest_date", ingest_date)

    def entry(last: Row) -> dict:
        if written:
            staged = read_table(spark, f"{root}/{directory}", fact)
            present = read_entry(spark, root, entry_of(last))
            dimensions = {table.name: present[table.name] for table in DIMENSIONS}
            require_contracts({fact.name: staged, **dimensions}, checked=[fact])
        return swapped_entry(last, ingest_date, directory if written else None) | {"following": False}

    _publish(spark, root, entry)
    return {fact.name: written}


def swapped_entry(last: Row, ingest_date: str, directory: str | None) -> dict:
    """The entry behind ``last`` with one more date swapped."""
    entry = entry_of(last)
    if entry["changes"].get(FACT_OBSERVATION.name):
        raise ValueError("observations have change sets; compact them before a date is swapped")
    others = [swap for swap in entry["swapped"] if swap["ingest_date"] != ingest_date]
    return entry | {"swapped": [*others, {"ingest_date": ingest_date, "directory": directory}]}


def create_catalog(spark: SparkSession, model_dir: str, database: str) -> None:
    """Declare the tables of ``model_dir``, comments and partitions included; safe to repeat."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table in ALL_TABLES:
        spark.sql(_declaration(table, model_dir, database))
        if table.partition_by:
            spark.sql(f"MSCK REPAIR TABLE `{database}`.`{table.name}` SYNC PARTITIONS")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _declaration(table: Table, model_dir: str, database: str) -> str:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {_quoted(f.metadata['comment'])}" if f.metadata else "")
        for f in table.schema.fields
    )
    parts = f" PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    return (
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table.name}` ({columns}) USING parquet{parts}"
        f" LOCATION {_quoted(f'{model_dir}/{table.name}')} COMMENT {_quoted(table.comment)}"
    )


def refresh_statistics(spark: SparkSession, database: str) -> None:
    """Give the optimizer fresh statistics of both facts."""
    for table in FACTS:
        spark.sql(f"ANALYZE TABLE `{database}`.`{table.name}` COMPUTE STATISTICS FOR ALL COLUMNS")
