"""Bring a publication up to date by what changed, writing nothing else.

One date: its observations are swapped, the postings that it touches follow by a change set, and
dimensions are made again of the day counts of their values. A whole model: each table follows by
the change set between what is published and what should be. Both are one entry of the log, so
readers see all of it or nothing. ``compact`` takes together what such entries leave behind.
"""

from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from postledger.operators.changes import GONE, applied, change_set, folded
from postledger.operators.contracts import require_contracts
from postledger.operators.dims import COUNTED, dimension_of
from postledger.operators.facts import SOURCES, build_observations, merge_postings, roll_up
from postledger.plans.build import read_counts, save_counts, write_counts
from postledger.plans.publish import (
    _publish,
    changes_dir,
    entry_of,
    published_dir,
    read_changes,
    read_entry,
    swapped_entry,
    table_root,
    with_swaps,
)
from postledger.plans.write import replace_partition, write_table, write_together
from postledger.schemas import ALL_TABLES, FACT_OBSERVATION, FACT_POSTING, Table
from postledger.sources.model import read_table

# Change sets of a table that readers fold; one more, and they are written as one.
MOST_CHANGE_SETS = 8


def _observed(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """All observations of an entry, dates pruned as far as the query does."""
    read = partial(read_table, spark, table=FACT_OBSERVATION)
    return with_swaps(read(table_root(root, entry, FACT_OBSERVATION)), entry, lambda d: read(f"{root}/{d}"))


def _rolled(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """The postings of an entry with the sites that had them."""
    base = spark.read.parquet(f"{table_root(root, entry, FACT_POSTING)}/{FACT_POSTING.name}").select(*FACT_POSTING.columns, SOURCES)
    return applied(base, read_changes(spark, root, entry, FACT_POSTING, also=[SOURCES]), FACT_POSTING.key)


def _kept(table: Table, entry: dict) -> list[str]:
    """Columns that are written of a table beside those its readers see."""
    return [SOURCES] if table == FACT_POSTING and entry["following"] else []


def _counts(spark: SparkSession, root: str, entry: dict, table: Table) -> DataFrame:
    """The day counts of a dimension."""

    def read(directory: str) -> DataFrame:
        return read_counts(spark, f"{root}/{directory}", table)

    return with_swaps(read(entry["directory"]), entry, read)


def posting_changes(before: DataFrame, now: DataFrame, observed: DataFrame, known: DataFrame) -> DataFrame:
    """The change set of the postings when one date's observations ``before`` have become ``now``.

    ``observed`` are all observations as they are now, ``known`` all postings as they were. A
    posting that ``before`` had is rolled up again from its own sightings, found by a semi-join;
    what it has lost cannot be taken off its counts. One that only ``now`` has takes in that date
    and reads none of its other sightings: where a date is new, no history is read at all.
    Postings that neither has are neither written nor rolled up.
    """
    had = before.select("job_url").filter(F.col("job_url").isNotNull()).distinct()
    again = roll_up(observed.join(had, "job_url", "left_semi"))
    renamed = again.select(*[F.col(c).alias(f"_now_{c}") for c in again.columns])
    kept = had.join(renamed, F.col("job_url") == F.col("_now_job_url"), "left").select(
        "job_url", *[F.col(f"_now_{c}").alias(c) for c in again.columns if c != "job_url"],
        F.col("_now_job_url").isNull().alias(GONE),
    )
    fresh = roll_up(now).join(had, "job_url", "left_anti")
    return kept.unionByName(merge_postings(fresh, known).withColumn(GONE, F.lit(False)))


def publish_date(spark: SparkSession, landed: DataFrame, root: str, ingest_date: str) -> dict[str, int]:
    """Replace one ingest date of what is published by what is landed for it; the rows written of each table.

    Observations, postings and dimensions are then what a full publication would give, as long
    as the other dates are landed as they were. Read are the landed rows of the date, its
    published observations, the sightings of postings that it had and has no longer as they
    were, and narrow counts per date. Publishing a date twice is the same as once.

    The version before must be a full publication, or follow one through this function and
    ``compact`` alone: ``publish_partition`` leaves postings behind and ``publish_changes`` the
    counts of the dimensions, so what they published is refused.
    """
    if published_dir(spark, root) is None:
        raise ValueError(f"nothing published under {root}")
    fact, counted = FACT_OBSERVATION, {}
    directory = f"date-{uuid4().hex}"
    here = f"{root}/{directory}"
    rows = landed.filter(F.col("_ingest_date") == ingest_date)
    counted[fact.name] = replace_partition(build_observations(rows), f"{here}/{fact.name}", "ingest_date", ingest_date)
    day = F.col("ingest_date") == F.lit(ingest_date).cast("date")
    now = read_table(spark, here, fact).filter(day)
    write_counts(rows, now, here)

    def entry(last: Row) -> dict:
        old = entry_of(last)
        if not old["following"]:
            raise ValueError("what is published was changed without its postings or dimensions; publish it in full first")
        new = swapped_entry(last, ingest_date, directory)
        # Made anew for every entry that this may follow.
        attempt = f"refresh-{uuid4().hex}"
        target = f"{root}/{attempt}"
        before = _observed(spark, root, old).filter(day)
        changes = posting_changes(before, now, _observed(spark, root, new), _rolled(spark, root, old))

        writes = {FACT_POSTING.name: partial(_write_changes, changes, target, FACT_POSTING)}
        writes |= {
            table.name: partial(write_table, dimension_of(table, _counts(spark, root, new, table)), target, table)
            for table in COUNTED
        }
        counted.update(write_together(writes, spark))
        new["replaced"] = new["replaced"] | {table.name: attempt for table in COUNTED}
        new["changes"] = new["changes"] | {FACT_POSTING.name: [*new["changes"].get(FACT_POSTING.name, []), attempt]}
        present = read_entry(spark, root, new)
        touched = spark.read.parquet(changes_dir(target, FACT_POSTING)).filter(~F.col(GONE)).select(*FACT_POSTING.columns)
        require_contracts(present | {fact.name: now, FACT_POSTING.name: touched})
        return _few_changes(spark, root, new)

    _publish(spark, root, entry)
    return {table.name: counted[table.name] for table in ALL_TABLES}


def _write_changes(changes: DataFrame, directory: str, table: Table) -> int:
    counted = Observation(f"changes-{uuid4().hex}")
    changes.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(changes_dir(directory, table))
    return counted.get["rows"]


def _few_changes(spark: SparkSession, root: str, entry: dict) -> dict:
    """The entry with no more than ``MOST_CHANGE_SETS`` change sets for any table."""
    crowded = [t for t in ALL_TABLES if len(entry["changes"].get(t.name, [])) > MOST_CHANGE_SETS]
    if not crowded:
        return entry
    directory = f"folded-{uuid4().hex}"
    for table in crowded:
        sets = read_changes(spark, root, entry, table, also=_kept(table, entry))
        _write_changes(folded(sets, table.key), f"{root}/{directory}", table)
    return entry | {"changes": entry["changes"] | {t.name: [directory] for t in crowded}}


def publish_changes(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> dict[str, dict[str, int]]:
    """Publish ``tables`` by what differs from what is published; per table the rows inserted, updated and deleted.

    Only the change set is written, whose rows are those three numbers together; readers then
    see what a full publication of ``tables`` would give. Both are read whole, but only two
    hashes per row are shuffled. A table that does not differ writes nothing, and where none
    does there is no new version.

    The publication no longer follows landed dates: ``publish_date`` asks for a full one first.
    """
    if published_dir(spark, root) is None:
        raise ValueError(f"nothing published under {root}")
    require_contracts(tables)
    directory = f"changes-{uuid4().hex}"
    counted: dict[str, dict[str, int]] = {}

    class Unchanged(Exception):
        pass

    def entry(last: Row) -> dict:
        new = entry_of(last)
        present = read_entry(spark, root, new)

        def write(table: Table) -> int:
            seen = Observation(f"changes-{uuid4().hex}")
            changes = change_set(present[table.name], tables[table.name].select(*table.columns), table.key, kinds=True)
            kinds = [F.count_if(F.col("_kind") == kind).alias(kind) for kind in ("added", "changed", "removed")]
            path = changes_dir(f"{root}/{directory}", table)
            changes.observe(seen, *kinds).drop("_kind").write.mode("overwrite").parquet(path)
            found = seen.get
            counted[table.name] = {"inserted": found["added"], "updated": found["changed"], "deleted": found["removed"]}
            return sum(found.values())

        written = write_together({t.name: partial(write, t) for t in ALL_TABLES}, spark)
        if not any(written.values()):
            raise Unchanged
        changed = {name: [*new["changes"].get(name, []), directory] for name, n in written.items() if n}
        return _few_changes(spark, root, new | {"changes": new["changes"] | changed, "following": False})

    try:
        _publish(spark, root, entry)
    except Unchanged:
        pass
    return counted


def compact(spark: SparkSession, root: str) -> None:
    """Publish the same rows with swapped dates together in one directory and change sets applied.

    Of the observations only swapped dates are written again, unless they have change sets of
    their own. A table without changes is not touched, and earlier versions stay readable.
    """

    def entry(last: Row) -> dict:
        new = entry_of(last)
        directory = f"compact-{uuid4().hex}"
        here = f"{root}/{directory}"
        tables = read_entry(spark, root, new)
        fact = FACT_OBSERVATION
        for table in ALL_TABLES:
            if new["changes"].get(table.name):
                also = _kept(table, new)
                write_table(_rolled(spark, root, new) if also else tables[table.name], here, table, also=also)
        if new["changes"].get(fact.name):
            new["swapped"] = []
        elif held := [swap for swap in new["swapped"] if swap["directory"]]:
            alone = new | {"swapped": held}
            days = [F.lit(swap["ingest_date"]).cast("date") for swap in held]
            write_table(_observed(spark, root, alone).filter(F.col("ingest_date").isin(*days)), here, fact)
            for table in COUNTED if new["following"] else ():
                save_counts(_counts(spark, root, alone, table).filter(F.col("ingest_date").isin(*days)), here, table)
            empty = [swap for swap in new["swapped"] if not swap["directory"]]
            new["swapped"] = [*empty, *(swap | {"directory": directory} for swap in held)]
        new["replaced"] = new["replaced"] | {name: directory for name, sets in new["changes"].items() if sets}
        return new | {"changes": {}}

    if published_dir(spark, root) is None:
        raise ValueError(f"nothing published under {root}")
    _publish(spark, root, entry)
