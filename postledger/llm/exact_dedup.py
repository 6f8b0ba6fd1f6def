"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest, in levels: a batch of new data is
grouped by digest, meets each level in a sort-merge join that neither shuffles nor sorts the
level, and what is new is appended as a level of its own, one sorted file per bucket. Levels are
compacted to one from time to time. Only digests and ids travel, never texts.

A log names the levels that count, with a file per change. A level is written before the log
names it, so a batch that fails on the way has left nothing behind.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postledger.llm.common import BLANKS, text_or_empty, written
from postledger.storage import create_file, path_exists

BUCKETS = 64
# Makes Spark trust the order within the files of a level.
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
_LOG = "version long, buckets int, id_type string, levels array<struct<directory string, batches array<string>>>"


def normalised(text: str | Column) -> Column:
    """The text with each run of blanks as one space; NULL counts as empty."""
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def text_digest(text: str | Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """Digests of every text seen so far, with the id of the row that stays for each."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int | None = None):
        """Open the index kept at ``path``, or start one with ``buckets`` buckets (64 if none are named).

        The number and the type of ids are kept with the index; to ask for others later fails.
        """
        self.spark, self.path = spark, path
        self.tables: set[str] = set()
        if not path_exists(spark, f"{path}/log"):
            first = {"version": 0, "buckets": buckets or BUCKETS, "id_type": id_type, "levels": []}
            create_file(spark, f"{path}/log/{0:012}.json", json.dumps(first) + "\n")
        kept = self._last()
        self.buckets, self.id_type = kept["buckets"], kept["id_type"]
        if buckets not in (None, self.buckets):
            raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")
        if id_type != self.id_type:
            raise ValueError(f"the index at {path} has ids of type {self.id_type}, not {id_type}")

    def _last(self) -> dict:
        # An entry that is being written reads as NULL.
        log = self.spark.read.schema(_LOG).json(f"{self.path}/log").filter("version IS NOT NULL")
        return log.orderBy(F.desc("version")).first().asDict(recursive=True)

    def _change(self, levels: Callable[[list[dict]], list[dict]]) -> None:
        """Log the levels that ``levels`` makes of the present ones; again, where another change came first."""
        while True:
            last = self._last()
            entry = last | {"version": last["version"] + 1, "levels": levels(last["levels"])}
            if create_file(self.spark, f"{self.path}/log/{entry['version']:012}.json", json.dumps(entry) + "\n"):
                return

    def _table(self, directory: str) -> str:
        """The name under which the session knows a level."""
        where = f"{self.path}/{directory}"
        name = f"digest_level_{hashlib.sha256(where.encode()).hexdigest()[:24]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id {self.id_type}, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{where}'"
        )
        self.tables.add(name)
        return name

    def _write_level(self, entries: DataFrame) -> str:
        """A new level of (digest, keep_id, batch): one task, and so one sorted file, per bucket."""
        directory = f"level-{uuid4().hex}"
        spread = entries.select("digest", "keep_id", "batch").repartition(self.buckets, "digest")
        spread.sortWithinPartitions("digest").write.insertInto(self._table(directory))
        return directory

    @contextmanager
    def _trusted_order(self) -> Iterator[None]:
        before = self.spark.conf.get(_ORDERED)
        self.spark.conf.set(_ORDERED, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_ORDERED, before)

    def levels(self, levels: list[dict] | None = None) -> list[DataFrame]:
        """The levels that count, or those of a log entry."""
        return [self.spark.table(self._table(level["directory"])) for level in (self._last()["levels"] if levels is None else levels)]

    def entries(self) -> DataFrame:
        """Every digest that was seen: (digest, keep_id, batch)."""
        levels = self.levels()
        if not levels:
            return self.spark.createDataFrame([], f"digest binary, keep_id {self.id_type}, batch string")
        return reduce(DataFrame.unionByName, levels)

    def close(self) -> None:
        """Forget the names of the levels; their files stay."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.clear()

    def known(self, groups: DataFrame, levels: list[DataFrame]) -> DataFrame:
        """``groups``, a row per digest, with ``keep_id`` of the level that has it, and whether one has (``seen``).

        Groups are shuffled to the buckets of the index once; the levels stay where they are.
        """
        found = groups.repartition(self.buckets, "digest").withColumns({"keep_id": F.lit(None).cast(self.id_type), "seen": F.lit(False)})
        for level in levels:
            held = level.select("digest", F.col("keep_id").alias("_keep"), F.lit(True).alias("_there"))
            there = F.coalesce("_there", F.lit(False))
            found = found.join(held.hint("merge"), "digest", "left").withColumns(
                {"keep_id": F.when(there, F.col("_keep")).otherwise(F.col("keep_id")), "seen": F.col("seen") | there}
            ).drop("_keep", "_there")
        return found

    def append(self, groups: DataFrame, batch: str) -> DataFrame:
        """Add the digests that the index lacks, and give all ``groups`` with ``keep_id`` and ``seen``.

        ``groups`` has a row per digest, with the id that would stay as ``first_id``. A batch that
        was there already is replaced: its own digests count as new again, so a job that is run
        again keeps what it kept the first time. One that was compacted can not be run again.
        """
        made: list[DataFrame] = []

        def levels(present: list[dict]) -> list[dict]:
            if any(batch in level["batches"] and len(level["batches"]) > 1 for level in present):
                raise ValueError(f"batch {batch} is compacted with others and cannot be run again")
            others = [level for level in present if batch not in level["batches"]]
            with self._trusted_order():
                # Written, so that both its uses, and a reader's, see the same.
                known = written(self.known(groups, self.levels(others)), "known-digests")
            fresh = known.filter(~F.col("seen")).select("digest", F.col("first_id").alias("keep_id"), F.lit(batch).alias("batch"))
            made[:] = [known.withColumn("keep_id", F.when(F.col("seen"), F.col("keep_id")).otherwise(F.col("first_id")))]
            return [*others, {"directory": self._write_level(fresh), "batches": [batch]}]

        self._change(levels)
        return made[0]

    def compact(self, keep: int = 1) -> None:
        """Put all levels but the last ``keep`` together to one, whose batches cannot be run again."""

        def levels(present: list[dict]) -> list[dict]:
            old, last = present[: len(present) - keep], present[len(present) - keep :]
            if len(old) < 2:
                return present
            together = self._write_level(reduce(DataFrame.unionByName, self.levels(old)))
            return [{"directory": together, "batches": [b for level in old for b in level["batches"]]}, *last]

        self._change(levels)


def exact_dedup(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, batch: str | None = None
) -> DataFrame:
    """A verdict for every row of ``docs``: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when they are identical with runs of blanks as one space, however long they
    are. A text that the index has goes, and ``keep_id`` names the row that stayed then. Of equal
    new texts the row with the smallest id stays and enters the index; ``group_size`` counts the
    equal rows of this call.

    ``batch`` names what is added. Whoever may have to run the job again gives a name, and the
    same when it runs again: what it entered before is entered anew, so the verdicts are the same.

    A NULL text counts as empty. A NULL id comes behind all others. Of rows that share id and
    text exactly one stays. Other columns of ``docs`` are not read, whatever their names. No
    rows give no rows.

    ``row_col`` names a column that tells the rows apart; it is given out as the last column.
    """
    # The row number tells apart rows that repeat an id. It is fixed by being written.
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = written(docs.select(F.col(id_col).alias("id"), row.alias("row"), text_digest(text_col).alias("digest")), "digests")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    groups = rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    known = index.append(groups.select("digest", "group_size", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row")), batch or uuid4().hex)
    # Both sides are read from what was written, so a digest that many rows share can be split.
    return rows.join(known, "digest").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (~F.col("seen") & (F.col("row") == F.col("first_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *([F.col("row").alias(row_col)] if row_col else []),
    )
