"""Land raw scrapes into one partition per ingest date."""

from collections.abc import Iterator, Sequence
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from postledger.fixed_values import SCRAPE_GLOB
from postledger.operators.fingerprint import DIGEST, build_manifest, row_digest
from postledger.operators.sketches import day_sketches
from postledger.plans.write import empty_partition, write_together
from postledger.sources.scrapes import ScrapeError, raw_scrapes, read_scrapes
from postledger.storage import path_exists, replace_directories

# Files whose headers and paths the driver plans together.
FILES_AT_ONCE = 10_000

# What a landed row must have to be counted.
_STORED = StructType([
    StructField("_source_file", StringType()), StructField("job_url", StringType()),
    StructField(DIGEST, LongType()), StructField("ingest_date", DateType()),
])


def landing_dir(root: str) -> str:
    """Where the landed rows of ``root`` are kept, a directory per ingest date."""
    return f"{root}/landing"


def manifest_dir(root: str) -> str:
    """Where the manifest of ``root`` is kept."""
    return f"{root}/manifest"


def files_dir(root: str) -> str:
    """Where ``root`` keeps which files were landed, and how they were then."""
    return f"{root}/files"


def sketches_dir(root: str) -> str:
    """Where ``root`` keeps a sketch of the URLs of each date."""
    return f"{root}/sketches"


def land(
    spark: SparkSession,
    source_dir: str,
    root: str,
    pattern: str = SCRAPE_GLOB,
    only_date: str | None = None,
    wide_rows: str = "fail",
    multi_line: bool = True,
    storage: str = "parquet",
    undecodable: str = "fail",
    changed_only: bool = False,
    split_quoted: bool = False,
) -> DataFrame:
    """Land every scrape date found in ``source_dir``, or only one; their manifest.

    Each date is replaced whole. All dates are written beside the present ones first, so a run
    that fails, at whichever of its files, leaves every date as it was; then they are moved in
    place, a rename per date. Dates without files keep what they have, and landing the same
    files again gives the same rows. Rows are neither cleaned nor deduplicated here.

    With ``changed_only`` only dates are landed of which a file is new, has another length or
    time than when it was landed, or has vanished while others of the date are there. Where
    none has, no file is opened and the manifest that is given has no rows.

    ``storage`` is ``"parquet"`` or, for readers of text, ``"json"``: gzipped JSON lines.

    A scrape file belongs to one date, so rows go from the task that parses them straight
    to their partition, without a shuffle. Their digests are taken on the way, so the
    manifest does not read the wide columns again. Files are listed, dated and counted as a
    table; the driver gets a row per date, and paths for some ``FILES_AT_ONCE`` files at a time,
    those of one date in several goes where it has more.
    """
    files = raw_scrapes(spark, source_dir, pattern)
    if only_date is not None:
        files = files.filter(F.col("ingest_date") == F.lit(only_date).try_cast("date"))
    listed = {str(row.ingest_date): row.n for row in files.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not listed:
        raise ScrapeError(f"no scrape files {f'for {only_date}' if only_date else f'under {source_dir}'}")
    if changed_only:
        changed = changed_dates(spark, files, root)
        listed = {date: n for date, n in listed.items() if date in changed}
    dates = sorted(listed)
    if dates:
        staged = f"{root}/_staged-{uuid4().hex}"
        with_rows: set[str] = set()
        schema = None
        for chosen in _groups(listed):
            paths = sorted(row.path for row in files.filter(chosen).select("path").collect())
            if not paths:  # a part of a date's files that no hash falls to
                continue
            rows = read_scrapes(spark, paths, pattern, wide_rows, multi_line, undecodable, split_quoted)
            schema, seen = _stage(rows, staged, storage)
            with_rows |= seen
        for date in set(dates) - with_rows:
            empty_partition(spark, schema, staged, "ingest_date", date, storage)
        replace_directories(spark, staged, landing_dir(root), [f"ingest_date={date}" for date in dates])
        _account(spark, files.filter(F.col("ingest_date").isin(*dates)), root, dates, storage)
    return read_manifest(spark, root).filter(F.col("ingest_date").isin(*dates))


def _groups(listed: dict[str, int]) -> Iterator:
    """Filters that choose some ``FILES_AT_ONCE`` files each, and every file of the dates once."""
    waiting: list[str] = []
    for date, n in sorted(listed.items()):
        if n > FILES_AT_ONCE:
            parts = -(-n // FILES_AT_ONCE)
            for part in range(parts):
                yield (F.col("ingest_date") == F.lit(date).cast("date")) & (F.pmod(F.xxhash64("path"), F.lit(parts)) == part)
            continue
        if waiting and sum(listed[d] for d in waiting) + n > FILES_AT_ONCE:
            yield F.col("ingest_date").isin(*waiting)
            waiting = []
        waiting.append(date)
    if waiting:
        yield F.col("ingest_date").isin(*waiting)


def _stage(rows: DataFrame, staged: str, storage: str) -> tuple[StructType, set[str]]:
    """Add rows to the staged dates; their schema, and the dates that got any."""
    if storage == "json":
        rows = rows.withColumn("_ingest_date", F.col("ingest_date").cast("string"))
    rows = rows.withColumn(DIGEST, row_digest([c for c in rows.columns if c not in ("ingest_date", "_ingest_date")]))
    seen = Observation(f"landed-{uuid4().hex}")
    with_rows = F.collect_set(F.col("ingest_date").cast("string")).alias("dates")
    writer = rows.observe(seen, with_rows).write.mode("append").partitionBy("ingest_date").format(storage)
    if storage == "json":
        writer = writer.option("compression", "gzip")
    writer.save(staged)
    return rows.schema, set(seen.get["dates"])


def _account(spark: SparkSession, files: DataFrame, root: str, dates: Sequence[str], storage: str) -> None:
    """Write manifest and file states of ``dates``, from what was committed, not from what was read."""
    landed = spark.read.schema(_STORED).format(storage).load(landing_dir(root)).filter(F.col("ingest_date").isin(*dates))
    asked = spark.createDataFrame([(date,) for date in dates], "date string").select(F.col("date").cast("date").alias("ingest_date"))
    # A date's row comes out of the aggregates in one task, so it is one small file.
    manifest = build_manifest(landed, asked)
    digests = landed.groupBy("ingest_date", F.col("_source_file").alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(DIGEST).cast("decimal(38,0)")).cast("string").alias("fingerprint")
    )
    known = files.select("file_name", "bytes", "modified", "ingest_date").join(digests, ["ingest_date", "file_name"], "left")
    states = known.withColumns({"rows": F.coalesce("rows", F.lit(0)), "fingerprint": F.coalesce("fingerprint", F.lit("0"))})
    tables = {manifest_dir: manifest, sketches_dir: day_sketches(landed), files_dir: states.hint("rebalance", "ingest_date")}
    write_together({where.__name__: partial(_overwrite, df, where(root)) for where, df in tables.items()}, spark)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of every date landed under ``root``."""
    return spark.read.parquet(manifest_dir(root))


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file landed under ``root`` as it was then: length, time, rows and fingerprint."""
    return spark.read.parquet(files_dir(root))


def read_sketches(spark: SparkSession, root: str) -> DataFrame:
    """The sketch of each landed date: what ``distinct_urls`` asks for. Dates without rows have none."""
    return spark.read.schema("urls binary, ingest_date date").parquet(sketches_dir(root))


def changed_dates(spark: SparkSession, files: DataFrame, root: str) -> set[str]:
    """Dates of ``files``, a listing, that do not have the files that were landed, as they were then.

    A join of the listing with the file states; the driver gets the dates alone.
    """
    if not path_exists(spark, files_dir(root)):
        return {str(row.ingest_date) for row in files.select("ingest_date").distinct().collect()}
    how = ["ingest_date", "file_name", "bytes", "modified"]
    states, listing = read_files(spark, root).select(*how), files.select(*how)
    other = listing.join(states, how, "left_anti")
    # One that is known but no longer listed, where its date still has files.
    gone = states.join(listing.select("ingest_date").distinct(), "ingest_date", "left_semi").join(listing, how, "left_anti")
    return {str(row.ingest_date) for row in other.unionByName(gone).select("ingest_date").distinct().collect()}


def _overwrite(df: DataFrame, directory: str) -> None:
    """Replace the dates of ``df`` in a table and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(directory)
