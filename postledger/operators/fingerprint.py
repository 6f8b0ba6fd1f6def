"""Content fingerprints and the manifest of landed partitions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.fixed_values import SENSITIVE_COLUMNS
from postledger.functions import strip_blanks


# Where a landed row keeps its digest.
DIGEST = "_digest"


def row_digest(columns: Sequence[str]) -> Column:
    """Sixty bits of the SHA-256 of a row, as a long.

    Every value is written with its length, NULL as "~", so no two rows read alike.
    """
    cells = []
    for name in sorted(columns):
        text = F.col(f"`{name}`").cast("string")
        cell = F.concat(F.lit(f"{name}="), F.char_length(text).cast("string"), F.lit(":"), text)
        cells.append(F.coalesce(cell, F.lit(f"{name}=~")))
    digest = F.sha2(F.concat_ws(";", *cells), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _sum(digest: Column) -> Column:
    return F.sum(digest.cast("decimal(38,0)"))


def fingerprint(columns: Sequence[str]) -> Column:
    """Aggregate that tells tables apart by content, whatever order their rows are in."""
    return F.coalesce(_sum(row_digest(columns)), F.lit(0)).cast("string")


def build_manifest(landed: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """One row per landed ingest date: rows, distinct URLs, files and fingerprint.

    Digests that were landed with the rows are summed as they are; then this reads three
    narrow columns. Otherwise they are taken from all columns here.

    With ``dates`` (``ingest_date``) also a row for each of them that has no rows. The
    first aggregate is one row per file before it is shuffled. Distinct URLs are counted
    from (date, URL) pairs, so no task holds the URLs of a whole date.
    """
    contents = [c for c in landed.columns if c != "ingest_date"]
    digest = F.col(DIGEST) if DIGEST in contents else row_digest(contents)
    files = (
        landed.groupBy("ingest_date", "_source_file")
        .agg(F.count(F.lit(1)).alias("rows"), _sum(digest).alias("digest"))
        .groupBy("ingest_date")
        .agg(
            F.sum("rows").alias("rows"),
            F.array_sort(F.collect_list("_source_file")).alias("source_files"),
            F.sum("digest").cast("string").alias("fingerprint"),
        )
    )
    url = F.col("job_url") if "job_url" in contents else F.lit(None).cast("string")
    urls = (
        landed.select("ingest_date", F.nullif(strip_blanks(url), F.lit("")).alias("url"))
        .distinct()
        .groupBy("ingest_date")
        .agg(F.count("url").alias("distinct_job_urls"))
    )
    counted = files.join(urls, "ingest_date")
    if dates is not None:
        counted = dates.join(counted, "ingest_date", "left")
    return counted.select(
        "ingest_date",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("distinct_job_urls", F.lit(0)).alias("distinct_job_urls"),
        F.coalesce("source_files", F.array().cast("array<string>")).alias("source_files"),
        F.array(*[F.lit(c) for c in SENSITIVE_COLUMNS]).alias("dropped_columns"),
        F.coalesce("fingerprint", F.lit("0")).alias("fingerprint"),
    )
