"""The two facts: sightings, and postings as last seen."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, StringType, StructField

from postledger.functions import amount, posted_date, with_company, with_location
from postledger.operators.grain import packed, smallest_per_key, unpacked
from postledger.schemas import FACT_OBSERVATION, FACT_POSTING

_SIGHTING = ("_ingest_date", "site", "job_url")

# What a posting takes over from its last sighting: all that both facts have.
_LAST_SEEN = tuple(c for c in FACT_POSTING.columns if c in FACT_OBSERVATION.columns and c not in FACT_POSTING.key)
_LAST_TEXTS = [c for c in _LAST_SEEN if FACT_POSTING.schema[c].dataType == StringType()]
_LAST_OTHERS = [c for c in _LAST_SEEN if c not in _LAST_TEXTS]

# The landed field behind a column of the observation fact, where it has another name.
_LANDED_AS = {
    "ingest_date": "_ingest_date", "source_file": "_source_file", "source_key": "site",
    "salary_interval": "interval", "salary_max": "max_amount", "salary_min": "min_amount",
}
# How a landed text is read, by the type of its column.
_READ_AS = {DateType(): posted_date, DoubleType(): amount, BooleanType(): lambda text: F.lower(text) == "true"}


def conform_sightings(landed: DataFrame) -> DataFrame:
    """Landed rows in the columns of the observation fact, one for one."""
    conformed = with_location(with_company(landed))

    def column(field: StructField) -> Column:
        text = F.col(_LANDED_AS.get(field.name, field.name))
        if field.name in FACT_OBSERVATION.partition_by:
            return text.cast(field.dataType).alias(field.name)
        return _READ_AS.get(field.dataType, lambda same: same)(text).alias(field.name)

    return conformed.select(*map(column, FACT_OBSERVATION.schema.fields))


def build_observations(landed: DataFrame) -> DataFrame:
    """``fact_posting_observation``: one row per scrape date, site and posting.

    Of rows that repeat a sighting the one from the first source file stays. They are
    dropped before conforming, so a repeated row costs no parsing.
    """
    return conform_sightings(smallest_per_key(landed, _SIGHTING, order=["_source_file"]))


# What a rolled-up posting knows beside its columns: the sites that had it.
SOURCES = "_sources"


def build_postings(observations: DataFrame) -> DataFrame:
    """``fact_posting``: one row per posting, an accumulating snapshot. See :func:`roll_up`."""
    return roll_up(observations).select(*FACT_POSTING.columns)


def roll_up(observations: DataFrame) -> DataFrame:
    """One row per posting: the columns of ``fact_posting``, and the sites that had it.

    Attributes come from the last sighting (among sites seen on that day the first by
    name), span and counts from all of them, in one aggregate and one shuffle. The two
    sets, of which span and counts are made, hold the dates and sites of one posting, at most a calendar's and a site list's
    worth, and merge before the shuffle; counting distinct values instead would triple the
    rows. Sightings without a URL belong to no posting. The hash in front of the URL is
    there for the sort, and texts are packed, as in :func:`smallest_per_key`.
    """
    latest_first = F.struct(
        F.coalesce(-F.unix_date("ingest_date"), F.lit(2**31 - 1)), packed(["source_key", "source_file"])
    )
    spans = (
        observations.filter(F.col("job_url").isNotNull())
        .groupBy(F.xxhash64("job_url").alias("_hash"), "job_url")
        .agg(
            F.min_by(F.struct(packed(_LAST_TEXTS).alias("_texts"), *_LAST_OTHERS), latest_first).alias("_last"),
            F.collect_set("ingest_date").alias("_dates"),
            F.collect_set("source_key").alias(SOURCES),
        )
    )
    return spans.withColumn("_texts", unpacked(F.col("_last")["_texts"])).select(
        "job_url",
        *[F.get("_texts", F.lit(place)).alias(c) for place, c in enumerate(_LAST_TEXTS)],
        *[F.col("_last")[c].alias(c) for c in _LAST_OTHERS],
        F.array_min("_dates").alias("first_seen_date"),
        F.array_max("_dates").alias("last_seen_date"),
        F.size("_dates").cast("long").alias("observation_count"),
        F.size(SOURCES).cast("long").alias("source_count"),
        (F.datediff(F.array_max("_dates"), F.array_min("_dates")) + 1).alias("days_visible"),
        F.array_sort(SOURCES).alias(SOURCES),
    ).select(*FACT_POSTING.columns, SOURCES)


def merge_postings(more: DataFrame, known: DataFrame) -> DataFrame:
    """The postings of ``more`` with what ``known`` has of them, both rolled up, over other dates each.

    A posting takes its attributes from the side that saw it last; spans, counts and sites
    add up. So a posting seen on one more date needs none of its earlier sightings.
    """
    before = known.select(*[F.col(c).alias(f"_k_{c}") for c in known.columns])
    joined = more.join(before, F.col("job_url") == F.col("_k_job_url"), "left")
    older = F.coalesce(F.col("_k_last_seen_date") > F.col("last_seen_date"), F.lit(False))
    sites = F.array_sort(F.array_union(SOURCES, F.coalesce(f"_k_{SOURCES}", F.array().cast("array<string>"))))
    merged = joined.select(
        "job_url",
        *[F.when(older, F.col(f"_k_{c}")).otherwise(F.col(c)).alias(c) for c in _LAST_SEEN],
        F.least("first_seen_date", "_k_first_seen_date").alias("first_seen_date"),
        F.greatest("last_seen_date", "_k_last_seen_date").alias("last_seen_date"),
        (F.col("observation_count") + F.coalesce("_k_observation_count", F.lit(0))).alias("observation_count"),
        F.size(sites).cast("long").alias("source_count"),
        sites.alias(SOURCES),
    )
    days = (F.datediff("last_seen_date", "first_seen_date") + 1).alias("days_visible")
    return merged.select("*", days).select(*FACT_POSTING.columns, SOURCES)
