"""Questions the model answers."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postledger.functions import strip_blanks

def _rows() -> Column:
    return F.count(F.lit(1))


def corpus_profile(scraped: DataFrame) -> DataFrame:
    """Size and variety of the raw scrapes, in one row. Distinct texts are counted as written."""
    blank = F.coalesce(strip_blanks(F.col("company")), F.lit("")) == ""
    return scraped.agg(
        _rows().alias("rows"),
        F.count_distinct("job_url").alias("postings"),
        F.count_distinct("company").alias("companies"),
        F.count_distinct("title").alias("titles"),
        F.count_distinct("location").alias("locations"),
        F.count_if(F.coalesce(strip_blanks(F.col("emails")), F.lit("")) != "").alias("rows_with_email"),
        F.count_if(blank).alias("rows_without_company"),
    ).withColumn("rows_per_posting", F.try_divide("rows", "postings"))


def id_collisions(landed: DataFrame) -> DataFrame:
    """Ids that stand for more than one URL, which is why an id identifies no posting."""
    pairs = landed.select("id", "job_url").filter(F.col("job_url").isNotNull()).distinct()
    return pairs.groupBy("id").agg(_rows().alias("urls")).filter(F.col("urls") > 1)


def derived_new_urls(raw: DataFrame, derived: DataFrame) -> DataFrame:
    """What the derived files would add: rows, URLs, and URLs that no raw scrape has.

    Both sides are distinct URLs before they meet, so one that repeats without end joins once.
    """
    urls = derived.groupBy("job_url").agg(_rows().alias("rows"))
    known = raw.select("job_url", F.lit(True).alias("known")).distinct()
    return urls.join(known, "job_url", "left").agg(
        F.sum("rows").alias("rows_added"),
        F.count("job_url").alias("urls"),
        F.count_if(F.col("known").isNull() & F.col("job_url").isNotNull()).alias("new_urls"),
    )


def open_on_date(observations: DataFrame, date: str) -> DataFrame:
    """Postings that a scrape saw on ``date``, with the sites that had them; reads that date alone."""
    return (
        observations.filter(F.col("ingest_date") == F.lit(date).cast("date"))
        .filter(F.col("job_url").isNotNull())
        .groupBy("job_url")
        .agg(_rows().alias("sites"))
    )


def open_by_date(observations: DataFrame) -> DataFrame:
    """How many postings each scrape date saw."""
    seen = observations.select("ingest_date", "job_url").filter(F.col("job_url").isNotNull()).distinct()
    return seen.groupBy("ingest_date").agg(_rows().alias("open_postings"))


def _week(date: str) -> Column:
    return F.trunc(date, "week")


def weekly_churn(postings: DataFrame) -> DataFrame:
    """Postings first and last seen in each week, a week being known by its Monday.

    Pairs of weeks are counted first, so what is split in two is small.
    """
    pairs = postings.groupBy(
        _week("first_seen_date").alias("first"), _week("last_seen_date").alias("last")
    ).agg(_rows().alias("rows"))
    ends = pairs.select(
        F.inline(F.array(
            F.struct(F.col("first").alias("week"), F.col("rows").alias("n"), F.lit(0).cast("long").alias("m")),
            F.struct(F.col("last").alias("week"), F.lit(0).cast("long").alias("n"), F.col("rows").alias("m")),
        ))
    )
    return ends.groupBy("week").agg(F.sum("n").alias("first_seen"), F.sum("m").alias("last_seen"))


def days_visible_distribution(postings: DataFrame) -> DataFrame:
    """How many postings were visible for how many days, from first to last sighting."""
    return postings.groupBy("days_visible").agg(_rows().alias("postings"))


def days_visible_summary(postings: DataFrame) -> DataFrame:
    """Average, median and ninth decile of the days visible; exact, from one counter per day count."""
    days = F.col("days_visible")
    return postings.agg(
        _rows().alias("postings"),
        F.min(days).alias("shortest"),
        F.max(days).alias("longest"),
        F.avg(days).alias("average"),
        F.percentile(days, 0.5).alias("median"),
        F.percentile(days, 0.9).alias("ninth_decile"),
    )


def salary_changes(observations: DataFrame) -> DataFrame:
    """Dates on which a posting showed another salary band than on the date it was seen before.

    A day has one band per posting, that of its first site by name. The window therefore
    holds at most one row per scrape date, however often a posting was seen. A change from
    or to a band that is not stated counts.
    """
    band = F.struct("salary_min", "salary_max")
    days = (
        observations.filter(F.col("job_url").isNotNull())
        .groupBy("job_url", "ingest_date")
        .agg(F.min_by(band, F.struct("source_key", "source_file")).alias("band"))
    )
    by_date = Window.partitionBy("job_url").orderBy("ingest_date")
    before = F.lag("band").over(by_date)
    return (
        days.withColumn("before", before)
        .filter(F.col("before").isNotNull() & ~F.col("before").eqNullSafe(F.col("band")))
        .select(
            "job_url",
            "ingest_date",
            F.col("before.salary_min").alias("min_before"),
            F.col("before.salary_max").alias("max_before"),
            F.col("band.salary_min").alias("min_after"),
            F.col("band.salary_max").alias("max_after"),
        )
    )


def salary_profile(observations: DataFrame) -> DataFrame:
    """Stated salaries by currency and pay period; what is not stated counts in no average."""
    return observations.groupBy("currency", "salary_interval").agg(
        _rows().alias("observations"),
        F.count("salary_min").alias("with_min"),
        F.count("salary_max").alias("with_max"),
        F.avg("salary_min").alias("average_min"),
        F.avg("salary_max").alias("average_max"),
    )


def postings_by_region(postings: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Postings by country and province.

    Postings are counted per location before the join, so a place that holds a third of
    them joins as one row.
    """
    counted = postings.groupBy("location_key").agg(_rows().alias("postings"))
    return (
        counted.join(dim_location, "location_key", "left")
        .groupBy("country_code", "province_code")
        .agg(F.sum("postings").alias("postings"))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counts = None
    for name, df in tables.items():
        one = df.agg(_rows().alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionAll(one)
    return counts
