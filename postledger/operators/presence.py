"""On which dates a posting was seen, as bits, and what follows from that."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Dates in a word of bits.
_DAYS = 64


def _day(date: str | Column) -> Column:
    return F.unix_date(F.col(date) if isinstance(date, str) else date)


def _word(day: Column) -> Column:
    return F.floor(day / _DAYS).cast("int")


def presence(observations: DataFrame) -> DataFrame:
    """The dates on which each posting was seen: (job_url, word, days), a bit per date.

    A row holds 64 days, from the one numbered ``64 * word`` since 1970 on, so a posting has few
    rows and rows of a day that comes later are merged by OR. Bits are put together before the
    shuffle, so it sees a row per posting and word from each task at most.
    """
    day = _day("ingest_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(_DAYS)))
    return (
        observations.filter(F.col("job_url").isNotNull())
        .groupBy("job_url", _word(day).alias("word"))
        .agg(F.bit_or(bit).alias("days"))
    )


def open_between(seen: DataFrame, ranges: DataFrame) -> DataFrame:
    """The postings of ``presence`` seen on some date of each range: (first, last, job_url, dates, since, until).

    ``ranges`` has ``first`` and ``last``, both included. ``dates`` counts the dates of the range on
    which a posting was seen; ``since`` and ``until`` are the first and last of them. Only the words
    that a range meets are joined with it, and no sighting is read.
    """
    words = ranges.select(
        "first", "last", F.explode(F.sequence(_word(_day("first")), _word(_day("last")))).alias("_word")
    )
    met = seen.join(words, F.col("word") == F.col("_word"))
    start = F.col("word") * _DAYS
    # Bits of the word within the range; the sign bit is the last day of it.
    low = F.call_function("shiftleft", F.lit(-1).cast("long"), F.greatest(_day("first") - start, F.lit(0)))
    high = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.greatest(start + (_DAYS - 1) - _day("last"), F.lit(0)))
    met = met.withColumn("days", F.col("days").bitwiseAND(low).bitwiseAND(high)).filter("days <> 0")
    bits = F.reverse(F.lpad(F.bin("days"), _DAYS, "0"))
    first, last = (F.col("word") * _DAYS + place for place in (F.locate("1", bits) - 1, _DAYS - F.locate("1", F.reverse(bits))))
    return met.groupBy("first", "last", "job_url").agg(
        F.sum(F.bit_count("days")).cast("long").alias("dates"),
        F.date_from_unix_date(F.min(first.cast("int"))).alias("since"),
        F.date_from_unix_date(F.max(last.cast("int"))).alias("until"),
    )


def visible_spells(observations: DataFrame) -> DataFrame:
    """Stretches of scrapes in which a site showed a posting without a gap: (job_url, source_key, since, until, scrapes).

    A site is known to have dropped a posting only where it was scraped and did not show it, so
    gaps are counted in scrapes of that site and not in days. The site's scrapes are numbered,
    a row per site and date; a stretch is where these numbers and those of the sightings go on
    side by side. The window over a posting's sightings holds at most a row per scrape of a site.
    """
    shown = observations.select("job_url", "source_key", "ingest_date").filter(F.col("job_url").isNotNull()).distinct()
    scraped = observations.select(F.col("source_key").alias("_site"), F.col("ingest_date").alias("_date")).distinct()
    by_date = Window.partitionBy("_site").orderBy("_date")
    scraped = scraped.withColumn("_scrape", F.row_number().over(by_date))
    same = F.col("source_key").eqNullSafe(F.col("_site")) & F.col("ingest_date").eqNullSafe(F.col("_date"))
    own = Window.partitionBy("job_url", "source_key").orderBy("ingest_date")
    return (
        shown.join(scraped, same)
        .withColumn("_stretch", F.col("_scrape") - F.row_number().over(own))
        .groupBy("job_url", "source_key", "_stretch")
        .agg(F.min("ingest_date").alias("since"), F.max("ingest_date").alias("until"), F.count(F.lit(1)).alias("scrapes"))
        .drop("_stretch")
    )


def salary_spells(observations: DataFrame) -> DataFrame:
    """The salary bands of each posting in time: (job_url, salary_min, salary_max, valid_from, valid_to, dates).

    A band holds from the date it was first shown to the day before another one was; ``valid_to``
    is NULL for the last. A day has one band per posting, that of its first site by name. A band
    that is not stated is one, too, and one that comes back after another is a new row.
    """
    band = F.struct("salary_min", "salary_max")
    days = (
        observations.filter(F.col("job_url").isNotNull())
        .groupBy("job_url", "ingest_date")
        .agg(F.min_by(band, F.struct("source_key", "source_file")).alias("band"))
    )
    by_date = Window.partitionBy("job_url").orderBy("ingest_date")
    before = F.lag("band").over(by_date)
    changed = F.when(before.isNull() | ~before.eqNullSafe(F.col("band")), 1).otherwise(0)
    spells = (
        days.withColumn("_changed", changed)
        .withColumn("_spell", F.sum("_changed").over(by_date))
        .groupBy("job_url", "_spell")
        .agg(F.any_value("band").alias("band"), F.min("ingest_date").alias("valid_from"), F.count(F.lit(1)).alias("dates"))
    )
    following = F.lead("valid_from").over(Window.partitionBy("job_url").orderBy("_spell"))
    return spells.select(
        "job_url", "band.salary_min", "band.salary_max", "valid_from", F.date_sub(following, 1).alias("valid_to"), "dates"
    )


def seen_on(observations: DataFrame, dates: DataFrame, *attributes: str) -> DataFrame:
    """The observations on the days that ``dates``, rows of ``dim_date``, choose, with ``attributes`` of these.

    The chosen days prune the partitions of the observations while the query runs, so only
    these are read, whatever it is of a date that chose them. Spark does so where they were
    chosen by a comparison, such as one of ``day_name`` or ``iso_week``, not by a bare flag.
    """
    chosen = dates.select(F.col("date").alias("_date"), *attributes)
    return observations.join(chosen, F.col("ingest_date") == F.col("_date")).drop("_date")


def days_of(spark, ranges: Sequence[tuple[str, str]]) -> DataFrame:
    """Ranges of dates as the table that ``open_between`` asks for."""
    rows = spark.createDataFrame(list(ranges), "first string, last string")
    return rows.select(F.col("first").cast("date").alias("first"), F.col("last").cast("date").alias("last"))
