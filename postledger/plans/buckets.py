"""Both facts in buckets of their postings, so that what is asked per posting needs no shuffle.

A copy beside the model, for questions over the whole history: the facts are hashed by ``job_url``
into as many buckets each, a file per bucket, sorted. A posting's row and all its sightings then lie
in buckets of one number. Sightings without a URL belong to no posting and would all share one
bucket, so they are kept beside the buckets, in files of good size.
"""

from functools import partial
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postledger.plans.write import write_together
from postledger.schemas import FACT_OBSERVATION, FACT_POSTING, Table
from postledger.sources.model import read_table
from postledger.storage import create_file, qualified

_SORTED = {FACT_POSTING: ("job_url",), FACT_OBSERVATION: ("job_url", "ingest_date", "source_key")}
_NUMBER, _WITHOUT = "buckets", "without_url"


def _has_url():
    return F.col("job_url").isNotNull()


def write_bucketed(spark: SparkSession, model_dir: str, directory: str, buckets: int) -> dict[str, int]:
    """Write both facts of a model in ``buckets`` buckets to ``directory``, a new one; the rows of each.

    Each fact takes one shuffle, by what its buckets are, so that a task holds one bucket and writes
    one file. How many there are is kept with them. A bucket should be a few hundred megabytes.
    """
    if buckets < 1:
        raise ValueError("at least one bucket")
    if not create_file(spark, f"{directory}/{_NUMBER}", f"{buckets}\n"):
        raise ValueError(f"{directory} holds buckets already; take a new directory")

    def write(table: Table, rows: DataFrame) -> int:
        counted, name = Observation(f"buckets-{uuid4().hex}"), f"postledger_write_{uuid4().hex}"
        spread = rows.repartition(buckets, "job_url").observe(counted, F.count(F.lit(1)).alias("rows"))
        writer = spread.write.bucketBy(buckets, "job_url").sortBy(*_SORTED[table])
        try:
            writer.option("path", f"{directory}/{table.name}").format("parquet").saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")  # the files stay
        return counted.get["rows"]

    def write_without(rows: DataFrame) -> int:
        counted = Observation(f"without-{uuid4().hex}")
        rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{directory}/{_WITHOUT}")
        return counted.get["rows"]

    postings, observations = (read_table(spark, model_dir, table) for table in (FACT_POSTING, FACT_OBSERVATION))
    counts = write_together({
        FACT_POSTING.name: partial(write, FACT_POSTING, postings),
        FACT_OBSERVATION.name: partial(write, FACT_OBSERVATION, observations.filter(_has_url())),
        _WITHOUT: partial(write_without, observations.filter(~_has_url())),
    }, spark)
    counts[FACT_OBSERVATION.name] += counts.pop(_WITHOUT)
    return counts


def read_bucketed(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Both facts by name, as postings and the sightings of postings, in their buckets.

    Spark knows buckets of tables alone, so both are declared in the session's catalog, under names
    that follow from where they are; any session that reaches the files can do so.
    """
    buckets = int(spark.read.text(f"{directory}/{_NUMBER}").first()[0])
    found = {}
    for table in _SORTED:
        path = qualified(spark, f"{directory}/{table.name}")
        name = f"postledger_{table.name}_{sha256(path.encode()).hexdigest()[:24]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet CLUSTERED BY (job_url)"
            f" SORTED BY ({', '.join(_SORTED[table])}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        found[table.name] = spark.table(name).select(*table.columns)
    return found


def read_without_url(spark: SparkSession, directory: str) -> DataFrame:
    """The sightings that belong to no posting."""
    return spark.read.schema(FACT_OBSERVATION.schema).parquet(f"{directory}/{_WITHOUT}").select(*FACT_OBSERVATION.columns)


def with_posting(observations: DataFrame, postings: DataFrame, *attributes: str) -> DataFrame:
    """Every sighting of a posting with ``attributes`` of the latter, as ``posting_`` and their names.

    A merge join, which takes facts in equal buckets as they lie and never builds a table of one side.
    """
    known = postings.select(F.col("job_url").alias("_url"), *[F.col(c).alias(f"posting_{c}") for c in attributes])
    return observations.join(known.hint("merge"), F.col("job_url") == F.col("_url")).drop("_url")


def sightings_by_age(observations: DataFrame, postings: DataFrame) -> DataFrame:
    """Sightings by the days since their posting was first seen: (age, sightings, relisted, last).

    ``relisted`` counts those whose title is not the one that the posting has now, ``last`` those on
    the date it was last seen.
    """
    seen = with_posting(observations, postings, "first_seen_date", "last_seen_date", "title")
    return seen.groupBy(F.datediff("ingest_date", "posting_first_seen_date").alias("age")).agg(
        F.count(F.lit(1)).alias("sightings"),
        F.count_if(~F.col("title").eqNullSafe(F.col("posting_title"))).alias("relisted"),
        F.count_if(F.col("ingest_date") == F.col("posting_last_seen_date")).alias("last"),
    )
