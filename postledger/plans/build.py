"""Build the six tables of the model from landed rows."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postledger.operators.dims import (
    COUNTED,
    build_dim_company,
    build_dim_date,
    build_dim_location,
    build_dim_source,
    day_counts,
    dimension_of,
)
from postledger.operators.facts import SOURCES, build_observations, build_postings, roll_up
from postledger.plans.write import replace_partition, write_table, write_together
from postledger.schemas import (
    ALL_TABLES,
    DIM_COMPANY,
    DIM_DATE,
    DIM_LOCATION,
    DIM_SOURCE,
    FACT_OBSERVATION,
    FACT_POSTING,
    Table,
)
from postledger.sources.landed import read_landed, read_landed_json
from postledger.sources.model import read_table


_FROM_OBSERVATIONS = (FACT_POSTING, DIM_DATE)


def model_of(landed: DataFrame, observations: DataFrame | None = None) -> dict[Table, DataFrame]:
    """The six tables of the model as one unevaluated query each, some of them over ``observations`` if given."""
    if observations is None:
        observations = build_observations(landed)
    return {
        DIM_COMPANY: build_dim_company(landed),
        DIM_LOCATION: build_dim_location(landed),
        DIM_SOURCE: build_dim_source(landed),
        DIM_DATE: build_dim_date(observations),
        FACT_OBSERVATION: observations,
        FACT_POSTING: build_postings(observations),
    }


def build_model(landed: DataFrame, model_dir: str) -> dict[str, int]:
    """Write the six tables to ``model_dir``, replacing them; the rows of each.

    The observation fact is written once and read back for what derives from it: that
    cuts the lineage with a table that outlives any executor, and nothing is cached. The
    dimensions read one narrow column of the landed rows each.
    """
    spark = landed.sparkSession
    first = {table: df for table, df in model_of(landed).items() if table not in _FROM_OBSERVATIONS}
    counts = _write(spark, first, model_dir)
    written = model_of(landed, read_table(spark, model_dir, FACT_OBSERVATION))
    counts |= _write(spark, {table: written[table] for table in _FROM_OBSERVATIONS}, model_dir)
    return {table.name: counts[table.name] for table in ALL_TABLES}


def counts_dir(directory: str, table: Table) -> str:
    """Where the day counts of a dimension are kept beside the tables of ``directory``."""
    return f"{directory}/_days_{table.name}"


def write_counts(landed: DataFrame, observations: DataFrame, directory: str) -> None:
    """Write what the dimensions count, a partition per date, each dimension's beside the others'."""
    spark = landed.sparkSession

    def write(table: Table) -> int:
        rows, date = (observations, "ingest_date") if table == DIM_DATE else (landed, "_ingest_date")
        save_counts(day_counts(rows, date, COUNTED[table]), directory, table)
        return 0

    write_together({table.name: partial(write, table) for table in COUNTED}, spark)


def save_counts(counts: DataFrame, directory: str, table: Table) -> None:
    """Write the day counts of a dimension; rebalanced, so that each date ends up in few files."""
    counts.hint("rebalance", "ingest_date").write.mode("overwrite").partitionBy("ingest_date").parquet(counts_dir(directory, table))


def read_counts(spark: SparkSession, directory: str, table: Table) -> DataFrame:
    """The day counts of a dimension, (value, rows, ingest_date); no rows where none were written."""
    kind = "date" if table == DIM_DATE else "string"
    return spark.read.schema(f"value {kind}, rows long, ingest_date date").parquet(counts_dir(directory, table))


def build_with_state(landed: DataFrame, model_dir: str) -> dict[str, int]:
    """``build_model``, and beside the tables what bringing them up to date by one date needs.

    That is the sites of each posting, in a column of the posting fact that readers of the
    model do not see, and the day counts of the dimensions, which are then made of these.
    """
    spark = landed.sparkSession
    counts = _write(spark, {FACT_OBSERVATION: build_observations(landed)}, model_dir)
    written = read_table(spark, model_dir, FACT_OBSERVATION)
    write_counts(landed, written, model_dir)
    writes = {
        table.name: partial(write_table, dimension_of(table, read_counts(spark, model_dir, table)), model_dir, table)
        for table in COUNTED
    }
    writes[FACT_POSTING.name] = partial(write_table, roll_up(written), model_dir, FACT_POSTING, also=[SOURCES])
    counts |= write_together(writes, spark)
    return {table.name: counts[table.name] for table in ALL_TABLES}


def _write(spark: SparkSession, built: dict[Table, DataFrame], model_dir: str) -> dict[str, int]:
    return write_together(
        {table.name: partial(write_table, df, model_dir, table) for table, df in built.items()}, spark
    )


def build_warehouse(spark: SparkSession, landing_dir: str, model_dir: str, storage: str = "parquet") -> dict[str, int]:
    """Build the whole model from a landing directory; the rows of each table.

    ``storage`` is what the rows were landed as, ``"parquet"`` or ``"json"``.
    """
    read = read_landed_json if storage == "json" else read_landed
    return build_model(read(spark, landing_dir), model_dir)


def rebuild_date(landed: DataFrame, model_dir: str, ingest_date: str) -> int:
    """Replace one date of a model's observations by what is landed for it; the rows written.

    A sighting belongs to one date, so only that date is read, deduplicated and written.
    Postings and dimensions follow from all dates; a full build brings those up to date, and
    so does ``publish_date`` for what is published.
    """
    rows = build_observations(landed.filter(F.col("_ingest_date") == ingest_date))
    return replace_partition(rows, f"{model_dir}/{FACT_OBSERVATION.name}", "ingest_date", ingest_date)
