"""The queries, each over whole tables of one scale-factor directory."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postledger.functions import strip_blanks, with_amounts, with_company, with_location, with_posted_date
from postledger.functions.location import LOCATION_COLUMNS
from postledger.operators import changes, presence, sketches
from postledger.operators.contracts import key_violations, null_violations, reference_violations
from postledger.operators.dims import (
    build_dim_company,
    build_dim_date,
    build_dim_location,
    build_dim_source,
)
from postledger.operators.facts import build_observations, build_postings, conform_sightings
from postledger.operators.fingerprint import fingerprint
from postledger.operators.grain import smallest_per_key
from postledger.plans import reports
from postledger.plans.buckets import read_bucketed, sightings_by_age, write_bucketed
from postledger.plans.build import build_model, build_warehouse, rebuild_date
from postledger.plans.land import land, landing_dir, read_manifest, read_sketches
from postledger.plans.publish import (
    create_catalog,
    publish_full,
    publish_partition,
    read_published,
    refresh_statistics,
)
from postledger.plans.refresh import publish_changes, publish_date
from postledger.plans.write import write_together
from postledger.proving.files import csv_cell, csv_line, header_of, remove_files, replace_files, write_scrapes
from postledger.proving.scrapes import (
    SUPPLIERS_PER_SHARD,
    as_reprocessed,
    as_scraped,
    landed_orders,
    order_lines,
    orders_of,
    reprocessed_lines,
    scraped_documents,
    scraped_orders,
)
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
from postledger.sources.landed import landed_fields, read_landed, read_landed_json
from postledger.sources.model import read_model, read_table
from postledger.sources.scrapes import ingest_date, raw_scrape_paths, read_scrapes, scrape_files
from postledger.storage import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

# The date that is landed or published again on its own.
AGAIN = "1997-04-01"

SCRAPED = (
    "id", "site", "job_url", "title", "company", "location", "date_posted", "job_type", "is_remote",
    "min_amount", "max_amount", "currency", "interval", "emails", "description",
)
# What each of a date's three files calls its columns: all of them, all backwards, and
# without currency and interval but with one of its own. Files of the last kind end their
# lines with a carriage return, too.
HEADERS = (
    SCRAPED,
    SCRAPED[::-1],
    tuple("benefits" if c == "currency" else c for c in SCRAPED if c != "interval"),
)
# Rows of the first kind of file that end early have this many fields.
SHORT = 4

_made: dict[tuple, str] = {}


def _once(spark: SparkSession, name: str, sf_dir: str, make: Callable[[str], object]) -> str:
    """Directory of written input that several queries of a session share."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _made:
        directory = scratch_dir(spark, f"postledger-{name}")
        make(directory)
        _made[key] = directory
    return _made[key]


# --- scrape files -----------------------------------------------------------

def _part(index: int):
    return F.col("file").contains(f"-part{index}-")


def _scrape_lines(orders: DataFrame, word: str = "") -> DataFrame:
    """Orders with the file that each is scraped to and its line there; ``word`` goes before titles."""
    scraped = as_scraped(orders, *orders.columns).withColumn("title", F.concat(F.lit(word), F.col("title")))
    rows = scraped.withColumns({"file": F.col("_source_file"), "benefits": F.lit("dental")})
    # Cells are chosen first and made into a line by one expression, not one per kind of file:
    # the generated method would be one that the JVM only interprets.
    kinds = [F.array(*header) for header in (*HEADERS, SCRAPED[:SHORT])]
    chosen = (
        F.when(_part(0) & (F.col("_order") % 13 == 0), kinds[-1])
        .when(_part(0), kinds[0]).when(_part(1), kinds[1]).otherwise(kinds[2])
    )
    end = F.when(_part(0) | _part(1), F.lit("")).otherwise(F.lit("\r"))
    line = F.concat(F.array_join(F.transform(chosen, csv_cell), ","), end)
    return rows.select(*orders.columns, "file", line.alias("line"))


def _write_orders(orders: DataFrame, directory: str, word: str = "") -> None:
    """Write orders as scrape files."""
    kinds = [header_of(header) for header in HEADERS]
    kinds[2] = F.concat(kinds[2], F.lit("\r"))
    header = F.when(_part(0), kinds[0]).when(_part(1), kinds[1]).otherwise(kinds[2])
    write_scrapes(orders, partial(_scrape_lines, word=word), header, directory)


def _write_again(spark: SparkSession, sf_dir: str, directory: str) -> None:
    """Write the scrapes of one date as another scrape of it found them."""
    orders = orders_of(spark, sf_dir)
    again = as_scraped(orders, *orders.columns).filter(F.col("_ingest_date") == AGAIN).select(*orders.columns)
    _write_orders(again, directory, "Again ")


def _write_order_scrapes(spark: SparkSession, sf_dir: str, directory: str) -> None:
    columns = ("id", "job_url")

    def derived(lines: DataFrame) -> DataFrame:
        line = csv_line(*[F.col(c) for c in columns]).alias("line")
        return as_reprocessed(lines, *lines.columns).select(*lines.columns, F.col("_source_file").alias("file"), line)

    def strays(suppliers: DataFrame) -> DataFrame:
        shard = (F.col("s_suppkey") / SUPPLIERS_PER_SHARD).cast("long").cast("string")
        file = F.concat(F.lit("contacts-export-"), shard, F.lit(".csv"))
        return suppliers.withColumns({"file": file, "line": csv_line(F.col("s_name"))})

    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    lines, here = order_lines(spark, sf_dir), f"{directory}/scrapes"
    write_together({
        "raw": partial(_write_orders, orders_of(spark, sf_dir), directory),
        "derived": partial(write_scrapes, lines, derived, header_of(columns), f"{directory}/derived", here),
        "strays": partial(write_scrapes, suppliers, strays, header_of(["name"]), f"{directory}/strays", here),
        # What lies in a folder below is no scrape, whatever the folder is called.
        "aside": partial(write_scrapes, lines, derived, header_of(columns), f"{directory}/aside", f"{here}/archive=old"),
    }, spark)


def _order_scrapes(spark: SparkSession, sf_dir: str) -> str:
    """Directory with the scrapes of all orders, derived files and a stray one beside them."""
    made = _once(
        spark, "scrapes", sf_dir,
        lambda d: _write_order_scrapes(spark, sf_dir, d),
    )
    return f"{made}/scrapes"


def _landed_scrapes(spark: SparkSession, sf_dir: str) -> str:
    """Root under which the scrapes of all orders are landed."""
    source = _order_scrapes(spark, sf_dir)
    return _once(spark, "landed", sf_dir, lambda d: land(spark, source, d))


def land_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scrape_files(spark, _order_scrapes(spark, sf_dir))
    return files.select("file_name", ingest_date(F.col("file_name")).alias("ingest_date"), "derived")


def land_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_scrapes(spark, raw_scrape_paths(spark, _order_scrapes(spark, sf_dir)))
    return rows.select(*[c for c in SCRAPED if c != "emails"], "benefits", "ingest_date", "_source_file")


def land_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = read_landed(spark, landing_dir(_landed_scrapes(spark, sf_dir)))
    return landed.groupBy("_ingest_date", "_source_file").agg(F.count(F.lit(1)).alias("rows"))


def land_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(directory: str) -> None:
        cells = [F.col(c) for c in SCRAPED]
        line = F.when(F.col("_order") % 97 == 0, csv_line(*cells, F.lit(""))).when(
            F.col("_order") % 89 == 0, csv_line(*cells, F.lit("one"), F.lit("more"))
        ).otherwise(csv_line(*cells))

        def lines_of(orders: DataFrame) -> DataFrame:
            rows = as_scraped(orders, *orders.columns)
            return rows.select(*orders.columns, F.col("_source_file").alias("file"), line.alias("line"))

        write_scrapes(orders_of(spark, sf_dir), lines_of, header_of(SCRAPED), directory)

    source = _once(spark, "wide", sf_dir, make) + "/scrapes"
    wide = read_scrapes(spark, raw_scrape_paths(spark, source), wide_rows="only")
    return wide.select("id", "job_url", "description", "ingest_date", "_source_file")


def land_drop_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.read.parquet(landing_dir(_landed_scrapes(spark, sf_dir)))
    texts = [F.col(f"`{c}`").cast("string") for c in landed.columns]
    leaked = reduce(lambda a, b: a | b, [F.coalesce(t.contains("@mail.example"), F.lit(False)) for t in texts])
    return landed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(leaked).alias("rows_with_email"),
        F.lit(int("emails" in landed.columns)).alias("sensitive_columns"),
    )


def land_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("id", "site", "job_url", "title", "emails", "description")

    def make(directory: str) -> None:
        def lines_of(rows: DataFrame) -> DataFrame:
            return rows.withColumns({"file": F.col("_source_file"), "line": csv_line(*[F.col(c) for c in columns])})

        write_scrapes(scraped_documents(spark, sf_dir), lines_of, header_of(columns), f"{directory}/source")
        land(spark, f"{directory}/source/scrapes", f"{directory}/root")

    root = _once(spark, "documents", sf_dir, make) + "/root"
    landed = spark.read.parquet(landing_dir(root))
    return landed.select(
        F.col("id").cast("long").alias("doc_id"), "site", "title", "ingest_date",
        F.char_length("description").alias("length"), F.sha2("description", 256).alias("digest"),
    )


def land_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(directory: str) -> None:
        source, root = f"{directory}/source", f"{directory}/root"
        _write_order_scrapes(spark, sf_dir, source)
        land(spark, f"{source}/scrapes", root)
        # Files of that date are replaced; derived and stray ones beside them are those that were there.
        _write_again(spark, sf_dir, f"{directory}/again")
        replace_files(spark, f"{directory}/again/scrapes", f"{source}/scrapes", lambda name: AGAIN in name)
        for _ in range(2):
            land(spark, f"{source}/scrapes", root, only_date=AGAIN)

    root = _once(spark, "replaced", sf_dir, make) + "/root"
    return read_landed(spark, landing_dir(root))


# The date of which a file vanishes between two landings.
LOST = "1996-01-01"


def land_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is landed after files of one date were replaced and one of another was lost, and which dates were landed again."""

    def make(directory: str) -> None:
        source, root = f"{directory}/source", f"{directory}/root"
        _write_order_scrapes(spark, sf_dir, source)
        land(spark, f"{source}/scrapes", root)
        _write_again(spark, sf_dir, f"{directory}/again")
        replace_files(spark, f"{directory}/again/scrapes", f"{source}/scrapes", lambda name: AGAIN in name)
        remove_files(spark, f"{source}/scrapes", lambda name: f"{LOST}-part1-" in name)
        landed = [land(spark, f"{source}/scrapes", root, changed_only=True).select("ingest_date") for _ in range(2)]
        runs = [df.withColumn("run", F.lit(n)) for n, df in enumerate(landed, start=2)]
        runs[0].unionAll(runs[1]).write.parquet(f"{directory}/runs")

    directory = _once(spark, "changed", sf_dir, make)
    files = read_landed(spark, landing_dir(f"{directory}/root")).groupBy("_ingest_date", "_source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("title").alias("first_title")
    )
    runs = spark.read.parquet(f"{directory}/runs").groupBy(F.col("ingest_date").cast("string").alias("_ingest_date")).agg(
        F.array_join(F.array_sort(F.collect_list(F.col("run").cast("string"))), ",").alias("landed_again")
    )
    return files.join(runs, "_ingest_date", "left").withColumn("landed_again", F.coalesce("landed_again", F.lit("")))


def land_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``land_csv``, read by tasks that share each file although fields hold line ends."""
    paths = raw_scrape_paths(spark, _order_scrapes(spark, sf_dir))
    rows = read_scrapes(spark, paths, split_quoted=True)
    return rows.select(*[c for c in SCRAPED if c != "emails"], "benefits", "ingest_date", "_source_file")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest that landing all orders has left."""
    return read_manifest(spark, _landed_scrapes(spark, sf_dir)).withColumns({
        "source_files": F.concat_ws(",", "source_files"),
        "dropped_columns": F.concat_ws(",", "dropped_columns"),
    })


# --- landed rows ------------------------------------------------------------

def read_landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(directory: str) -> None:
        rows = scraped_orders(spark, sf_dir).drop("emails", "_order")
        rows = rows.withColumn("ingest_date", F.col("_ingest_date").cast("date")).drop("_ingest_date")
        rows.write.partitionBy("ingest_date").parquet(f"{directory}/landing")

    return read_landed(spark, _once(spark, "parquet", sf_dir, make) + "/landing")


def read_landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(directory: str) -> None:
        rows = scraped_orders(spark, sf_dir)
        whole = F.to_json(F.struct(*[c for c in rows.columns if c not in ("emails", "_order")]))
        line = F.when(F.col("_order") % 17 == 0, F.substring(whole, 1, 40)).otherwise(whole)
        lines = rows.select(F.col("_ingest_date").alias("ingest_date"), line.alias("value"))
        lines.write.partitionBy("ingest_date").option("compression", "gzip").text(f"{directory}/landing")

    directory = _once(spark, "lines", sf_dir, make)
    return read_landed_json(spark, f"{directory}/landing", "*.txt.gz")


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    line = F.concat(F.lit('{"id": "'), F.col("event_id"), F.lit('", "title": '), F.col("props"), F.lit("}"))
    fields = landed_fields(line)
    inner = F.from_json(fields["title"], "k STRING")
    return events.select("event_id", fields["id"].alias("id"), inner["k"].alias("k"), fields["site"].alias("site"))


# --- conforming -------------------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scraped_orders(spark, sf_dir).withColumnRenamed("_order", "order_key")


def conform_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_company(_orders(spark, sf_dir)).select("order_key", "company_key", "company_name")


def conform_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_location(_orders(spark, sf_dir)).select("order_key", *LOCATION_COLUMNS)


def conform_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"salary_min": "min_amount", "salary_max": "max_amount"}
    return with_amounts(_orders(spark, sf_dir), columns).select("order_key", *columns)


def conform_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_posted_date(_orders(spark, sf_dir)).select("order_key", "date_posted")


# --- facts and dimensions ---------------------------------------------------

def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_observations(landed_orders(spark, sf_dir))


def observations_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.to_date("ts").alias("day"), "event_type", "user_id", "event_id", "value"
    )
    return smallest_per_key(events, ["day", "event_type", "user_id"], order=["event_id"])


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_postings(observations(spark, sf_dir))


def dim_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_company(landed_orders(spark, sf_dir))


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_location(landed_orders(spark, sf_dir))


def dim_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_source(landed_orders(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_date(observations(spark, sf_dir))


# --- whole models -----------------------------------------------------------

def _landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed rows of all orders."""
    return read_landed(spark, landing_dir(_landed_scrapes(spark, sf_dir)))


def _model(spark: SparkSession, sf_dir: str) -> str:
    """Directory of the model of what is landed of all orders."""
    landing = landing_dir(_landed_scrapes(spark, sf_dir))
    return _once(spark, "model", sf_dir, lambda d: build_warehouse(spark, landing, d))


def _again(landed: DataFrame, word: str) -> DataFrame:
    """The rows with titles that tell them from those they replace."""
    return landed.withColumn("title", F.concat(F.lit(f"{word} "), F.col("title")))


def rebuild_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations after one date was rebuilt from rows landed again."""

    def make(directory: str) -> None:
        landed = _landed_rows(spark, sf_dir)
        build_model(landed, directory)
        for _ in range(2):
            rebuild_date(_again(landed, "Again"), directory, AGAIN)

    return read_table(spark, _once(spark, "rebuilt", sf_dir, make), FACT_OBSERVATION)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_counts(read_model(spark, _model(spark, sf_dir)))


def warehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From scrape files to the six tables."""
    root = _landed_scrapes(spark, sf_dir)
    directory = scratch_dir(spark, "postledger-warehouse")
    build_warehouse(spark, landing_dir(root), directory)
    return reports.table_counts(read_model(spark, directory))


def contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values in each declared column of each table, read back by the contract."""
    counted = []
    for table in ALL_TABLES:
        df = read_table(spark, _model(spark, sf_dir), table)
        one = df.agg(*[F.count(c).alias(c) for c in table.columns])
        counted.append(
            one.unpivot([], table.columns, "column_name", "values")
            .select(F.lit(table.name).alias("table_name"), "column_name", "values")
        )
    return reduce(DataFrame.unionAll, counted)


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(conform_sightings(landed_orders(spark, sf_dir)), FACT_OBSERVATION)


def null_violations_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_violations(conform_sightings(landed_orders(spark, sf_dir)), FACT_OBSERVATION)


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations of all sites against the dimensions of one."""
    known = _landed_rows(spark, sf_dir).filter(F.col("site") == "indeed")
    tables = {
        DIM_COMPANY.name: build_dim_company(known),
        DIM_LOCATION.name: build_dim_location(known),
        DIM_SOURCE.name: build_dim_source(known),
        FACT_OBSERVATION.name: read_table(spark, _model(spark, sf_dir), FACT_OBSERVATION),
    }
    return reference_violations(tables, FACT_OBSERVATION)


def schema_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory, database = _model(spark, sf_dir), f"postledger_{uuid4().hex[:8]}"
    for _ in range(2):
        create_catalog(spark, directory, database)
    refresh_statistics(spark, database)
    described = []
    for table in ALL_TABLES:
        name = f"{database}.{table.name}"
        columns = spark.catalog.listColumns(name)
        statistics = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").select("data_type")
        rows = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long")
        known = {r.rows for r in statistics.select(rows.alias("rows")).collect()}
        described.append(
            spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(table.name).alias("table_name"),
                F.lit(len(columns)).alias("columns"),
                F.lit(sum(bool(c.description) for c in columns)).alias("commented"),
                "rows",
                F.lit(known.pop() if known else None).cast("long").alias("rows_known"),
            )
        )
    result = scratch_dir(spark, "postledger-catalog")
    reduce(DataFrame.unionAll, described).write.parquet(result)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.parquet(result)


def _published(table: Table) -> Query:
    """One table of what is published, the second time that it was."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def make(directory: str) -> None:
            for _ in range(2):
                publish_full(spark, _landed_rows(spark, sf_dir), directory)

        return read_published(spark, _once(spark, "published", sf_dir, make))[table.name]

    return query


def publish_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published observations after one date was replaced twice."""

    def make(directory: str) -> None:
        landed = _landed_rows(spark, sf_dir)
        build_model(_again(landed, "Relisted"), f"{directory}/relisted")
        publish_full(spark, landed, f"{directory}/root")
        for _ in range(2):
            publish_partition(spark, f"{directory}/relisted", f"{directory}/root", AGAIN)

    return read_published(spark, _once(spark, "one-date", sf_dir, make) + "/root")["fact_posting_observation"]


def _relisted(landed: DataFrame) -> DataFrame:
    """The rows, those of one date as another scrape of it found them: some gone, some under another URL."""
    kept = landed.filter((F.col("_ingest_date") != AGAIN) | (F.col("title") != "Engineer 3"))
    that_day = F.col("_ingest_date") == AGAIN
    moved = that_day & (F.col("title") == "Engineer 5")
    return kept.withColumns({
        "job_url": F.when(moved, F.concat("job_url", F.lit("/moved"))).otherwise(F.col("job_url")),
        "title": F.when(that_day, F.concat(F.lit("Relisted "), F.col("title"))).otherwise(F.col("title")),
    })


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """Root of a publication in full, of one date of it again, and of that date again."""

    def make(directory: str) -> None:
        landed = _landed_rows(spark, sf_dir)
        publish_full(spark, landed, directory)
        for _ in range(2):
            publish_date(spark, _relisted(landed), directory, AGAIN)

    return _once(spark, "refreshed", sf_dir, make)


def _refreshed_table(table: Table) -> Query:
    """One table of what is published after one date was, and all that follows from it."""
    return lambda spark, sf_dir: read_published(spark, _refreshed(spark, sf_dir))[table.name]


def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the facts of two published versions differ."""
    root = _refreshed(spark, sf_dir)
    old, new = (read_published(spark, root, version) for version in (1, 3))
    found = []
    for table in (FACT_OBSERVATION, FACT_POSTING):
        diff = changes.version_diff(old[table.name], new[table.name], table.key)
        row = F.coalesce("after", "before")
        found.append(diff.select(
            F.lit(table.name).alias("table_name"), "job_url", "change", "rows", F.concat_ws(",", "columns").alias("columns"),
            row["source_key" if table == FACT_OBSERVATION else "title"].alias("detail"),
        ))
    return reduce(DataFrame.unionAll, found)


def _delta(spark: SparkSession, sf_dir: str) -> str:
    """A publication brought up to date by change sets, and beside it what each of them held."""

    def make(directory: str) -> None:
        landed = _landed_rows(spark, sf_dir)
        publish_full(spark, landed, f"{directory}/root")
        build_model(_relisted(landed), f"{directory}/model")
        wanted = read_model(spark, f"{directory}/model")
        counts = publish_changes(spark, wanted, f"{directory}/root")
        again = publish_changes(spark, wanted, f"{directory}/root")
        held = [(name, *n.values(), sum(again[name].values())) for name, n in counts.items()]
        columns = "table_name string, inserted long, updated long, deleted long, written_again long"
        spark.createDataFrame(held, columns).write.parquet(f"{directory}/counts")

    return _once(spark, "delta", sf_dir, make)


def publish_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted, updated and deleted of each table, and what publishing the same again wrote."""
    return spark.read.parquet(f"{_delta(spark, sf_dir)}/counts")


def _delta_table(table: Table) -> Query:
    """One table of what is published by change sets."""
    return lambda spark, sf_dir: read_published(spark, f"{_delta(spark, sf_dir)}/root")[table.name]


def land_json_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations of a model built from scrapes that are landed as JSON lines."""

    def make(directory: str) -> None:
        land(spark, _order_scrapes(spark, sf_dir), f"{directory}/root", storage="json")
        build_warehouse(spark, landing_dir(f"{directory}/root"), f"{directory}/model", storage="json")

    return read_table(spark, _once(spark, "json", sf_dir, make) + "/model", FACT_OBSERVATION)


def rerun_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed_rows(spark, sf_dir)
    again = _once(spark, "rerun", sf_dir, lambda d: build_model(landed, d))
    runs = [read_model(spark, directory) for directory in (_model(spark, sf_dir), again)]
    compared = []
    for table in ALL_TABLES:
        first, second = (
            run[table.name].agg(F.count(F.lit(1)).alias("rows"), fingerprint(table.columns).alias("print"))
            for run in runs
        )
        compared.append(
            first.unionAll(second).agg(
                F.max("rows").alias("rows"),
                ((F.min("rows") == F.max("rows")) & (F.min("print") == F.max("print"))).alias("equal"),
            ).select(F.lit(table.name).alias("table_name"), "rows", "equal")
        )
    return reduce(DataFrame.unionAll, compared)


# --- reports ----------------------------------------------------------------

def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.corpus_profile(scraped_orders(spark, sf_dir))


def id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.id_collisions(landed_orders(spark, sf_dir))


def derived_new_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.derived_new_urls(landed_orders(spark, sf_dir), reprocessed_lines(spark, sf_dir))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _model(spark, sf_dir), FACT_OBSERVATION)


def _posted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _model(spark, sf_dir), FACT_POSTING)


def open_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.open_on_date(_observed(spark, sf_dir), AGAIN)


def open_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.open_by_date(_observed(spark, sf_dir))


# Ranges that span gaps, one day, two words of bits, and nothing.
RANGES = (("1992-01-01", "1992-12-31"), ("1994-02-01", "1996-08-15"), ("1997-04-01", "1997-04-01"), ("1990-01-01", "1999-01-01"), ("1980-01-01", "1980-02-01"))


def open_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings open in each of some ranges, from the bits that a model's observations were made to."""
    made = _once(spark, "presence", sf_dir, lambda d: presence.presence(_observed(spark, sf_dir)).write.parquet(f"{d}/presence"))
    return presence.open_between(spark.read.parquet(f"{made}/presence"), presence.days_of(spark, RANGES))


def visible_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence.visible_spells(_observed(spark, sf_dir))


def salary_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence.salary_spells(_observed(spark, sf_dir))


def weekend_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was seen on scrape dates that are weekends, the dates chosen by their dimension."""
    weekends = read_table(spark, _model(spark, sf_dir), DIM_DATE).filter(F.col("day_name").isin("Saturday", "Sunday"))
    seen = presence.seen_on(_observed(spark, sf_dir), weekends, "day_name")
    return seen.groupBy("ingest_date", "day_name", "source_key").agg(F.count(F.lit(1)).alias("sightings"))


def urls_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct URLs of ranges of dates, and whether what the sketches say is within its bound of them."""
    ranges = presence.days_of(spark, RANGES)
    estimated = sketches.distinct_urls(read_sketches(spark, _landed_scrapes(spark, sf_dir)), ranges)
    landed = _landed_rows(spark, sf_dir).select(F.col("_ingest_date").cast("date").alias("ingest_date"), F.nullif(strip_blanks(F.col("job_url")), F.lit("")).alias("url"))
    met = sketches.dates_within(ranges).join(landed.distinct(), "ingest_date")
    exact = met.groupBy("first", "last").agg(F.count_distinct("url").alias("found"))
    counted = estimated.join(exact, ["first", "last"], "left").withColumn("exact", F.coalesce("found", F.lit(0)))
    return counted.select(
        "first", "last", "exact", (F.abs(F.col("urls") - F.col("exact")) <= sketches.BOUND * F.col("exact")).alias("within_bound")
    )


def weekly_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.weekly_churn(_posted(spark, sf_dir))


def days_visible_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.days_visible_distribution(_posted(spark, sf_dir))


def days_visible_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.days_visible_summary(_posted(spark, sf_dir))


def salary_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.salary_changes(_observed(spark, sf_dir))


def _bucketed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both facts of the model in as many buckets as a shuffle has partitions."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = _model(spark, sf_dir)
    return read_bucketed(spark, _once(spark, "buckets", sf_dir, lambda d: write_bucketed(spark, model, d, buckets)))


def salary_changes_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.salary_changes(_bucketed(spark, sf_dir)[FACT_OBSERVATION.name])


def sightings_by_age_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _bucketed(spark, sf_dir)
    return sightings_by_age(facts[FACT_OBSERVATION.name], facts[FACT_POSTING.name])


def salary_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.salary_profile(_observed(spark, sf_dir))


def postings_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim_location = read_table(spark, _model(spark, sf_dir), DIM_LOCATION)
    return reports.postings_by_region(_posted(spark, sf_dir), dim_location)


QUERIES: dict[str, Query] = {
    "observations": observations,
    "observations_events": observations_events,
    "postings": postings,
    "conform_company": conform_company,
    "conform_location": conform_location,
    "conform_amounts": conform_amounts,
    "conform_dates": conform_dates,
    "dim_company": dim_company,
    "dim_location": dim_location,
    "dim_source": dim_source,
    "dim_date": dim_date,
    "land_select": land_select,
    "land_csv": land_csv,
    "land_lineage": land_lineage,
    "land_wide_rows": land_wide_rows,
    "land_drop_sensitive": land_drop_sensitive,
    "land_documents": land_documents,
    "land_replace": land_replace,
    "land_changed": land_changed,
    "land_split": land_split,
    "manifest": manifest,
    "read_landed": read_landed_rows,
    "read_landed_json": read_landed_lines,
    "json_extract": json_extract,
    "rebuild_date": rebuild_one_date,
    "table_counts": table_counts,
    "warehouse_counts": warehouse_counts,
    "contract_columns": contract_columns,
    "pk_violations": pk_violations,
    "null_violations": null_violations_found,
    "fk_violations": fk_violations,
    "schema_catalog": schema_catalog,
    "publish_full": _published(FACT_POSTING),
    **{f"publish_full_{table.name}": _published(table) for table in ALL_TABLES if table != FACT_POSTING},
    "land_json_build": land_json_build,
    "publish_partition": publish_one_date,
    "refresh_postings": _refreshed_table(FACT_POSTING),
    **{f"refresh_{table.name}": _refreshed_table(table) for table in ALL_TABLES if table != FACT_POSTING},
    "version_diff": version_diff,
    "publish_delta": publish_delta,
    **{f"publish_delta_{table.name}": _delta_table(table) for table in ALL_TABLES},
    "rerun_equal": rerun_equal,
    "corpus_profile": corpus_profile,
    "id_collisions": id_collisions,
    "derived_new_urls": derived_new_urls,
    "open_on_date": open_on_date,
    "open_by_date": open_by_date,
    "open_between": open_between,
    "visible_spells": visible_spells,
    "salary_spells": salary_spells,
    "weekend_sightings": weekend_sightings,
    "urls_by_range": urls_by_range,
    "weekly_churn": weekly_churn,
    "days_visible_dist": days_visible_dist,
    "days_visible_summary": days_visible_summary,
    "salary_changes": salary_changes,
    "salary_changes_bucketed": salary_changes_bucketed,
    "sightings_by_age": sightings_by_age_bucketed,
    "salary_profile": salary_profile,
    "postings_by_region": postings_by_region,
}
