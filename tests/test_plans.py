"""What the plans of the queries must look like to hold at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from postledger.operators.facts import build_observations, build_postings, conform_sightings
from postledger.plans import reports
from postledger.plans.build import build_model, model_of
from postledger.proving import registry
from postledger.schemas import FACT_OBSERVATION, FACT_POSTING, LANDED
from postledger.sources.landed import read_landed
from postledger.sources.model import read_table
from postledger.storage import require_local
from tests.rows import landed, landed_row


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def tables_of(rows):
    return {table.name: df for table, df in model_of(rows).items()}


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    directory = str(tmp_path_factory.mktemp("landing"))
    df = landed(spark, *[landed_row(f"u{n}", f"2026-08-{n:02}") for n in range(1, 9)])
    df.withColumn("ingest_date", F.col("_ingest_date").cast("date")).drop("_ingest_date").write.mode(
        "overwrite").partitionBy("ingest_date").parquet(directory)
    return read_landed(spark, directory)


@pytest.fixture(scope="module")
def model(rows, tmp_path_factory):
    directory = str(tmp_path_factory.mktemp("model") / "m")
    build_model(rows, directory)
    return directory


def test_no_row_leaves_the_engine(rows):
    for name, df in tables_of(rows).items():
        text = plan(df)
        assert not re.search("Python|Pandas|MapInArrow", text), name
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|SinglePartition", text), name


def test_groups_shrink_before_every_shuffle(rows):
    for name, df in tables_of(rows).items():
        text = plan(df, "simple")
        exchanges = len(re.findall(r"Exchange hashpartitioning", text))
        partial = len(re.findall(r"(?:HashAggregate|SortAggregate)\(keys?=.*functions=\[(?:\]|partial_)", text))
        assert exchanges and partial >= exchanges, (name, text)


def test_facts_take_one_shuffle_each(rows, spark, model):
    assert plan(build_observations(rows), "simple").count("Exchange") == 1
    observations = read_table(spark, model, FACT_OBSERVATION)
    assert plan(build_postings(observations), "simple").count("Exchange") == 1


def test_facts_shuffle_texts_as_one(rows, spark, model):
    # A column of each text takes eight bytes and more beside what it holds.
    observations = read_table(spark, model, FACT_OBSERVATION)
    for df, lone in ((build_observations(rows), r"partial_min\(struct\(_packed_0, "), (build_postings(observations), r"partial_min_by\(struct\(_texts, ")):
        assert re.search(lone, plan(df, "simple")), plan(df, "simple")


def test_dimensions_read_one_column(rows):
    tables = tables_of(rows)
    for name, column in (("dim_company", "company"), ("dim_location", "location"), ("dim_source", "site")):
        assert f"ReadSchema: struct<{column}:string>" in plan(tables[name]), name


def test_companies_are_conformed_once_per_spelling(rows):
    text = plan(tables_of(rows)["dim_company"], "simple")
    scan_side = text[text.index("partial_count(1)"):]
    assert "regexp_replace" not in scan_side


def test_one_date_reads_one_partition(spark, model):
    text = plan(reports.open_on_date(read_table(spark, model, FACT_OBSERVATION), "2026-08-03"))
    assert re.search(r"PartitionFilters: \[.*ingest_date.* = 2026-08-03", text)
    assert "ReadSchema: struct<job_url:string>" in text


def test_rebuilding_a_date_reads_one_partition(rows):
    text = plan(build_observations(rows.filter(F.col("_ingest_date") == "2026-08-03")))
    assert re.search(r"PartitionFilters: \[.*ingest_date.* = 2026-08-03", text)


def test_generated_code_stays_small_enough_to_be_compiled(spark, rows):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [int(n) for df in (conform_sightings(rows), *tables_of(rows).values())
                 for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(df, "codegen"))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    # The JVM leaves methods of 8000 bytes and more to its interpreter.
    assert sizes and max(sizes) < 8000


def test_reports_neither_cross_nor_gather(spark, model):
    observations, postings = (read_table(spark, model, t) for t in (FACT_OBSERVATION, FACT_POSTING))
    for df in (reports.weekly_churn(postings), reports.salary_changes(observations), reports.open_by_date(observations)):
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|SinglePartition", plan(df))


def test_intermediates_need_a_shared_folder():
    for master in ("local", "local[*]", "local[8]"):
        require_local(master)
    for master in ("yarn", "k8s://https://h:443", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            require_local(master)


def test_the_landed_schema_is_declared(rows):
    assert rows.columns == LANDED.names
    assert registry.QUERIES
