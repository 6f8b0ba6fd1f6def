"""Facts in buckets: what they hold, and that nothing is shuffled for a question per posting."""

import re

import pytest
from pyspark.sql import functions as F

from postledger.plans import reports
from postledger.plans.buckets import read_bucketed, read_without_url, sightings_by_age, with_posting, write_bucketed
from postledger.plans.build import build_model
from postledger.schemas import FACT_OBSERVATION, FACT_POSTING
from postledger.sources.model import read_table
from tests.rows import landed, landed_row
from tests.test_plans import plan

BUCKETS = 5


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    """Postings seen on several dates and sites, a third of the sightings without a URL."""
    rows = [
        landed_row(f"u{n % 17}", f"2026-08-{1 + n % 9:02}", "ab"[n % 2], title=f"T{n % 4}", min_amount=str(n % 3))
        for n in range(120)
    ]
    rows += [landed_row(None, f"2026-08-{1 + n % 9:02}", f"s{n}") for n in range(60)]
    directory = str(tmp_path_factory.mktemp("model") / "m")
    build_model(landed(spark, *rows), directory)
    return directory


@pytest.fixture(scope="module")
def bucketed(spark, model, tmp_path_factory):
    directory = str(tmp_path_factory.mktemp("it's") / "b")
    return directory, write_bucketed(spark, model, directory, BUCKETS)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_every_row_is_kept(spark, model, bucketed):
    directory, counts = bucketed
    read, without = read_bucketed(spark, directory), read_without_url(spark, directory)
    for table in (FACT_POSTING, FACT_OBSERVATION):
        whole = read_table(spark, model, table)
        again = read[table.name].unionByName(without) if table == FACT_OBSERVATION else read[table.name]
        assert rows_of(again) == rows_of(whole)
        assert counts[table.name] == whole.count()
    assert without.count() == 60 and without.filter("job_url IS NOT NULL").isEmpty()


def test_a_bucket_is_one_file(spark, bucketed):
    for df in read_bucketed(spark, bucketed[0]).values():
        files = df.select(F.input_file_name().alias("file"), "job_url").distinct().collect()
        assert len({row.file for row in files}) <= BUCKETS
        assert len({row.job_url for row in files}) == len(files)


def test_questions_per_posting_shuffle_no_sighting(spark, bucketed, no_broadcast):
    read = read_bucketed(spark, bucketed[0])
    postings, observations = read[FACT_POSTING.name], read[FACT_OBSERVATION.name]
    for df in (with_posting(observations, postings, "title"), reports.salary_changes(observations)):
        text = plan(df, "simple")
        assert "Exchange" not in text and "Bucketed: true" in text, text
    # Counts by age are shuffled, as summed up in each task.
    text = plan(sightings_by_age(observations, postings), "simple")
    assert len(re.findall(r"Exchange", text)) == 1 and "partial_count" in text[text.index("Exchange"):]


def test_answers_are_those_of_the_model(spark, model, bucketed):
    read = read_bucketed(spark, bucketed[0])
    observations = read_table(spark, model, FACT_OBSERVATION)
    postings = read_table(spark, model, FACT_POSTING)
    assert rows_of(reports.salary_changes(read[FACT_OBSERVATION.name])) == rows_of(reports.salary_changes(observations))
    found = sightings_by_age(read[FACT_OBSERVATION.name], read[FACT_POSTING.name])
    assert rows_of(found) == rows_of(sightings_by_age(observations, postings))
    assert found.agg(F.sum("sightings")).first()[0] == observations.filter("job_url IS NOT NULL").count()
    assert found.agg(F.sum("last")).first()[0] >= postings.count()


def test_a_directory_is_written_once(spark, model, bucketed):
    with pytest.raises(ValueError, match="new directory"):
        write_bucketed(spark, model, bucketed[0], BUCKETS + 1)
    with pytest.raises(ValueError, match="at least one"):
        write_bucketed(spark, model, bucketed[0], 0)


def test_empty_facts(spark, tmp_path):
    for table in (FACT_POSTING, FACT_OBSERVATION):
        spark.createDataFrame([], table.schema).write.parquet(str(tmp_path / "m" / table.name))
    assert set(write_bucketed(spark, str(tmp_path / "m"), str(tmp_path / "b"), 3).values()) == {0}
    assert all(df.isEmpty() for df in read_bucketed(spark, str(tmp_path / "b")).values())
    assert read_without_url(spark, str(tmp_path / "b")).isEmpty()
