"""Build, contracts and publication."""

import glob

import pytest

from postledger.operators.contracts import (
    ContractViolation,
    check_columns,
    key_violations,
    null_violations,
    reference_violations,
    require_contracts,
)
from postledger.plans import publish
from postledger.plans.build import build_model, build_warehouse, model_of
from postledger.plans.publish import (
    create_catalog,
    publish_full,
    publish_partition,
    published_dir,
    read_published,
    refresh_statistics,
)
from postledger.schemas import ALL_TABLES, DIM_SOURCE, DIMENSIONS, FACT_OBSERVATION, FACT_POSTING, FACTS
from postledger.sources.model import read_model, read_table
from tests.rows import landed, landed_row

COUNTS = {
    "dim_company": 2, "dim_location": 2, "dim_source": 2, "dim_date": 3,
    "fact_posting_observation": 3, "fact_posting": 2,
}


def sightings(**fields):
    return [
        landed_row("https://x/1", "2026-08-21", date_posted="2026-08-20", min_amount="90000", **fields),
        landed_row("https://x/2", "2026-08-21", "company:workday", company="Globex", location="Somewhere",
                   date_posted=None, is_remote=None),
        landed_row("https://x/1", "2026-08-22", date_posted="2026-08-20", min_amount="90000", **fields),
    ]


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    directory = str(tmp_path_factory.mktemp("model") / "m")
    assert build_model(landed(spark, *sightings()), directory) == COUNTS
    return directory


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def by_date(tables):
    found = tables["fact_posting_observation"].groupBy("ingest_date").count().collect()
    return {str(r.ingest_date): r["count"] for r in found}


class TestBuild:
    def test_tables_keep_their_contracts(self, spark, model):
        tables = read_model(spark, model)
        require_contracts(tables)
        for table in ALL_TABLES:
            check_columns(tables[table.name], table)

    def test_equals_the_unwritten_model(self, spark, model):
        for table, df in model_of(landed(spark, *sightings())).items():
            assert rows(df) == rows(read_model(spark, model)[table.name]), table.name

    def test_building_again_replaces(self, spark, model, tmp_path):
        directory = str(tmp_path / "m")
        for given in (sightings() + [landed_row("https://x/9", "2026-08-23")], sightings()):
            counts = build_model(landed(spark, *given), directory)
        assert counts == COUNTS
        for name, df in read_model(spark, directory).items():
            assert df.exceptAll(read_model(spark, model)[name]).isEmpty()
            assert read_model(spark, model)[name].exceptAll(df).isEmpty()

    def test_observations_are_partitioned_by_date(self, model):
        assert len(glob.glob(f"{model}/fact_posting_observation/ingest_date=2026-08-*")) == 2


    def test_builds_from_json_lines(self, spark, model, tmp_path):
        directory = str(tmp_path / "landing")
        given = landed(spark, *sightings())
        given.withColumn("ingest_date", given["_ingest_date"]).write.partitionBy("ingest_date").option("compression", "gzip").json(directory)
        assert build_warehouse(spark, directory, str(tmp_path / "m"), storage="json") == COUNTS
        for name, df in read_model(spark, str(tmp_path / "m")).items():
            assert rows(df) == rows(read_model(spark, model)[name])


class TestContracts:
    def test_declared_columns(self):
        assert FACT_OBSERVATION.columns == [
            "ingest_date", "source_key", "job_url", "title", "company_key", "location_key", "date_posted", "job_type",
            "is_remote", "salary_min", "salary_max", "currency", "salary_interval", "source_file",
        ]
        assert FACT_POSTING.columns == [
            "job_url", "title", "company_key", "location_key", "date_posted", "job_type", "is_remote", "salary_min",
            "salary_max", "currency", "salary_interval", "first_seen_date", "last_seen_date", "observation_count",
            "source_count", "days_visible",
        ]

    def test_dimensions_come_first(self):
        assert ALL_TABLES[: len(DIMENSIONS)] == DIMENSIONS
        assert ALL_TABLES[len(DIMENSIONS):] == FACTS

    def test_another_column_order_or_type_is_refused(self, spark, model):
        df = read_table(spark, model, DIM_SOURCE)
        check_columns(df, DIM_SOURCE)
        for wrong in (df.select("platform", "source_key", "source_type"), df.drop("platform"),
                      df.selectExpr("source_key", "source_type", "1 AS platform")):
            with pytest.raises(ContractViolation, match="dim_source"):
                check_columns(wrong, DIM_SOURCE)

    def test_violations_are_found(self, spark, model):
        tables = read_model(spark, model)
        fact = tables["fact_posting_observation"]
        doubled = fact.unionAll(fact.filter("ingest_date = '2026-08-22'"))
        assert [(r.key, r.rows) for r in key_violations(doubled, FACT_OBSERVATION).collect()] == [
            ('{"ingest_date":"2026-08-22","source_key":"indeed","job_url":"https://x/1"}', 2)]
        nulls = fact.selectExpr(*[f"CAST(NULL AS string) AS {c}" if c == "job_url" else c for c in fact.columns])
        assert [(r.column_name, r.rows) for r in null_violations(nulls, FACT_OBSERVATION).collect()] == [("job_url", 3)]
        tables |= {"dim_source": tables["dim_source"].filter("source_key <> 'indeed'")}
        assert [tuple(r)[1:] for r in reference_violations(tables, FACT_OBSERVATION).collect()] == [
            ("source_key", "indeed", 2)]
        with pytest.raises(ContractViolation, match="fact_posting_observation: 1 broken reference"):
            require_contracts(tables)

    def test_a_null_reference_passes(self, spark):
        tables = model_of(landed(spark, landed_row("https://x/1", "2026-08-21", company=None)))
        require_contracts({table.name: df for table, df in tables.items()})


class TestPublishing:
    def test_nothing_published(self, spark, tmp_path):
        assert published_dir(spark, str(tmp_path / "p")) is None
        with pytest.raises(ValueError, match="nothing published"):
            read_published(spark, str(tmp_path / "p"))

    def test_publishing_again_neither_adds_nor_drifts(self, spark, model, tmp_path):
        root = str(tmp_path / "p")
        assert publish_full(spark, landed(spark, *sightings()), root) == COUNTS
        first = {name: rows(df) for name, df in read_published(spark, root).items()}
        assert publish_full(spark, landed(spark, *sightings()), root) == COUNTS
        assert {name: rows(df) for name, df in read_published(spark, root).items()} == first
        assert first == {name: rows(df) for name, df in read_model(spark, model).items()}

    def test_what_left_the_rows_leaves_the_publication(self, spark, tmp_path):
        root = str(tmp_path / "p")
        publish_full(spark, landed(spark, *sightings(), landed_row("https://x/9", "2026-08-21")), root)
        publish_full(spark, landed(spark, *sightings()), root)
        assert {name: df.count() for name, df in read_published(spark, root).items()} == COUNTS

    def test_a_broken_model_is_not_published(self, spark, tmp_path):
        root = str(tmp_path / "p")
        publish_full(spark, landed(spark, *sightings()), root)
        before = published_dir(spark, root)
        with pytest.raises(ContractViolation, match="fact_posting_observation: 1 broken required .* job_url"):
            publish_full(spark, landed(spark, *sightings(), landed_row(None, "2026-08-21")), root)
        assert published_dir(spark, root) == before

    def test_one_date_is_replaced_and_no_other(self, spark, model, tmp_path):
        root, other = str(tmp_path / "p"), str(tmp_path / "m")
        publish_full(spark, landed(spark, *sightings()), root)
        before = read_published(spark, root)
        files = {p: open(p, "rb").read() for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}
        build_model(landed(spark, *sightings(title="Relisted")), other)
        for _ in range(2):
            assert publish_partition(spark, other, root, "2026-08-21") == {"fact_posting_observation": 2}
        tables = read_published(spark, root)
        assert by_date(tables) == {"2026-08-21": 2, "2026-08-22": 1}
        titles = {(str(r.ingest_date), r.job_url): r.title for r in tables["fact_posting_observation"].collect()}
        assert titles == {("2026-08-21", "https://x/1"): "Relisted", ("2026-08-21", "https://x/2"): "Software Engineer",
                          ("2026-08-22", "https://x/1"): "Software Engineer"}
        assert {p: open(p, "rb").read() for p in files} == files
        # Whoever reads the version before still does.
        assert "Relisted" not in {r.title for r in before["fact_posting_observation"].collect()}
        assert rows(tables["fact_posting"]) == rows(read_model(spark, model)["fact_posting"])

    def test_several_dates_are_replaced(self, spark, tmp_path):
        root, other = str(tmp_path / "p"), str(tmp_path / "m")
        publish_full(spark, landed(spark, *sightings()), root)
        build_model(landed(spark, *[r | {"title": "Relisted"} for r in sightings()]), other)
        for day in ("2026-08-21", "2026-08-22", "2026-08-21"):
            publish_partition(spark, other, root, day)
        assert rows(read_published(spark, root)["fact_posting_observation"]) == rows(read_model(spark, other)["fact_posting_observation"])
        publish_full(spark, landed(spark, *sightings()), root)
        assert {r.title for r in read_published(spark, root)["fact_posting_observation"].collect()} == {"Software Engineer"}

    def test_a_version_number_is_given_out_once(self, spark, tmp_path, monkeypatch):
        root, entered = str(tmp_path / "p"), []
        publish_full(spark, landed(spark, *sightings()), root)
        real = publish._last_entry

        def late(session, where):
            last = real(session, where)
            if not entered:
                entered.append(True)
                publish_full(spark, landed(spark, *sightings()), root)
            return last

        monkeypatch.setattr(publish, "_last_entry", late)
        publish_full(spark, landed(spark, *sightings()), root)
        logged = sorted(glob.glob(f"{root}/versions_log/*.json"))
        assert [p[-6:] for p in logged] == ["1.json", "2.json", "3.json"]
        assert real(spark, root).version == 3

    def test_a_date_the_model_lacks_is_emptied(self, spark, model, tmp_path):
        root, other = str(tmp_path / "p"), str(tmp_path / "m")
        publish_full(spark, landed(spark, *sightings()), root)
        build_model(landed(spark, *sightings()[2:]), other)
        assert publish_partition(spark, other, root, "2026-08-21") == {"fact_posting_observation": 0}
        assert by_date(read_published(spark, root)) == {"2026-08-22": 1}

    def test_an_unknown_source_is_refused(self, spark, model, tmp_path):
        root, other = str(tmp_path / "p"), str(tmp_path / "m")
        publish_full(spark, landed(spark, *sightings()), root)
        build_model(landed(spark, landed_row("https://x/9", "2026-08-21", "no-such-source")), other)
        with pytest.raises(ContractViolation, match="source_key=no-such-source"):
            publish_partition(spark, other, root, "2026-08-21")
        assert by_date(read_published(spark, root)) == {"2026-08-21": 2, "2026-08-22": 1}

    def test_catalog(self, spark, model):
        for _ in range(2):
            create_catalog(spark, model, "postledger_test")
        refresh_statistics(spark, "postledger_test")
        assert {t.name: spark.table(f"postledger_test.{t.name}").count() for t in ALL_TABLES} == COUNTS
        columns = {c.name: c.description for c in spark.catalog.listColumns("postledger_test.fact_posting")}
        assert "not how long" in columns["days_visible"]
        assert "as last seen" in spark.catalog.getTable("postledger_test.fact_posting").description
        stats = spark.sql("DESCRIBE EXTENDED postledger_test.fact_posting").filter("col_name = 'Statistics'").first()
        assert "2 rows" in stats.data_type
