"""The database publication: its statements, their order, and what a failure leaves.

No database runs here; a recording connection stands in for one.
"""

import re

import pytest

from pyspark.sql import functions as F

from postledger.plans import publish_jdbc as jdbc
from postledger.plans.build import build_model
from postledger.schemas import ALL_TABLES, FACT_OBSERVATION
from postledger.sources.model import read_model
from tests.rows import landed, landed_row


class Recorder:
    """A DB-API connection that notes what happens to it, staged tables included."""

    def __init__(self, fail_at=None):
        self.log, self.fail_at = [], fail_at

    def cursor(self):
        return self

    def execute(self, statement):
        if self.fail_at and self.fail_at in statement:
            raise RuntimeError("refused")
        self.log.append(statement)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def stage(self, df, name, url, properties):
        df.write.format("noop").mode("overwrite").save()
        self.log.append(f"stage {name} {df.count()}")

    def plain(self):
        """What happened, without the name of the run."""
        return [re.sub("staged_[0-9a-f]{12}", "RUN", entry) for entry in self.log]


BOUNDED = {"numPartitions": "4"}


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    directory = str(tmp_path_factory.mktemp("jdbc") / "m")
    build_model(landed(spark, landed_row("u1", "2026-08-21"), landed_row("u1", "2026-08-22")), directory)
    return directory


def test_all_tables_are_replaced_in_one_transaction(spark, model):
    db = Recorder()
    counts = jdbc.publish_full_jdbc(spark, model, "jdbc:x", BOUNDED, db, stage=db.stage)
    assert counts == {
        "dim_company": 1, "dim_location": 1, "dim_source": 1, "dim_date": 2, "fact_posting_observation": 2, "fact_posting": 1}
    log = db.plain()
    staged, moved = log[:6], log[6 : log.index("commit")]
    assert [s.split()[1:] for s in staged] == [[f"wh.{t.name}_RUN", str(counts[t.name])] for t in ALL_TABLES]
    assert moved[0] == "TRUNCATE " + ", ".join(f"wh.{t.name}" for t in ALL_TABLES)
    assert [m.split()[2] for m in moved[1:]] == [f"wh.{t.name}" for t in ALL_TABLES]
    assert all(", ".join(t.columns) in m and m.endswith(f"wh.{t.name}_RUN") for t, m in zip(ALL_TABLES, moved[1:]))
    assert "ANALYZE wh.fact_posting" in log[log.index("commit") :]


def test_loads_share_no_staging_table(spark, model):
    logs = []
    for _ in range(2):
        db = Recorder()
        jdbc.publish_partition_jdbc(spark, model, "2026-08-21", "jdbc:x", BOUNDED, db, stage=db.stage)
        logs.append(db)
    assert logs[0].log != logs[1].log and logs[0].plain() == logs[1].plain()
    assert all(len(name) <= 63 for name in re.findall(r"wh\.(\w+)", " ".join(logs[0].log)))


def test_connections_must_be_bounded(spark, model):
    db = Recorder()
    with pytest.raises(ValueError, match="numPartitions"):
        jdbc.publish_full_jdbc(spark, model, "jdbc:x", {}, db, stage=db.stage)
    assert not db.log


def test_a_refused_row_leaves_the_present_tables(spark, model):
    db = Recorder(fail_at="INSERT INTO wh.fact_posting_observation")
    with pytest.raises(RuntimeError):
        jdbc.publish_full_jdbc(spark, model, "jdbc:x", BOUNDED, db, stage=db.stage)
    assert db.log[-1] == "rollback" and "commit" not in db.log


def test_one_date_is_replaced_in_one_transaction(spark, model):
    db = Recorder()
    counts = jdbc.publish_partition_jdbc(spark, model, "2026-08-21", "jdbc:x", BOUNDED, db, stage=db.stage)
    columns = ", ".join(FACT_OBSERVATION.columns)
    assert counts == {"fact_posting_observation": 1}
    assert db.plain() == [
        "stage wh.fact_posting_observation_RUN 1",
        "DELETE FROM wh.fact_posting_observation WHERE ingest_date = DATE '2026-08-21'",
        f"INSERT INTO wh.fact_posting_observation ({columns})"
        f" SELECT {columns} FROM wh.fact_posting_observation_RUN",
        "commit",
        "DROP TABLE IF EXISTS wh.fact_posting_observation_RUN",
        "commit",
    ]


def test_the_schema_may_be_created_again_and_again():
    statements = jdbc.schema_statements()
    created = [s for s in statements if s.startswith("CREATE")]
    assert len(created) == 7 and all("IF NOT EXISTS" in s for s in created)
    fact = next(s for s in created if "wh.fact_posting_observation " in s)
    assert "source_key text NOT NULL REFERENCES wh.dim_source(source_key)" in fact
    assert "PRIMARY KEY (ingest_date, source_key, job_url)" in fact
    assert [s for s in statements if s.startswith("COMMENT ON TABLE")] and "company's" not in fact


def test_changes_are_merged_in_one_transaction(spark, model):
    old, db = read_model(spark, model), Recorder()
    fact = old["fact_posting"]
    new = old | {
        "fact_posting": fact.withColumn("title", F.lit("Cook")),
        "dim_date": old["dim_date"].filter("day = 21"),
    }
    counts = jdbc.publish_changes_jdbc(old, new, "jdbc:x", BOUNDED, db, stage=db.stage)
    assert counts == dict.fromkeys(old, 0) | {"fact_posting": 1, "dim_date": 1}
    log = db.plain()
    moved = log[6 : log.index("commit")]
    assert [m.split()[:3] for m in moved[:6]] == [["MERGE", "INTO", f"wh.{t.name}"] for t in ALL_TABLES]
    assert [m.split()[:3] for m in moved[6:]] == [["DELETE", "FROM", f"wh.{t.name}"] for t in reversed(ALL_TABLES)]
    merge = moved[[t.name for t in ALL_TABLES].index("fact_posting_observation")]
    assert "ON t.ingest_date = s.ingest_date AND t.source_key = s.source_key AND t.job_url = s.job_url WHEN MATCHED" in merge
    assert "UPDATE SET title = s.title" in merge and "WHEN NOT MATCHED AND NOT s._gone THEN INSERT (ingest_date, " in merge
    assert moved[6].endswith("WHERE t.job_url = s.job_url AND s._gone")
    failing = Recorder(fail_at="DELETE FROM wh.dim_date")
    with pytest.raises(RuntimeError):
        jdbc.publish_changes_jdbc(old, new, "jdbc:x", BOUNDED, failing, stage=failing.stage)
    assert failing.log[-1] == "rollback" and "commit" not in failing.log
