"""Change sets, differences of versions, and publications brought up to date by what changed."""

import glob
import random
import re
from collections import Counter

import pytest

from postledger.operators import changes
from postledger.operators.changes import GONE, applied, change_set, differing_hashes, folded, version_diff
from postledger.operators.contracts import ContractViolation
from postledger.operators.facts import build_observations, build_postings, merge_postings, roll_up
from postledger.plans import publish, refresh
from postledger.plans.build import build_model
from postledger.plans.publish import publish_full, publish_partition, read_published
from postledger.plans.refresh import compact, publish_changes, publish_date
from postledger.schemas import ALL_TABLES, FACT_OBSERVATION, FACT_POSTING
from postledger.sources.model import read_model
from tests.rows import landed, landed_row
from tests.test_plans import plan

DAYS = [f"2026-08-{n:02}" for n in range(20, 25)]
SCHEMA = "k string, v int, w string"


def some_rows(draw, day, n=12):
    """Sightings of a day: few URLs, several sites and files, every kind of field."""
    return [
        landed_row(
            f"https://x/{draw.randint(1, 9)}", day, draw.choice(["indeed", "linkedin", "company:workday"]),
            company=draw.choice(["Acme Inc.", "ACME", "Globex", None, " "]), location=draw.choice(["Truro, NS, CA", "truro, ns", "Somewhere", None]),
            title=draw.choice(["Engineer", "Cook", None]), date_posted=draw.choice([day, "2026-07-01", ""]),
            min_amount=draw.choice(["1", "2", None]), source_file=f"scrape-results-{day}-{draw.randint(0, 1)}.csv",
        )
        for _ in range(draw.randint(0, n))
    ]


def found(tables):
    return {name: Counter(map(repr, df.collect())) for name, df in tables.items()}


def in_full(spark, rows, directory):
    build_model(landed(spark, *rows), directory)
    return found(read_model(spark, directory))


class TestChangeSets:
    def test_differences(self, spark):
        old = [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("d", 4, "q"), ("d", 4, "q"), (None, 5, "n"), ("e", 6, None), ("f", 7, "f"), ("f", 8, "f")]
        new = [("a", 1, "x"), ("b", 2, "Y"), ("g", 3, "z"), ("d", 4, "q"), (None, 5, None), ("e", 9, "e"), ("f", 7, "f"), ("f", 9, "f"), ("f", 10, "f")]
        rows = version_diff(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"]).collect()
        said = {(r.k, r.change, r.rows, tuple(r.columns), tuple(r.before or ()), tuple(r.after or ())) for r in rows}
        assert said == {
            ("b", "changed", 1, ("w",), ("b", 2, "y"), ("b", 2, "Y")),
            ("c", "removed", 1, (), ("c", 3, "z"), ()),
            ("g", "added", 1, (), (), ("g", 3, "z")),
            ("d", "removed", 1, (), ("d", 4, "q"), ()),
            (None, "changed", 1, ("w",), (None, 5, "n"), (None, 5, None)),
            ("e", "changed", 1, ("v", "w"), ("e", 6, None), ("e", 9, "e")),
            ("f", "removed", 1, (), ("f", 8, "f"), ()),
            ("f", "added", 1, (), (), ("f", 9, "f")),
            ("f", "added", 1, (), (), ("f", 10, "f")),
        } and len(rows) == len(said)

    def test_equal_versions_do_not_differ(self, spark):
        df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), (None, None, None)], SCHEMA)
        assert version_diff(df, df.repartition(5), ["k"]).collect() == []
        nothing = spark.createDataFrame([], SCHEMA)
        assert version_diff(nothing, nothing, ["k"]).collect() == []
        assert {r.change for r in version_diff(nothing, df, ["k"]).collect()} == {"added"}

    def test_only_hashes_of_equal_rows_are_shuffled(self, spark, tmp_path):
        spark.createDataFrame([("a", 1, "x")], SCHEMA).write.parquet(f"{tmp_path}/t")
        df = spark.read.parquet(f"{tmp_path}/t")
        text = plan(differing_hashes(df, df), "simple")
        assert text.count("Exchange") == 1 and "partial_sum(n" in text
        assert "NestedLoop" not in plan(version_diff(df, df, ["k"]))

    def test_rows_that_do_not_differ_are_not_digested_to_be_looked_up(self, spark, tmp_path, monkeypatch):
        plans, real = {}, changes._written
        monkeypatch.setattr(changes, "_written", lambda df, name: plans.update({name: plan(df, "simple")}) or real(df, name))
        for name, rows in (("old", [("a", 1, "x"), ("b", 2, "y")]), ("new", [("a", 1, "x"), ("b", 3, "y")])):
            spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}")
        old, new = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("old", "new"))
        found = changes.differing_rows(old, new).collect()
        assert sorted((r.copies, tuple(r.row)) for r in found) == [(-1, ("b", 2, "y")), (1, ("b", 3, "y"))]
        joins = re.findall(r"Join \[([^\]]*)\]", plans["differing-rows"])
        assert joins and all(keys.startswith("_hash") and "," not in keys for keys in joins)

    @pytest.mark.parametrize("seed", range(2))
    def test_applying_a_change_set_gives_the_new_version(self, spark, seed):
        draw = random.Random(seed)
        keys = [None, *"abcdefgh"]
        versions = []
        for _ in range(4):
            held = {k: (k, draw.randint(0, 1), draw.choice(["x", None])) for k in draw.sample(keys, draw.randint(0, 9))}
            versions.append(spark.createDataFrame(list(held.values()), SCHEMA))
        sets = [change_set(a, b, ["k"]) for a, b in zip(versions, versions[1:], strict=False)]
        for n in range(1, 4):
            assert Counter(applied(versions[0], sets[:n], ["k"]).collect()) == Counter(versions[n].collect())
        assert Counter(applied(versions[0], [folded(sets, ["k"])], ["k"]).collect()) == Counter(versions[3].collect())
        assert applied(versions[0], [], ["k"]) is versions[0]


def test_merging_postings_equals_rolling_up_all(spark):
    for seed in range(2):
        draw = random.Random(seed)
        rows = {day: some_rows(draw, day, 20) for day in DAYS}
        first, second = DAYS[1:4:2], [DAYS[0], DAYS[2], DAYS[4]]
        parts = [build_observations(landed(spark, *[r for day in days for r in rows[day]])) for days in (first, second)]
        whole = build_postings(build_observations(landed(spark, *[r for own in rows.values() for r in own])))
        merged = merge_postings(roll_up(parts[1]), roll_up(parts[0])).unionByName(roll_up(parts[0]).join(parts[1], "job_url", "left_anti"))
        assert Counter(merged.select(*whole.columns).collect()) == Counter(whole.collect())


class TestOneDate:
    def test_equals_a_full_publication(self, spark, tmp_path):
        draw = random.Random(5)
        rows = {day: some_rows(draw, day) for day in DAYS[:3]}
        rows[DAYS[0]].append(landed_row("https://x/0", DAYS[0]))
        root = f"{tmp_path}/p"
        publish_full(spark, landed(spark, *sum(rows.values(), [])), root)
        # A new date at the end, one landed again, one emptied, one before all others, and a compaction between.
        for n, day in enumerate([DAYS[3], DAYS[1], DAYS[2], "2026-08-01", DAYS[1], DAYS[4]]):
            rows[day] = some_rows(draw, day) if day != DAYS[2] else []
            everything = landed(spark, *sum(rows.values(), []))
            counts = publish_date(spark, everything, root, day)
            tables = read_published(spark, root)
            if n % 2:
                assert found(tables) == in_full(spark, sum(rows.values(), []), f"{tmp_path}/m{n}"), day
            assert counts["fact_posting_observation"] == tables["fact_posting_observation"].filter(f"ingest_date = '{day}'").count()
            if n == 3:
                before = found(tables)
                compact(spark, root)
                assert found(read_published(spark, root)) == before

    def test_writes_touched_postings_alone(self, spark, tmp_path):
        root, draw = f"{tmp_path}/p", random.Random(7)
        rows = {day: [landed_row(f"https://x/{day}/{n}", day) for n in range(5)] for day in DAYS}
        publish_full(spark, landed(spark, *sum(rows.values(), [])), root)
        files = {p: open(p, "rb").read() for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}
        old = {r["job_url"] for r in rows[DAYS[1]]}
        rows[DAYS[1]] = [landed_row("https://x/new", DAYS[1]), rows[DAYS[1]][0], landed_row(f"https://x/{DAYS[3]}/0", DAYS[1])]
        draw.shuffle(rows[DAYS[1]])
        counts = publish_date(spark, landed(spark, *sum(rows.values(), [])), root, DAYS[1])
        (written,) = [p for p in glob.glob(f"{root}/*/_changes_fact_posting")]
        changed = spark.read.parquet(written)
        assert {r.job_url for r in changed.collect()} == old | {r["job_url"] for r in rows[DAYS[1]]}
        assert {r.job_url for r in changed.filter(GONE).collect()} == old - {r["job_url"] for r in rows[DAYS[1]]}
        assert counts["fact_posting"] == 7 and counts["fact_posting_observation"] == 3
        assert {p: open(p, "rb").read() for p in files} == files
        assert read_published(spark, root, 1)["fact_posting"].count() == 25

    def test_plan(self, spark, tmp_path):
        root = f"{tmp_path}/p"
        publish_full(spark, landed(spark, *[landed_row(f"u{n}", day) for n, day in enumerate(DAYS)]), root)
        entry = publish.entry_of(publish._last_entry(spark, root))
        observed = refresh._observed(spark, root, entry)
        day = observed.filter(f"ingest_date = DATE '{DAYS[1]}'")
        text = plan(refresh.posting_changes(day, day, observed, refresh._rolled(spark, root, entry)))
        assert "LeftSemi" in text and "LeftAnti" in text
        assert f"= {DAYS[1]}" in text
        assert not any(word in text for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window"))

    def test_change_sets_are_folded(self, spark, tmp_path, monkeypatch):
        monkeypatch.setattr(refresh, "MOST_CHANGE_SETS", 2)
        root, draw = f"{tmp_path}/p", random.Random(1)
        rows = {day: some_rows(draw, day) for day in DAYS[:2]}
        publish_full(spark, landed(spark, *sum(rows.values(), [])), root)
        for day in [DAYS[2], DAYS[0], DAYS[3], DAYS[0]]:
            rows[day] = some_rows(draw, day)
            publish_date(spark, landed(spark, *sum(rows.values(), [])), root, day)
            sets = publish.entry_of(publish._last_entry(spark, root))["changes"]["fact_posting"]
            assert len(sets) <= 2
        assert found(read_published(spark, root)) == in_full(spark, sum(rows.values(), []), f"{tmp_path}/m")

    def test_follows_the_entry_that_came_between(self, spark, tmp_path, monkeypatch):
        root, entered = f"{tmp_path}/p", []
        rows = [landed_row("u1", DAYS[0]), landed_row("u2", DAYS[1])]
        publish_full(spark, landed(spark, *rows), root)
        rows += [landed_row("u1", DAYS[2]), landed_row("u3", DAYS[3])]
        real = publish._last_entry

        def late(session, where, *version):
            last = real(session, where, *version)
            if not entered and len(glob.glob(f"{root}/date-*")) == 1:
                entered.append(True)
                publish_date(spark, landed(spark, *rows), root, DAYS[2])
            return last

        monkeypatch.setattr(publish, "_last_entry", late)
        publish_date(spark, landed(spark, *rows), root, DAYS[3])
        assert entered and found(read_published(spark, root)) == in_full(spark, rows, f"{tmp_path}/m")

    def test_what_left_postings_behind_is_refused(self, spark, tmp_path):
        root, rows = f"{tmp_path}/p", [landed_row("u1", DAYS[0])]
        with pytest.raises(ValueError, match="nothing published"):
            publish_date(spark, landed(spark, *rows), root, DAYS[0])
        publish_full(spark, landed(spark, *rows), root)
        build_model(landed(spark, *rows), f"{tmp_path}/m")
        publish_partition(spark, f"{tmp_path}/m", root, DAYS[0])
        with pytest.raises(ValueError, match="in full first"):
            publish_date(spark, landed(spark, *rows), root, DAYS[0])

    def test_a_broken_date_is_not_published(self, spark, tmp_path):
        root, rows = f"{tmp_path}/p", [landed_row("u1", DAYS[0])]
        publish_full(spark, landed(spark, *rows), root)
        with pytest.raises(ContractViolation, match="job_url"):
            publish_date(spark, landed(spark, *rows, landed_row(None, DAYS[1])), root, DAYS[1])
        assert read_published(spark, root)["fact_posting_observation"].count() == 1


class TestChangesOfAModel:
    def test_writes_the_change_set_and_equals_a_full_publication(self, spark, tmp_path):
        root, draw = f"{tmp_path}/p", random.Random(3)
        rows = {day: some_rows(draw, day) for day in DAYS[:3]}
        publish_full(spark, landed(spark, *sum(rows.values(), [])), root)
        for n in range(2):
            rows[DAYS[n]] = some_rows(draw, DAYS[n])
            wanted = in_full(spark, sum(rows.values(), []), f"{tmp_path}/m{n}")
            before = found(read_published(spark, root))
            counts = publish_changes(spark, read_model(spark, f"{tmp_path}/m{n}"), root)
            assert found(read_published(spark, root)) == wanted
            (written,) = {p for p in glob.glob(f"{root}/changes-*")} - ({first} if n else set())
            first = written
            for table in ALL_TABLES:
                held = spark.read.parquet(f"{written}/_changes_{table.name}")
                gone, came = (sum((a - b).values()) for a, b in ((before[table.name], wanted[table.name]), (wanted[table.name], before[table.name])))
                own = counts[table.name]
                assert held.count() == sum(own.values())
                assert (own["updated"] + own["deleted"], own["updated"] + own["inserted"]) == (gone, came)
        entries = len(glob.glob(f"{root}/versions_log/*.json"))
        assert not any(sum(c.values()) for c in publish_changes(spark, read_model(spark, f"{tmp_path}/m1"), root).values())
        assert len(glob.glob(f"{root}/versions_log/*.json")) == entries
        with pytest.raises(ValueError, match="in full first"):
            publish_date(spark, landed(spark, *rows[DAYS[0]]), root, DAYS[0])
        with pytest.raises(ValueError, match="compact"):
            publish_partition(spark, f"{tmp_path}/m1", root, DAYS[0])
        compact(spark, root)
        assert found(read_published(spark, root)) == wanted
        publish_partition(spark, f"{tmp_path}/m0", root, DAYS[1])
        assert publish._last_entry(spark, root).changes == {}

    def test_compaction_takes_swapped_dates_together(self, spark, tmp_path):
        root = f"{tmp_path}/p"
        rows = [landed_row(f"u{n}", day) for n, day in enumerate(DAYS)]
        publish_full(spark, landed(spark, *rows), root)
        build_model(landed(spark, *[r | {"title": "Again"} for r in rows[1:]]), f"{tmp_path}/m")
        for day in DAYS:
            publish_partition(spark, f"{tmp_path}/m", root, day)
        tables = read_published(spark, root)
        assert plan(tables["fact_posting_observation"]).count("Scan parquet") > 8
        before = found(tables)
        compact(spark, root)
        after = read_published(spark, root)
        assert found(after) == before and after["fact_posting_observation"].count() == 4
        assert plan(after["fact_posting_observation"], "simple").count("FileScan parquet") == 2
        compact(spark, root)
        assert found(read_published(spark, root)) == before


def test_tables_of_changes_are_declared():
    assert FACT_OBSERVATION.key == ("ingest_date", "source_key", "job_url") and FACT_POSTING.key == ("job_url",)
