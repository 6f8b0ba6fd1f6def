"""Grain of the facts, survivors of repeated sightings, and the posting snapshot."""

import datetime as dt
import random

from pyspark.sql import functions as F

from postledger.operators.facts import build_observations, build_postings
from postledger.operators.grain import packed, smallest_per_key, unpacked
from postledger.schemas import FACT_OBSERVATION, FACT_POSTING
from tests.rows import landed, landed_row

URL = "https://x/1"


def observed(spark, *rows):
    return build_observations(landed(spark, *rows)).collect()


def posted(spark, *rows):
    return build_postings(build_observations(landed(spark, *rows))).collect()


def day(n):
    return f"2026-08-{n:02}"


class TestObservations:
    def test_days_and_sites_are_sightings_of_their_own(self, spark):
        assert len(observed(spark, landed_row(URL, day(1)), landed_row(URL, day(2)))) == 2
        assert len(observed(spark, landed_row(URL, day(1)), landed_row(URL, day(1), "linkedin"))) == 2

    def test_a_repeated_sighting_counts_once(self, spark):
        assert len(observed(spark, landed_row(URL, day(1)), landed_row(URL, day(1)))) == 1

    def test_the_first_source_file_survives(self, spark):
        rows = [
            landed_row(URL, day(1), title="First", source_file=f"scrape-results-{day(1)}-local-indeed.csv"),
            landed_row(URL, day(1), title="Second", source_file=f"scrape-results-{day(1)}-a-indeed.csv"),
        ]
        assert [r.title for r in observed(spark, *rows)] == ["Second"]

    def test_ties_within_a_file_are_settled_the_same_way_in_any_order(self, spark):
        rows = [landed_row(URL, day(1), id="7", title=f"Title {n}", location=None if n % 2 else "CA") for n in range(40)]
        survivors = set()
        for seed in range(3):
            random.Random(seed).shuffle(rows)
            df = landed(spark, *rows).repartition(7)
            survivors |= {(r.title, r.location_key) for r in build_observations(df).collect()}
        assert survivors == {("Title 0", "||ca")}

    def test_null_keys_group_and_stay(self, spark):
        rows = observed(spark, landed_row(None, day(1)), landed_row(None, day(1)), landed_row("", day(1)))
        assert sorted(str(r.job_url) for r in rows) == ["", "None"]

    def test_fields_are_conformed(self, spark):
        row = observed(spark, landed_row(
            URL, day(1), date_posted="", min_amount="90000", max_amount="n/a", is_remote="TRUE",
            currency="CAD", interval="yearly", job_type="fulltime"))[0]
        assert row.asDict() == {
            "ingest_date": dt.date(2026, 8, 1), "source_key": "indeed", "job_url": URL,
            "title": "Software Engineer", "company_key": "acme", "location_key": "truro|ns|ca",
            "date_posted": None, "job_type": "fulltime", "is_remote": True, "salary_min": 90000.0,
            "salary_max": None, "currency": "CAD", "salary_interval": "yearly",
            "source_file": f"scrape-results-{day(1)}-local-indeed.csv",
        }
        assert list(row.asDict()) == FACT_OBSERVATION.columns

    def test_remote_has_three_values(self, spark):
        rows = [landed_row(f"u{i}", day(1), is_remote=v) for i, v in enumerate(["True", "false", "", "yes", None])]
        found = {r.job_url: r.is_remote for r in observed(spark, *rows)}
        assert [found[f"u{i}"] for i in range(5)] == [True, False, False, False, None]

    def test_an_impossible_date_does_not_fail_the_run(self, spark):
        assert observed(spark, landed_row(URL, day(1), date_posted="2026-02-30"))[0].date_posted is None


class TestPostings:
    def test_three_days_are_one_posting(self, spark):
        rows = posted(spark, *[landed_row(URL, day(n)) for n in (1, 2, 3)])
        assert [(r.observation_count, r.source_count) for r in rows] == [(3, 1)]

    def test_the_last_sighting_gives_the_attributes(self, spark):
        rows = [landed_row(URL, day(5), title="New title"), landed_row(URL, day(1), title="Old title")]
        row = posted(spark, *rows)[0]
        assert (row.title, row.first_seen_date, row.last_seen_date, row.days_visible) == (
            "New title", dt.date(2026, 8, 1), dt.date(2026, 8, 5), 5)

    def test_one_day_is_one_day_visible(self, spark):
        assert posted(spark, landed_row(URL, day(1)))[0].days_visible == 1

    def test_sites_of_one_day_count_as_one_observation(self, spark):
        row = posted(spark, landed_row(URL, day(1)), landed_row(URL, day(2)), landed_row(URL, day(2), "linkedin"))[0]
        assert (row.source_count, row.observation_count) == (2, 2)

    def test_sites_of_the_last_day_are_settled_by_name(self, spark):
        rows = [
            landed_row(URL, day(2), "linkedin", title="Linked"), landed_row(URL, day(2), "indeed", title="Indeed"),
            landed_row(URL, day(1), "a", title="Older"),
        ]
        for order in (rows, rows[::-1]):
            assert posted(spark, *order)[0].title == "Indeed"

    def test_no_url_is_no_posting_but_an_empty_one_is(self, spark):
        rows = posted(spark, landed_row(None, day(1)), landed_row("", day(1)))
        assert [r.job_url for r in rows] == [""]

    def test_missing_sources_are_not_counted(self, spark):
        row = posted(spark, landed_row(URL, day(1), None), landed_row(URL, day(1)))[0]
        assert row.source_count == 1

    def test_columns(self, spark):
        assert build_postings(build_observations(landed(spark, landed_row(URL, day(1))))).columns == FACT_POSTING.columns

    def test_equals_brute_force_where_one_key_holds_a_third_of_the_rows(self, spark):
        pick = random.Random(3)
        rows = [
            landed_row("" if pick.random() < 0.34 else f"u{pick.randrange(60)}", day(pick.randrange(1, 15)),
                       pick.choice(["indeed", "linkedin", "company:x"]), title=f"t{n}")
            for n in range(900)
        ]
        survivors = {}
        for r in rows:
            key = (r["_ingest_date"], r["site"], r["job_url"])
            if key not in survivors or (r["id"], r["title"]) < (survivors[key]["id"], survivors[key]["title"]):
                survivors[key] = r
        expected = {}
        for url in {r["job_url"] for r in rows}:
            seen = [r for (d, s, u), r in survivors.items() if u == url]
            days, sites = {r["_ingest_date"] for r in seen}, {r["site"] for r in seen}
            last = min((r for r in seen if r["_ingest_date"] == max(days)), key=lambda r: r["site"])
            expected[url] = (last["title"], min(days), max(days), len(days), len(sites))
        found = {
            r.job_url: (r.title, str(r.first_seen_date), str(r.last_seen_date), r.observation_count, r.source_count)
            for r in posted(spark, *rows)
        }
        assert found == expected


def test_smallest_per_key_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "b", 1), (1, None, 9), (None, "a", 1), (None, "a", 0)], "k int, o string, v int")
    rows = smallest_per_key(df, ["k"], ["o"]).orderBy(F.col("k").asc_nulls_first()).collect()
    assert [tuple(r) for r in rows] == [(None, "a", 0), (1, None, 9)]


TEXTS = (None, "", "\0", "\0\0", "\0\1", "\0\2", "\1", "\1\0", "\1\1", "\1\2", "\2", "+", "a", "a\0", "a\0b", "a\1", "a\1b", "ab", "é", "日本", "\U0001f600")


def test_packed_texts_sort_as_apart_and_come_back(spark):
    pairs = [(a, b) for a in TEXTS for b in TEXTS]
    df = spark.createDataFrame(random.Random(2).sample(pairs, len(pairs)), "a string, b string")
    rows = df.select("a", "b", packed(["a", "b"]).alias("both")).select("a", "b", unpacked(F.col("both")).alias("back"), "both").orderBy("both").collect()
    assert [(r.a, r.b) for r in rows] == [tuple(r) for r in df.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()).collect()]
    assert all(r.back == [r.a, r.b] for r in rows)


def test_smallest_per_key_among_texts_of_any_shape(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(9), *rng.choices(TEXTS, k=2), rng.randrange(2), *rng.choices(TEXTS, k=3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, a string, b string, n int, c string, d string, e string")
    expected = {}
    for row in rows:
        # NULL first, then by UTF-8, as Spark sorts texts.
        rank = [(v is not None, v.encode() if isinstance(v, str) else v) for v in (row[2], row[1], *row[3:])]
        expected[row[0]] = min(expected.get(row[0], (rank, row)), (rank, row), key=lambda found: found[0])
    assert {tuple(r) for r in smallest_per_key(df, ["k"], ["b"]).collect()} == {row for _, row in expected.values()}
