"""Presence bits, spells and sketches, on small tables."""

import datetime as dt
import random
import re

import pytest

from postledger.operators import presence, sketches
from postledger.operators.facts import build_observations
from postledger.plans.land import land, read_sketches
from tests.rows import landed, landed_row
from tests.test_landing import posting, write
from tests.test_plans import plan


def day(n):
    return (dt.date(1969, 11, 1) + dt.timedelta(days=n)).isoformat()


@pytest.fixture(scope="module")
def sightings():
    """(url, site, date) over days on both sides of 1970 and over several words of bits."""
    draw = random.Random(2)
    return {(f"u{draw.randint(0, 5)}", draw.choice(["a", "b"]), day(draw.choice([*range(0, 12), 62, 63, 64, 125, 126, 127, 128, 300]))) for _ in range(150)}


@pytest.fixture(scope="module")
def observations(spark, sightings):
    rows = [landed_row(u, d, s, min_amount=str(len(u + s + d) + int(d[-1]) // 4)) for u, s, d in sightings]
    return build_observations(landed(spark, *rows, landed_row(None, day(3)), landed_row("", day(4))))


def test_open_between(spark, sightings, observations):
    ranges = [(day(0), day(400)), (day(61), day(64)), (day(2), day(2)), (day(63), day(63)), (day(129), day(299)), (day(5), day(127))]
    seen = presence.presence(observations)
    found = {tuple(map(str, r)) for r in presence.open_between(seen, presence.days_of(spark, ranges)).collect()}
    expected = set()
    for first, last in ranges:
        dates = {}
        for u, _, d in {*sightings, ("", "indeed", day(4))}:
            if first <= d <= last:
                dates.setdefault(u, set()).add(d)
        expected |= {(first, last, u, str(len(own)), min(own), max(own)) for u, own in dates.items()}
    assert found == expected
    assert "NestedLoop" not in plan(presence.open_between(seen, presence.days_of(spark, ranges)))


def test_days_add_up_by_or(spark, sightings, observations):
    """Presence of some dates, merged with that of the others, is that of all."""
    from pyspark.sql import functions as F

    early = observations.filter(f"ingest_date < '{day(60)}'")
    parts = presence.presence(early).unionByName(presence.presence(observations.join(early, "ingest_date", "left_anti").select(*observations.columns)))
    merged = parts.groupBy("job_url", "word").agg(F.bit_or("days").alias("days"))
    assert sorted(map(str, merged.collect())) == sorted(map(str, presence.presence(observations).select("job_url", "word", "days").collect()))


def test_visible_spells(sightings, observations):
    rows = {*sightings, ("", "indeed", day(4))}
    # Rows without a URL show that the site was scraped.
    scrapes = {s: sorted({d for _, t, d in {*rows, (None, "indeed", day(3))} if t == s}) for s in ("a", "b", "indeed")}
    expected = set()
    for u, s in {(u, s) for u, s, _ in rows}:
        spell = []
        for d in scrapes[s]:
            if (u, s, d) in rows:
                spell.append(d)
            elif spell:
                expected.add((u, s, spell[0], spell[-1], len(spell)))
                spell = []
        if spell:
            expected.add((u, s, spell[0], spell[-1], len(spell)))
    assert {(r.job_url, r.source_key, str(r.since), str(r.until), r.scrapes) for r in presence.visible_spells(observations).collect()} == expected


def test_salary_spells(spark):
    def bands(*given):
        rows = [landed_row("u", day(n), min_amount=band) for n, band in given]
        return [(r.salary_min, str(r.valid_from), r.valid_to and str(r.valid_to), r.dates)
                for r in presence.salary_spells(build_observations(landed(spark, *rows))).orderBy("valid_from").collect()]

    assert bands((0, "1"), (2, "1"), (5, "2"), (6, None), (7, None), (9, "1")) == [
        (1.0, day(0), day(4), 2), (2.0, day(5), day(5), 1), (None, day(6), day(8), 2), (1.0, day(9), None, 1)]
    assert bands((0, None)) == [(None, day(0), None, 1)]
    assert presence.salary_spells(build_observations(landed(spark, landed_row(None, day(0))))).collect() == []


def test_chosen_dates_prune_partitions_as_the_query_runs(spark, observations, tmp_path):
    observations.write.partitionBy("ingest_date").parquet(f"{tmp_path}/fact")
    dates = observations.select("ingest_date").distinct().selectExpr("ingest_date AS date", "date_format(ingest_date, 'EEEE') AS day_name")
    dates.write.parquet(f"{tmp_path}/dates")
    seen = presence.seen_on(spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/dates").filter("day_name IN ('Saturday', 'Sunday')"))
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", plan(seen))
    assert seen.count() == observations.filter("dayofweek(ingest_date) IN (1, 7)").count() > 0


def test_sketches_of_landed_dates(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    for n in range(3):
        write(source, f"scrape-results-2026-07-2{n}-a.csv", [posting(f"https://x/{i}") for i in range(n * 400, 1000 + n * 400)] + [posting(" ")])
    land(spark, str(source), root)
    ranges = presence.days_of(spark, [(f"2026-07-2{a}", f"2026-07-2{b}") for a in range(3) for b in range(a, 3)] + [("2025-01-01", "2025-02-01")])
    estimated = sketches.distinct_urls(read_sketches(spark, root), ranges)
    for r in estimated.collect():
        truth = 0 if r["last"].year == 2025 else 1000 + 400 * (r["last"] - r["first"]).days
        assert abs(r.urls - truth) <= sketches.BOUND * truth
    text = plan(estimated)
    assert "landing" not in text and "NestedLoop" not in text
