"""Conforming rules, each fed a table of cases and read back as a table."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postledger.functions import (
    amount,
    fold_case,
    posted_date,
    strip_blanks,
    with_company,
    with_location,
)
from postledger.functions.location import LOCATION_COLUMNS


def apply(spark, texts, transform):
    """The transformed row of each text, in order."""
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw string")
    return [row for row in transform(df).orderBy("n").collect()]


def companies(spark, *texts):
    return [(r.company_key, r.company_name) for r in apply(spark, texts, lambda df: with_company(df, "raw"))]


def locations(spark, *texts):
    rows = apply(spark, texts, lambda df: with_location(df, "raw"))
    return [tuple(r[c] for c in LOCATION_COLUMNS) for r in rows]


class TestCompany:
    def test_spellings_of_one_company_share_a_key(self, spark):
        pairs = [
            ("Larkfield", "Larkfield Inc."), ("Brontide", "Brontide Corporation"), ("Quillmere", "Quillmere Ltd."),
            ("Tallowby", "Tallowby, LLC."), ("Orrin Vale", "Orrin Vale Incorporated"), ("Petrel", "Petrel GmbH"),
            ("Sablefin Marine", "SABLEFIN-MARINE, Inc"), ("OakRill", "Oakrill"), ("Town of Marlow", "TOWN OF MARLOW"),
            ("Dunmore", "Dunmore PLC."), ("Kestrel & Moor", "Kestrel Moor, Limited"),
        ]
        keys = [key for key, _ in companies(spark, *[t for pair in pairs for t in pair])]
        assert keys[::2] == keys[1::2]
        assert len(set(keys)) == len(pairs)

    def test_national_entities_and_namesakes_stay_apart(self, spark):
        pairs = [
            ("Norvane", "Norvane Canada"), ("Pell & Sons", "Pell & Sons Canada"), ("The Copper Kettle", "The Copper Kettle Canada"),
            ("Finch Motors", "Finch Security"), ("Harrow", "Harrow One"),
        ]
        keys = [key for key, _ in companies(spark, *[t for pair in pairs for t in pair])]
        assert all(a != b for a, b in zip(keys[::2], keys[1::2]))

    def test_names_are_kept_as_written(self, spark):
        assert companies(spark, "  Mirelle, Inc.  ") == [("mirelle", "Mirelle, Inc.")]

    def test_nothing_stated(self, spark):
        assert companies(spark, None, "", "   ", "\xa0\t") == [(None, None)] * 4

    def test_legal_forms(self, spark):
        assert companies(spark, "Limited", "Incline", "Inc. Magazine", "Limited_Co") == [
            ("limited", "Limited"), ("incline", "Incline"), ("magazine", "Inc. Magazine"),
            ("limitedco", "Limited_Co"),
        ]

    def test_letters_outside_ascii_leave_no_trace(self, spark):
        assert companies(spark, "Société Générale", "日本", "Éinc") == [
            ("socitgnrale", "Société Générale"), (None, "日本"), ("inc", "Éinc"),
        ]


@pytest.fixture(scope="module")
def parsed(spark):
    texts = [
        "Guelph, ON, CA", "Guelph, Ontario, Canada", "Truro, NS, CA", "Fresno, CA, US", "CA",
        "Kelowna, British Columbia, Canada", "Lethbridge, AB, CA", "Lubbock, TX, US",
        "Worcester, Massachusetts, United States", "Sudbury, Ontario", "Spokane, WA", "Truro, NS",
        "Amarillo, TX", "Guelph, ON, N1G 2W1", "Remote, US", "Guelph, TX, CA", "9 DOCK LANE:GUELPH",
        "Guelph Main Office", "Regina - 12 Pine; Gander - Gull Rd E; Truro - Mill Ln", "",
        None, "truro, ns, ca", "Truro, Nova Scotia, Canada", "Amherst, NS, CA",
        "Fresno, CA", "Bremen, DE", "Lévis, QC, Canada", "Québec", " ,, ", "Remote",
        "Wing 2\xa0, Level 3 ,Truro ,\tNS, , CA,", "Guelph, ON, n1g2w1", "N1G 2W1", "X0E 0T0, CA",
        "Remote, Remote, NS", "Straße, NS", "US", "New York, USA", "Washington", "CA, CA", "CA, CA, CA",
        "NB, USA", "Sudbury, Ontario, N1G 2W1, Canada",
    ]
    return dict(zip(texts, locations(spark, *texts)))


class TestLocation:
    @pytest.mark.parametrize("text,expected", [
        ("Guelph, ON, CA", ("guelph|on|ca", "Guelph", "ON", "Ontario", "CA", "Canada")),
        ("Guelph, Ontario, Canada", ("guelph|on|ca", "Guelph", "ON", "Ontario", "CA", "Canada")),
        ("Truro, NS, CA", ("truro|ns|ca", "Truro", "NS", "Nova Scotia", "CA", "Canada")),
        ("Fresno, CA, US", ("fresno|ca|us", "Fresno", "CA", "California", "US", "United States")),
        ("CA", ("||ca", None, None, None, "CA", "Canada")),
        ("Kelowna, British Columbia, Canada", ("kelowna|bc|ca", "Kelowna", "BC", "British Columbia", "CA", "Canada")),
        ("Lethbridge, AB, CA", ("lethbridge|ab|ca", "Lethbridge", "AB", "Alberta", "CA", "Canada")),
        ("Lubbock, TX, US", ("lubbock|tx|us", "Lubbock", "TX", "Texas", "US", "United States")),
        ("Worcester, Massachusetts, United States", ("worcester|ma|us", "Worcester", "MA", "Massachusetts", "US", "United States")),
        ("Sudbury, Ontario", ("sudbury|on|ca", "Sudbury", "ON", "Ontario", "CA", "Canada")),
        ("Spokane, WA", ("spokane|wa|us", "Spokane", "WA", "Washington", "US", "United States")),
        ("Truro, NS", ("truro|ns|ca", "Truro", "NS", "Nova Scotia", "CA", "Canada")),
        ("Amarillo, TX", ("amarillo|tx|us", "Amarillo", "TX", "Texas", "US", "United States")),
        ("Guelph, ON, N1G 2W1", ("guelph|on|ca", "Guelph", "ON", "Ontario", "CA", "Canada")),
        ("Guelph, ON, n1g2w1", ("guelph|on|ca", "Guelph", "ON", "Ontario", "CA", "Canada")),
        ("Remote, US", ("||us", None, None, None, "US", "United States")),
        ("US", ("||us", None, None, None, "US", "United States")),
        ("Fresno, CA", ("fresno||ca", "Fresno", None, None, "CA", "Canada")),
        ("Bremen, DE", ("bremen|de|us", "Bremen", "DE", "Delaware", "US", "United States")),
        ("Lévis, QC, Canada", ("lévis|qc|ca", "Lévis", "QC", "Quebec", "CA", "Canada")),
        ("Wing 2\xa0, Level 3 ,Truro ,\tNS, , CA,", (
            "wing 2, level 3, truro|ns|ca", "Wing 2, Level 3, Truro", "NS", "Nova Scotia", "CA", "Canada")),
        ("X0E 0T0, CA", ("x0e 0t0||ca", "X0E 0T0", None, None, "CA", "Canada")),
        ("Remote, Remote, NS", ("remote, remote|ns|ca", "Remote, Remote", "NS", "Nova Scotia", "CA", "Canada")),
        ("Straße, NS", ("strasse|ns|ca", "Straße", "NS", "Nova Scotia", "CA", "Canada")),
        ("New York, USA", ("|ny|us", None, "NY", "New York", "US", "United States")),
        ("Washington", ("|wa|us", None, "WA", "Washington", "US", "United States")),
    ])
    def test_resolved(self, parsed, text, expected):
        assert parsed[text] == (*expected, True)

    @pytest.mark.parametrize("text,key", [
        ("Guelph, TX, CA", "raw:guelph, tx, ca"),
        ("9 DOCK LANE:GUELPH", "raw:9 dock lane:guelph"),
        ("Guelph Main Office", "raw:guelph main office"),
        ("Regina - 12 Pine; Gander - Gull Rd E; Truro - Mill Ln",
         "raw:regina - 12 pine; gander - gull rd e; truro - mill ln"),
        ("", "raw:"), (None, "raw:"), (" ,, ", "raw:,,"), ("Québec", "raw:québec"), ("Remote", "raw:remote"),
        ("N1G 2W1", "raw:n1g 2w1"), ("CA, CA", "raw:ca, ca"), ("NB, USA", "raw:nb, usa"),
    ])
    def test_unresolved_keeps_its_text(self, parsed, text, key):
        assert parsed[text] == (key, None, None, None, None, None, False)

    def test_only_the_last_token_may_be_a_country_or_a_postal_code(self, parsed):
        assert parsed["CA, CA, CA"][-1] is False
        assert parsed["Sudbury, Ontario, N1G 2W1, Canada"] == (
            "sudbury, ontario, n1g 2w1||ca", "Sudbury, Ontario, N1G 2W1", None, None, "CA", "Canada", True)

    def test_case_and_spelling_do_not_split_a_place(self, parsed):
        assert parsed["truro, ns, ca"][0] == parsed["Truro, Nova Scotia, Canada"][0]
        assert parsed["Truro, NS, CA"][0] != parsed["Amherst, NS, CA"][0]


class TestAmount:
    def test_figures(self, spark):
        texts = [
            "120000", "85000.50", "0", " 7 ", "\xa07\u2003", "1_000", "1e3", "5.", ".5", "-2", "+2", "1_0.0_1e1_0",
            None, "", "  ", "competitive", "nan-ish", "nan", "inf", "-inf", "Infinity", "1d", "1f", "0x1p3",
            "1e400", "-1e400", "_1", "1_", "1__0", ".", "e5", "1e", "1 000", "1,000", "--1", "1_.5", "1._5",
        ]
        rows = apply(spark, texts, lambda df: df.withColumn("x", amount(F.col("raw"))))
        assert [r.x for r in rows] == [as_float(t) for t in texts]

    @settings(max_examples=20, deadline=None)
    @given(st.lists(st.text(alphabet="0123456789._eE+- \tnaifx", max_size=8), min_size=40, max_size=80))
    def test_agrees_with_what_a_float_reads(self, spark, texts):
        rows = apply(spark, texts, lambda df: df.withColumn("x", amount(F.col("raw"))))
        assert [r.x for r in rows] == [as_float(t) for t in texts]


def as_float(text):
    try:
        value = float(text)
    except (TypeError, ValueError):
        return None
    return value if math.isfinite(value) else None


class TestPostedDate:
    def test_dates(self, spark):
        cases = {
            "2026-08-03": "2026-08-03", "2026-08-03 00:00:00": "2026-08-03", " 2026-08-03\n": "2026-08-03",
            "2026-08-04T09:15:00Z": "2026-08-04", "2026-08-04T23:59:59+09:00": "2026-08-04",
            "2024-02-29": "2024-02-29",
            None: None, "": None, "  ": None, "yesterday": None, "2026-13-01": None, "2026-08-00": None,
            "03/08/2026": None, "2026-8-3": None, "2026-02-30": None, "2026-02-29": None, "2026-08-03 noon": None,
            "2026-08-03T09:15": None, "2026-08-03 00:00:00\nmore": None, "2026-08-031": None,
        }
        rows = apply(spark, list(cases), lambda df: df.withColumn("x", posted_date(F.col("raw"))))
        assert [r.x and str(r.x) for r in rows] == list(cases.values())


class TestText:
    def test_strips_every_blank(self, spark):
        blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
        texts = [b + "a b" + b for b in blanks] + ["\u200ba\u200b", "\ufeffa"]
        rows = apply(spark, texts, lambda df: df.withColumn("x", strip_blanks(F.col("raw"))))
        assert [r.x for r in rows] == [t.strip() for t in texts]

    def test_folds_case_as_comparison_does(self, spark):
        texts = ["ÀÉ", "Straße", "STRASSE", "ΣΑΣ", "Σάς", "ſ", "ẞ", "İzmir"]
        rows = apply(spark, texts, lambda df: df.withColumn("x", fold_case(F.col("raw"))))
        assert [r.x for r in rows] == [t.casefold() for t in texts]
