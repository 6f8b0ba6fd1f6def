"""Landed rows for tests."""

from postledger.schemas import LANDED, LANDED_FIELDS


def landed_row(url, day, site="indeed", **fields):
    row = dict.fromkeys(LANDED_FIELDS)
    row |= {
        "id": f"id-{url}", "site": site, "job_url": url, "title": "Software Engineer",
        "company": "Acme Inc.", "location": "Truro, NS, CA", "date_posted": day, "is_remote": "false",
        "_ingest_date": day, "_source_file": f"scrape-results-{day}-local-{site}.csv",
    }
    return row | {{"ingest_date": "_ingest_date", "source_file": "_source_file"}.get(k, k): v for k, v in fields.items()}


def landed(spark, *rows):
    return spark.createDataFrame([tuple(row[f] for f in LANDED_FIELDS) for row in rows], LANDED)
