"""Tables of the model: columns, types, keys, references and comments, in load order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The text fields taken from a landed row, whatever else a scrape carries.
LANDED_FIELDS = (
    "id", "site", "job_url", "title", "company", "location", "date_posted", "job_type",
    "is_remote", "min_amount", "max_amount", "currency", "interval",
    "_ingest_date", "_source_file",
)
LANDED = StructType([StructField(name, StringType()) for name in LANDED_FIELDS])


@dataclass(frozen=True)
class Reference:
    """A column whose non-NULL values must exist as the key of another table."""

    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Table:
    """The contract of one table."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    comment: str
    references: tuple[Reference, ...] = ()
    partition_by: tuple[str, ...] = field(default=())

    def __hash__(self) -> int:
        return hash(self.name)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _column(name: str, kind: DataType, comment: str = "", required: bool = False) -> StructField:
    return StructField(name, kind, not required, {"comment": comment} if comment else {})


_TEXT, _LONG, _INT, _DATE = StringType(), LongType(), IntegerType(), DateType()
_DOUBLE, _FLAG = DoubleType(), BooleanType()
_PAY = "As stated in the listing. NULL is not stated, which is not the same as 0."

DIM_COMPANY = Table(
    "dim_company",
    StructType([
        _column("company_key", _TEXT, required=True),
        _column("company_name", _TEXT, "The spelling used most often.", required=True),
        _column("spelling_count", _LONG, "How many spellings share this key.", required=True),
    ]),
    key=("company_key",),
    comment="A row for each company, with spellings that differ in case, punctuation or legal form joined.",
)
DIM_LOCATION = Table(
    "dim_location",
    StructType([
        _column("location_key", _TEXT, required=True),
        _column("city", _TEXT),
        _column("province_code", _TEXT),
        _column("province", _TEXT),
        _column("country_code", _TEXT),
        _column("country", _TEXT),
        _column("resolved", _FLAG, "False where neither province nor country could be read.", required=True),
        _column("raw_location", _TEXT, "The text used most often for this place."),
    ]),
    key=("location_key",),
    comment="A row for each city, province and country; a text that says neither keeps its own row.",
)
DIM_SOURCE = Table(
    "dim_source",
    StructType([
        _column("source_key", _TEXT, required=True),
        _column("source_type", _TEXT, "Job board, or the hiring system of one employer."),
        _column("platform", _TEXT),
    ]),
    key=("source_key",),
    comment="A row for each site that was scraped.",
)
DIM_DATE = Table(
    "dim_date",
    StructType([
        _column("date_key", _TEXT, required=True),
        _column("date", _DATE, required=True),
        _column("year", _INT, required=True),
        _column("month", _INT, required=True),
        _column("day", _INT, required=True),
        _column("day_name", _TEXT, required=True),
        _column("iso_week", _INT, "Week by ISO rules; the first days of a year may be in week 52 or 53.", required=True),
        _column("is_weekend", _FLAG, required=True),
    ]),
    key=("date_key",),
    comment="A row for each date the facts mention, and no other.",
)
FACT_OBSERVATION = Table(
    "fact_posting_observation",
    StructType([
        _column("ingest_date", _DATE, "Date of the scrape; one partition each.", required=True),
        _column("source_key", _TEXT, required=True),
        _column("job_url", _TEXT, "Identity of the posting.", required=True),
        _column("title", _TEXT),
        _column("company_key", _TEXT, "NULL where no company was stated."),
        _column("location_key", _TEXT),
        _column("date_posted", _DATE, "NULL where none was stated, or one that cannot be."),
        _column("job_type", _TEXT),
        _column("is_remote", _FLAG),
        _column("salary_min", _DOUBLE, _PAY),
        _column("salary_max", _DOUBLE, _PAY),
        _column("currency", _TEXT),
        _column("salary_interval", _TEXT, "Pay period."),
        _column("source_file", _TEXT),
    ]),
    key=("ingest_date", "source_key", "job_url"),
    comment="A row for each posting, site and scrape date on which it was seen.",
    references=(
        Reference("source_key", "dim_source", "source_key"),
        Reference("company_key", "dim_company", "company_key"),
        Reference("location_key", "dim_location", "location_key"),
    ),
    partition_by=("ingest_date",),
)
FACT_POSTING = Table(
    "fact_posting",
    StructType([
        _column("job_url", _TEXT, required=True),
        _column("title", _TEXT),
        _column("company_key", _TEXT),
        _column("location_key", _TEXT),
        _column("date_posted", _DATE),
        _column("job_type", _TEXT),
        _column("is_remote", _FLAG),
        _column("salary_min", _DOUBLE, _PAY),
        _column("salary_max", _DOUBLE, _PAY),
        _column("currency", _TEXT),
        _column("salary_interval", _TEXT, "Pay period."),
        _column("first_seen_date", _DATE, required=True),
        _column("last_seen_date", _DATE, required=True),
        _column("observation_count", _LONG, "Scrape dates on which the posting was seen.", required=True),
        _column("source_count", _LONG, "Sites on which the posting was seen.", required=True),
        _column(
            "days_visible", _INT,
            "Days from first to last sighting, both counted. What the scrapes saw, not how long"
            " a vacancy stayed open: days without a scrape go unseen.",
            required=True,
        ),
    ]),
    key=("job_url",),
    comment="A row for each posting as last seen, with the span over which it was seen.",
    references=(
        Reference("company_key", "dim_company", "company_key"),
        Reference("location_key", "dim_location", "location_key"),
    ),
)

# Dimensions come before the facts that refer to them.
DIMENSIONS = (DIM_COMPANY, DIM_LOCATION, DIM_SOURCE, DIM_DATE)
FACTS = (FACT_OBSERVATION, FACT_POSTING)
ALL_TABLES = DIMENSIONS + FACTS
