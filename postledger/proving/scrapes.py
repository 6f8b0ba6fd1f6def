"""Scrapes derived from the ``orders``, ``documents`` and ``lineitem`` tables.

Every order becomes one scraped row and every field is a plain function of the order, so
the same rows can be written down in SQL. The fields take on every shape the conforming
rules tell apart.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postledger.schemas import LANDED_FIELDS

# Raw locations, "#" standing for a number that varies by customer.
LOCATIONS = (
    "Truro, NS, CA",
    "truro, ns, ca",
    "Guelph, ON, CA",
    "Guelph, Ontario, Canada",
    "Fresno, CA, US",
    "CA",
    "Kelowna, British Columbia, Canada",
    "Lethbridge, AB, CA",
    "Lubbock, TX, US",
    "Worcester, Massachusetts, United States",
    "Sudbury, Ontario",
    "Spokane, WA",
    "Amarillo, TX",
    "Guelph, ON, N1G 2W1",
    "Remote, US",
    "Guelph, TX, CA",
    "9 DOCK LANE:GUELPH",
    "Guelph Main Office",
    "Regina - 12 Pine; Gander - Gull Rd E; Truro - Mill Ln",
    "",
    None,
    "Fresno, CA",
    "Bremen, DE",
    "Cove #, QC, Canada",
    "Floor #, Cove #, New York, USA",
    " , Cove # ,, bc , ",
    "Shed # Annex",
    "United States of America",
    "REMOTE",
    "Remote, Nova Scotia",
    "Georgetown, DC, USA",
    "Ontario",
    "X0E 0T0",
)

# Rows per file, and date; more rows give more files, not larger ones.
ORDERS_PER_SHARD = 1_000_000
SUPPLIERS_PER_SHARD = 1_000_000


def _text(column: Column) -> Column:
    return column.cast("string")


_PLACE = "array({})[CAST(k % {} AS int)]".format(
    ", ".join("NULL" if text is None else f"'{text}'" for text in LOCATIONS), len(LOCATIONS)
)


def orders_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, in the columns that scraped rows are made of."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")


def scraped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a scraped row, the sensitive and unused columns included."""
    return as_scraped(orders_of(spark, sf_dir))


def as_scraped(orders: DataFrame, *also: str) -> DataFrame:
    """Each of ``orders`` as a scraped row, columns ``also`` of the order kept beside it."""
    fields = orders.selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "o_orderpriority AS priority",
        "CAST(CAST(o_orderdate AS date) AS string) AS day",
        "CAST(trunc(CAST(o_orderdate AS date), 'quarter') AS string) AS quarter",
        "CAST(floor(o_totalprice) AS string) AS price",
        "concat('Acme ', o_custkey % 97) AS base",
        *also,
    )
    return fields.selectExpr(
        "CASE WHEN priority = '3-MEDIUM' THEN concat('cb-acme-', c % 97) ELSE concat('p-', k) END AS id",
        """CASE priority WHEN '1-URGENT' THEN 'indeed' WHEN '2-HIGH' THEN 'linkedin'
             WHEN '3-MEDIUM' THEN 'careerbeacon' WHEN '5-LOW' THEN 'company:workday'
             ELSE 'company:greenhouse' END AS site""",
        """CASE WHEN k % 503 = 0 THEN NULL WHEN k % 501 = 0 THEN ''
             ELSE concat('https://jobs.example/', c) END AS job_url""",
        "concat('Engineer ', k % 11) AS title",
        """CASE k % 7 WHEN 0 THEN base WHEN 1 THEN concat(base, ' Inc.') WHEN 2 THEN upper(base)
             WHEN 3 THEN concat(base, ', LLC.') WHEN 4 THEN concat(base, ' Canada')
             WHEN 5 THEN '   ' END AS company""",
        f"replace({_PLACE}, '#', CAST(c % 50 AS string)) AS location",
        """CASE k % 8 WHEN 0 THEN day WHEN 1 THEN concat(day, ' 00:00:00') WHEN 2 THEN concat(day, 'T09:15:00Z')
             WHEN 3 THEN '' WHEN 5 THEN concat(left(day, 4), '-13-01')
             WHEN 6 THEN concat(left(day, 4), '-02-30') WHEN 7 THEN 'yesterday' END AS date_posted""",
        "CASE k % 3 WHEN 0 THEN 'fulltime' WHEN 1 THEN 'contract' ELSE '' END AS job_type",
        "CASE k % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '' END AS is_remote",
        """CASE k % 9 WHEN 0 THEN price WHEN 1 THEN concat(price, '.50') WHEN 2 THEN concat(' ', price, ' ')
             WHEN 3 THEN '0' WHEN 4 THEN '' WHEN 6 THEN 'competitive' WHEN 7 THEN 'nan'
             WHEN 8 THEN '1_000' END AS min_amount""",
        """CASE k % 10 WHEN 0 THEN price WHEN 1 THEN 'inf' WHEN 2 THEN '-inf' WHEN 3 THEN '1d'
             WHEN 4 THEN '1e400' WHEN 5 THEN '0x1p3' WHEN 6 THEN concat(price, 'e1') WHEN 7 THEN '.5'
             WHEN 8 THEN '5.' END AS max_amount""",
        "CASE c % 3 WHEN 0 THEN 'CAD' WHEN 1 THEN 'USD' END AS currency",
        "CASE c % 2 WHEN 0 THEN 'yearly' ELSE 'hourly' END AS interval",
        "quarter AS _ingest_date",
        f"""concat('scrape-results-', quarter, '-part', k % 3, '-[', k div {ORDERS_PER_SHARD}, '].csv')
             AS _source_file""",
        "concat('recruiter', c, '@mail.example') AS emails",
        """concat('Line one of ', k, '\\nline two, with a comma and a "quote"') AS description""",
        "k AS _order",
        *also,
    )


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`scraped_orders` in the declared fields of a landed row."""
    return scraped_orders(spark, sf_dir).select(*LANDED_FIELDS)


def scraped_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a scraped posting whose description is its whole text."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    doc = F.col("doc_id")
    month = F.format_string("2024-%02d-01", (doc % 12 + 1).cast("int"))
    return documents.select(
        _text(doc).alias("id"),
        F.col("source").alias("site"),
        F.concat(F.lit("https://docs.example/"), _text(doc)).alias("job_url"),
        F.col("lang").alias("title"),
        F.col("text").alias("description"),
        F.lit("someone@mail.example").alias("emails"),
        F.concat(
            F.lit("scrape-results-"), month, F.lit("-docs-"), _text(F.floor(doc / 100_000)), F.lit(".csv")
        ).alias("_source_file"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines: their orders, and the number in the URL of the rows that are made of them."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.when(F.col("l_linenumber") == 1, F.col("l_partkey")).otherwise(F.col("l_suppkey"))
    return lines.select("l_orderkey", number.alias("number"))


def reprocessed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a row of a file derived from raw scrapes, some with URLs of their own."""
    return as_reprocessed(order_lines(spark, sf_dir))


def as_reprocessed(lines: DataFrame, *also: str) -> DataFrame:
    """Each of ``lines`` as a row of a file derived from raw scrapes, columns ``also`` of the line kept beside it."""
    return lines.select(
        F.concat(F.lit("p-"), _text(F.col("l_orderkey"))).alias("id"),
        F.concat(F.lit("https://jobs.example/"), _text(F.col("number"))).alias("job_url"),
        F.concat(
            F.lit("scrape-results-2001-10-01-combined-"),
            _text(F.floor(F.col("l_orderkey") / ORDERS_PER_SHARD)), F.lit(".csv"),
        ).alias("_source_file"),
        *also,
    )
