import csv
import os
from datetime import datetime

from pyspark.sql import functions as F

from postledger.proving import registry
from postledger.proving.files import write_scrapes
from postledger.proving.registry import HEADERS, SCRAPED, SHORT
from postledger.proving.scrapes import as_scraped


def test_rows_are_shuffled_before_they_are_made_into_lines(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(n,) for n in range(300)], "k long")

    def lines_of(df):
        file = F.when(F.col("k") % 100 != 99, F.concat(F.lit("part-["), (F.col("k") % 3).cast("string"), F.lit("] a.csv")))
        return df.withColumns({"file": file, "line": F.concat(F.col("k").cast("string"), F.lit(","), F.repeat(F.lit("x"), F.lit(500)))})

    dealt, real = [], type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda df, *a: dealt.append(df.columns) or real(df, *a))
    write_scrapes(rows, lines_of, F.concat(F.lit("id,"), F.coalesce("file", F.lit("none"))), str(tmp_path))
    assert dealt and not any({"line", "file"} & set(columns) for columns in dealt)
    found = {}
    for name in os.listdir(tmp_path / "scrapes"):
        if not name.startswith("."):
            found[name] = (tmp_path / "scrapes" / name).read_text().splitlines()
    assert sorted(found) == ["__HIVE_DEFAULT_PARTITION__", "part-[0] a.csv", "part-[1] a.csv", "part-[2] a.csv"]
    for name, (header, *lines) in found.items():
        assert header in (f"id,{name}", "id,none") and {len(line.split(",")[1]) for line in lines} == {500}
    held = sorted(int(line.split(",")[0]) for lines in found.values() for line in lines[1:])
    assert held == list(range(300))
    assert sorted(int(line.split(",")[0]) for line in found["__HIVE_DEFAULT_PARTITION__"][1:]) == [99, 199, 299]


def test_lines_of_scrapes_are_made_by_compiled_code(spark, tmp_path):
    """The JVM leaves methods of 8000 bytes and more to its interpreter."""
    orders = [(n, n + 7, priority, datetime(1997, 4, 1 + n % 28), 10.5 * n) for n, priority in enumerate(["1-URGENT", "3-MEDIUM", "5-LOW"] * 13)]
    columns = "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp, o_totalprice double"
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders")
    lines = registry._scrape_lines(spark.read.parquet(f"{tmp_path}/orders"))
    generated = lines.select("file", "line")._jdf.queryExecution().debug().codegenToSeq()
    assert max(generated.apply(i)._3().maxMethodCodeSize() for i in range(generated.size())) < 8000
    # Each kind of file, short rows included, has the cells of the scraped rows in its own order.
    found = {row.k: (row.file, row.line) for row in lines.select(F.col("o_orderkey").alias("k"), "file", "line").collect()}
    for row in as_scraped(spark.read.parquet(f"{tmp_path}/orders")).collect():
        kind = row._order % 3
        header = SCRAPED[:SHORT] if kind == 0 and row._order % 13 == 0 else HEADERS[kind]
        value = row.asDict() | {"benefits": "dental"}
        (file, line), cells = found[row._order], [value[c] or "" for c in header]
        assert file == row._source_file and line.endswith("\r") == (kind == 2)
        assert next(csv.reader([line.rstrip("\r")], strict=True)) == cells
    assert len(found) == len(orders)
