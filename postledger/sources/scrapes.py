"""Raw scrapes: CSV files that each name their own columns."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postledger.fixed_values import DERIVED_MARKERS, INGEST_DATE_PATTERN, SCRAPE_GLOB, SENSITIVE_COLUMNS
from postledger.storage import qualified

# A header that does not end within this many characters has a quote that is never closed.
LONGEST_HEADER = 1 << 20
# Stands for such a header; no header holds a line end outside of quotes.
UNENDING = "\n"

# How fields are quoted.
_DIALECT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}

# Columns that landing itself gives; one of the same name in a file does not count.
LINEAGE = ("_source_file", "_ingest_date", "ingest_date")


class ScrapeError(RuntimeError):
    """Scrapes that cannot be landed without guessing."""


def is_derived(file_name: Column) -> Column:
    """Whether a file name marks a re-processing of raw scrapes."""
    return file_name.rlike("|".join(DERIVED_MARKERS))


def ingest_date(file_name: Column, pattern: str = SCRAPE_GLOB) -> Column:
    """The date in a file name, right behind the fixed part of ``pattern``.

    Fails, naming the file, where there is none or it is no date: rows landed under a
    guessed date would never be put right by landing the true one.
    """
    found = F.regexp_extract(file_name, rf"\Q{pattern.split('*')[0]}\E{INGEST_DATE_PATTERN}", 1)
    error = F.concat(F.lit("no ingest date in file name: "), file_name)
    return F.coalesce(found.try_cast("date"), F.raise_error(error).cast("date"))


def file_name() -> Column:
    """Name of the file a row was read from. Spark gives it as part of a URI."""
    name = F.col("_metadata.file_name")
    plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), plain).otherwise(name)


def _literal(path: str) -> str:
    """``path`` as a pattern that only fits itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _plain(path: str) -> str:
    """A path as written, from one that a reader gives."""
    return re.sub("^file:/+", "file:/", unquote(path))


def scrape_files(spark: SparkSession, source_dir: str, pattern: str = SCRAPE_GLOB) -> DataFrame:
    """The files right in ``source_dir`` that ``pattern`` names: name, path, size, time, and whether derived.

    Lists the one directory and opens no file.
    """
    files = _files_named(spark, source_dir, pattern, "binaryFile")
    parent = F.regexp_replace(F.regexp_extract("path", "^(.*)/[^/]*$", 1), "^file:/+", "file:/")
    here = files.filter(parent == _directory(spark, source_dir))
    named = here.select(file_name().alias("file_name"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return named.withColumn("derived", is_derived(F.col("file_name")))


def _files_named(spark: SparkSession, source_dir: str, pattern: str, storage: str) -> DataFrame:
    """What ``pattern`` names in ``source_dir``, and what is in folders that it names.

    The lookup is called recursive so that folders are not taken for partitions.
    """
    reader = spark.read.format(storage).option("recursiveFileLookup", "true")
    try:
        return reader.load(f"{_literal(source_dir)}/{pattern}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ScrapeError(f"no scrape files under {source_dir}") from None


def raw_scrapes(spark: SparkSession, source_dir: str, pattern: str = SCRAPE_GLOB) -> DataFrame:
    """The raw scrapes right in ``source_dir``: file_name, path, bytes, modified, ingest_date; fails on a name without a date.

    A table, so that a directory of very many files is grouped and counted by Spark.
    """
    date = F.regexp_extract("file_name", rf"\Q{pattern.split('*')[0]}\E{INGEST_DATE_PATTERN}", 1).try_cast("date")
    files = scrape_files(spark, source_dir, pattern).filter(~F.col("derived")).drop("derived").withColumn("ingest_date", date)
    undated = files.filter(F.col("ingest_date").isNull()).first()
    if undated:
        raise ScrapeError(f"no ingest date in file name: {undated.file_name}")
    return files


def _directory(spark: SparkSession, source_dir: str) -> str:
    return re.sub("^file:/+", "file:/", qualified(spark, source_dir)).rstrip("/")


def raw_scrape_paths(
    spark: SparkSession, source_dir: str, pattern: str = SCRAPE_GLOB, only_date: str | None = None
) -> list[str]:
    """Paths of the raw scrapes right in ``source_dir``, or of one date's, sorted; empty files included.

    All of them come to the driver; ``land`` fetches them some at a time. Files in folders below are not taken, whatever these are called. Fails when there is
    none, and on a name without a date.
    """
    here = _directory(spark, source_dir)
    listed = _files_named(spark, source_dir, pattern, "text").inputFiles()
    paths = sorted(path for path in map(_plain, listed) if path.rsplit("/", 1)[0] == here)
    paths = [path for path in paths if not any(m in _name(path) for m in DERIVED_MARKERS)]
    dates = {path: _date_of(path, pattern) for path in paths}
    if only_date is not None:
        paths = [path for path in paths if dates[path] == only_date]
    if not paths:
        raise ScrapeError(f"no scrape files {f'for {only_date}' if only_date else f'under {source_dir}'}")
    return paths


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _date_of(path: str, pattern: str) -> str:
    match = re.search(re.escape(pattern.split("*")[0]) + INGEST_DATE_PATTERN, _name(path))
    if not match:
        raise ScrapeError(f"no ingest date in file name: {_name(path)}")
    return match[1]


def by_date(paths: Sequence[str], pattern: str = SCRAPE_GLOB) -> dict[str, list[str]]:
    """``paths`` by the date in their names, in order of dates; fails where a name has none."""
    found: dict[str, list[str]] = {}
    for path in sorted(paths, key=lambda path: (_date_of(path, pattern), path)):
        found.setdefault(_date_of(path, pattern), []).append(path)
    return found


def _first_lines(spark: SparkSession, paths: Sequence[str], within: int) -> DataFrame:
    """The first ``within`` lines of each file: (path, line).

    A file is a task, and only these lines of it leave the scan, however large the file is. That
    takes reading options of their own, so this runs in a session of its own.
    """
    session = spark.newSession()
    # A file that costs as much to open as a task may read is a task, and is not split.
    session.conf.set("spark.sql.files.openCostInBytes", 1 << 40)
    session.conf.set("spark.sql.files.maxPartitionBytes", 1 << 40)
    session.conf.unset("spark.sql.files.maxPartitionNum")
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    return session.read.option("lineSep", "\n").text([_literal(path) for path in paths]).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"),
        # Behind the number of the task stands that of the line in it.
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    ).filter(F.col("place") < within)


def plain_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """What ``first_records`` gives, without Python, of files whose first line has no quote; both NULL for others.

    Without quotes the record ends with the first line, or at a carriage return in it.
    """
    line = F.col("line")
    text = F.when(line.startswith("\ufeff"), F.substring(line, 2, 2**31 - 1)).otherwise(line)
    plain = ~F.contains(line, F.lit('"')) & F.is_valid_utf8(line)
    ended = F.instr(text, "\r")
    line_end = F.when(ended == 0, F.lit("\n")).when(ended == F.char_length(text), F.lit("\r\n")).otherwise(F.lit("\r"))
    return _first_lines(spark, paths, 1).select(
        "path", F.when(plain, F.substring_index(text, "\r", 1)).alias("header"), F.when(plain, line_end).alias("line_end")
    )


def first_records(spark: SparkSession, paths: Sequence[str], within: int = 1) -> DataFrame:
    """The first record of each file: (path, header, line_end); both NULL where it does not end ``within`` that many lines."""
    lines = _first_lines(spark, paths, within).select("path", F.col("line").cast("binary").alias("line"), "place")
    longest, unending = LONGEST_HEADER, UNENDING

    # Defined here, so that it travels by value and workers need not have this package.
    def end_of_record(text):
        """Where the first line end outside of quotes is, or None."""
        field, quoted, i = 0, False, 0
        while i < len(text):
            if quoted:
                if text[i] == '"':
                    if text[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        quoted = False
            elif text[i] == '"' and i == field:
                quoted = True
            elif text[i] == ",":
                field = i + 1
            elif text[i] in "\r\n":
                return i
            i += 1
        return None

    def first(batches):
        import pyarrow as pa

        def found(path, header, line_end):
            return pa.RecordBatch.from_pydict({"path": [path], "header": [header], "line_end": [line_end]}, schema)

        schema = pa.schema([(name, pa.string()) for name in ("path", "header", "line_end")])
        path, text, done = None, "", False
        for batch in batches:
            # Lines behind the record are taken, too: a worker that leaves some is lost to the next task.
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = name
                if done:
                    break
                text += line.decode("utf-8", "replace") + "\n"
                start = text.removeprefix("\ufeff")
                end = end_of_record(start)
                if end is None and len(text) > longest:
                    end, start = len(unending), unending + "\n"
                if end is not None:
                    done = True
                    yield found(path, start[:end], "\r\n" if start[end : end + 2] == "\r\n" else start[end])
        if path is not None and not done:
            yield found(path, None, None)

    return lines.mapInArrow(first, "path string, header string, line_end string")


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, str], list[str]]:
    """Paths by header record and the line end that follows it. Fails on a file without a header."""
    return {key: [plain for plain, _ in files] for key, files in _files_by_header(spark, paths).items()}


def _files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """By header record and line end the files that have it: path as written, and as a reader gives it.

    Each distinct header comes to the driver once, with the paths of its files. Those with
    quotes are looked up again, and those that do not end with the first line once more, in as
    many lines as a header may have.
    """

    def files(found: DataFrame) -> dict[tuple[str | None, str | None], list[str]]:
        by_header = found.groupBy("header", "line_end").agg(F.collect_list("path").alias("paths"))
        return {(row.header, row.line_end): row.paths for row in by_header.collect()}

    found = files(plain_headers(spark, paths))
    # A line has one character at least, its end.
    for within in (1, LONGEST_HEADER + 1):
        if unknown := found.pop((None, None), None):
            for key, own in files(first_records(spark, [_plain(path) for path in unknown], within)).items():
                found[key] = [*found.get(key, []), *own]
    found.pop((None, None), None)
    grouped = {key: sorted((_plain(path), path) for path in own) for key, own in found.items()}
    known = {plain: key[0] for key, own in grouped.items() for plain, _ in own}
    for path in paths:
        in_full = path if ":" in path.split("/", 1)[0] else qualified(spark, path)
        header = known.get(re.sub("^file:/+", "file:/", in_full), "")
        if header == UNENDING:
            raise ScrapeError(f"no end of the header row within {LONGEST_HEADER} characters: {_name(path)}")
        if not header.strip():
            raise ScrapeError(f"no header row: {_name(path)}")
    return {key: own for key, own in sorted(grouped.items())}


def _rows_of(spark: SparkSession, paths: Sequence[str], width: int, line_end: str, multi_line: bool) -> DataFrame:
    """Rows of files as Spark's reader cuts them: cells, ``_file``, ``_path``, and the text of odd rows.

    The line end is named, since Spark otherwise rewrites those within quotes.
    """
    cells = [f"_c{i}" for i in range(width)]
    schema = StructType([StructField(c, StringType()) for c in [*cells, "_odd"]])
    # Always true. Spark reads the text of odd rows only together with a proper column.
    any_length = F.char_length(F.coalesce(F.col(cells[0]), F.lit(""))) >= 0
    return (
        spark.read.schema(schema)
        .options(header=True, multiLine=multi_line, lineSep=line_end, columnNameOfCorruptRecord="_odd", **_DIALECT)
        .csv([_literal(path) for path in paths])
        .select(*cells, file_name().alias("_file"), F.col("_metadata.file_path").alias("_path"), F.when(any_length, F.col("_odd")).alias("_odd"))
    )


def records_by_parity(spark: SparkSession, paths: Sequence[str], line_end: str) -> DataFrame:
    """The records behind the header of each file: (_file, _path, _record); many tasks share a file.

    A line begins a record if an even number of quotes stand before it in its file. Quotes are
    counted by line; sums over the lines of a block, and over the blocks of a file, one row each,
    say how many those are, and in the same way how many records. A record of one line is
    complete as it is, so only lines of longer ones are shuffled to be put together.
    """
    # A record ends with this; others are part of a field.
    line_sep, end = ("\r", "") if line_end == "\r" else ("\n", line_end[:-1])
    lines = spark.read.option("lineSep", line_sep).text([_literal(path) for path in paths]).select(
        F.col("_metadata.file_path").alias("_path"),
        file_name().alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        F.col("value").alias("_text"),
    )
    quotes = F.char_length("_text") - F.char_length(F.replace("_text", F.lit('"')))
    lines = lines.withColumn("_quotes", quotes.cast("long"))
    # From here on blocks are known by file and place; a block's lines are in order of their numbers.
    in_block = Window.partitionBy("_path", "_block").orderBy("_line")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("_inside", F.coalesce(F.sum("_quotes").over(before), F.lit(0)))
    even = (F.col("_inside") % 2 == 0).cast("long")
    # How many records begin in the block: it depends on whether an even number of quotes stand before it.
    blocks = lines.groupBy("_path", "_block").agg(
        F.sum("_quotes").alias("_all"), F.sum(even).alias("_if_even"), F.sum(1 - even).alias("_if_odd")
    )
    in_file = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_outside", F.coalesce(F.sum("_all").over(in_file), F.lit(0)))
    begun = F.when(F.col("_outside") % 2 == 0, F.col("_if_even")).otherwise(F.col("_if_odd"))
    blocks = blocks.withColumn("_earlier", F.coalesce(F.sum(begun).over(in_file), F.lit(0))).select("_path", "_block", "_outside", "_earlier")
    placed = lines.join(blocks, ["_path", "_block"])
    begins = (F.col("_outside") + F.col("_inside")) % 2 == 0
    placed = placed.withColumn("_begins", begins).withColumn(
        "_number", F.col("_earlier") + F.sum(F.col("_begins").cast("long")).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = F.col("_begins") & (F.col("_quotes") % 2 == 0)
    keys = ["_path", "_file", "_number"]
    alone = placed.filter(whole).select(*keys, F.col("_text").alias("_record"))
    pieces = placed.filter(~whole).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_block", "_line", "_text"))).alias("_pieces"))
    joined = pieces.select(*keys, F.array_join("_pieces._text", line_sep).alias("_record"))
    records = alone.unionByName(joined).filter(F.col("_number") > 1)
    if end:
        records = records.withColumn("_record", F.regexp_replace("_record", f"{end}$", ""))
    # A line without anything is no record.
    return records.filter(F.col("_record") != "").select("_file", "_path", "_record")


def _rows_of_records(spark: SparkSession, paths: Sequence[str], width: int, line_end: str) -> DataFrame:
    """What ``_rows_of`` gives, of records that were put together by their quotes."""
    cells = [f"_c{i}" for i in range(width)]
    parsed = F.from_csv("_record", ", ".join(f"{c} STRING" for c in [*cells, "_odd"]), {**_DIALECT, "multiLine": "true", "columnNameOfCorruptRecord": "_odd"})
    rows = records_by_parity(spark, paths, line_end).select("_file", "_path", parsed.alias("_row"))
    return rows.select(*[F.col(f"_row.{c}").alias(c) for c in cells], "_file", "_path", F.col("_row._odd").alias("_odd"))


def _named(rows: DataFrame, width: int, layouts: Sequence[tuple[dict[str, int], list[str]]], names: dict[str, str], marks: tuple[str, str]) -> DataFrame:
    """Rows of files of one width in columns ``names``; ``marks`` name two more.

    The first says whether a row is wider than the header, the second whether it has
    characters that stand for bytes which are no UTF-8. ``layouts`` say for each header where
    its columns are, and the files that have it. Where several headers are as wide, a row finds
    its layout by its file.

    Spark reads an empty field and a missing one as NULL alike. A row that is not as wide
    as the header comes with its text, which is parsed again with one more cell behind it:
    the place of that cell is the row's width, and tells the empty fields from the missing.
    The cell is longer than the row, so it can be none of the row's own.
    """
    cells = [f"_c{i}" for i in range(width)]
    # One column more than the widest row that may pass, so the cell behind that row is seen.
    one_more = ", ".join(f"_c{i} STRING" for i in range(width + 1))
    behind = F.repeat(F.lit("x"), F.char_length("_odd") + 1)
    fields = F.from_csv(F.concat("_odd", F.lit(","), behind), one_more, {**_DIALECT, "multiLine": "true"})
    place = F.array_position(F.array(*[F.col(f"_parsed._c{i}") for i in range(width + 1)]), F.col("_behind"))
    rows = (
        rows.select(*cells, "_file", "_path", "_odd", fields.alias("_parsed"), behind.alias("_behind"))
        .select(*cells, "_file", "_path", "_odd", F.coalesce(place, F.lit(0)).alias("_place"))
    )
    known = [name for name in names if any(name in at for at, _ in layouts)]
    if len(layouts) > 1:
        # A row per file and one per header; files come in groups of bounded size.
        spark = rows.sparkSession
        files = spark.createDataFrame([(path, i) for i, (_, paths) in enumerate(layouts) for path in paths], "_path string, _layout int")
        held = [(i, [at.get(name) for name in known]) for i, (at, _) in enumerate(layouts)]
        places = spark.createDataFrame(held, "_layout int, _at array<int>")
        rows = rows.join(F.broadcast(files), "_path").join(F.broadcast(places), "_layout")
        rows = rows.withColumn("_cells", F.array(*cells))
    odd = F.col("_odd").isNotNull()
    wide = odd & (F.col("_place") == 0)
    held = F.when(odd, F.col("_place") - 1).otherwise(width)
    undecoded = F.concat_ws("", *cells).contains("\ufffd")

    def column(name: str) -> Column:
        if name not in known:
            return F.lit(None).cast("string")
        if len(layouts) > 1:
            at = F.col("_at")[known.index(name)]
            return F.when(at.isNotNull() & ((held > at) | wide), F.coalesce(F.get("_cells", at), F.lit("")))
        at = layouts[0][0][name]
        return F.when((held > at) | wide, F.coalesce(cells[at], F.lit("")))

    return rows.select(
        *[column(name).alias(shown) for name, shown in names.items()],
        F.col("_file").alias("_source_file"), wide.alias(marks[0]), undecoded.alias(marks[1]),
    )


def read_scrapes(
    spark: SparkSession,
    paths: Sequence[str],
    pattern: str = SCRAPE_GLOB,
    wide_rows: str = "fail",
    multi_line: bool = True,
    undecodable: str = "fail",
    split_quoted: bool = False,
) -> DataFrame:
    """Every row of the raw scrapes ``paths``, columns matched by name, whatever its case.

    An empty field is ``""``; a field that a short row or a file's header lacks is NULL.
    Sensitive columns are left out here, before anything is written. ``_source_file`` and
    ``ingest_date`` say where a row came from. ``wide_rows`` decides about rows with more
    fields than their header: ``"fail"`` names the file, ``"drop"`` leaves them out,
    ``"only"`` gives nothing but them. ``undecodable`` decides about rows with bytes that are
    no UTF-8, which read as U+FFFD: ``"fail"`` names the file, ``"keep"`` takes them so.

    Files are read once per width of their headers and line end, however many headers there
    are, a task per file: a quoted field may hold line ends, so only a reader that starts at the
    top of a file knows where rows end. Where no field does, ``multi_line=False`` lets several
    tasks share a large file. With ``split_quoted`` they share it although fields hold line
    ends: rows are told by the quotes before them, which takes a shuffle of the lines, and files
    in which a quote only ever stands around a field, or twice within one.
    """
    wide, undecoded = marks = tuple(f"_mark_{uuid4().hex}" for _ in range(2))
    widths: dict[tuple[int, str], list[tuple[dict[str, int], list[str], list[str]]]] = {}
    names: dict[str, str] = {}
    for (header, line_end), files in _files_by_header(spark, paths).items():
        columns = next(csv.reader([header], strict=False))
        # Of columns that share a name the last one counts; upper and lower case are alike.
        last = {name.lower(): i for i, name in enumerate(columns)}
        at = {name: i for name, i in last.items() if name not in SENSITIVE_COLUMNS and name not in LINEAGE}
        for name, i in at.items():
            names.setdefault(name, columns[i])
        widths.setdefault((len(columns), line_end), []).append((at, *zip(*files, strict=True)))
    parts = []
    for (width, line_end), layouts in widths.items():
        own = [path for _, plain, _ in layouts for path in plain]
        read = _rows_of_records(spark, own, width, line_end) if split_quoted else _rows_of(spark, own, width, line_end, multi_line)
        parts.append(_named(read, width, [(at, given) for at, _, given in layouts], names, marks))
    rows = reduce(DataFrame.unionAll, parts)

    def refused(mark: str, what: str) -> DataFrame:
        error = F.concat(F.lit(f"{what}: "), F.col("_source_file"))
        return rows.withColumn("_source_file", F.when(F.col(mark), F.raise_error(error)).otherwise(F.col("_source_file")))

    if undecodable == "fail":
        rows = refused(undecoded, "bytes that are no UTF-8")
    if wide_rows == "fail":
        rows = refused(wide, "row has more fields than the header")
    else:
        rows = rows.filter(F.col(wide) if wide_rows == "only" else ~F.col(wide))
    return rows.drop(*marks).withColumn("ingest_date", ingest_date(F.col("_source_file"), pattern))
