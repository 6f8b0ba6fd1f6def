"""Publish a built model to a relational database, as a whole or one ingest date of it.

Executors write to staging tables side by side; Spark commits such writes task by task, so
they are never seen by readers. One short transaction on the driver then moves the staged
rows in place, where the keys and references of the database check them.
"""

from collections.abc import Iterable, Mapping, Sequence
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
)

from postledger.operators.changes import GONE, change_set
from postledger.schemas import ALL_TABLES, FACT_OBSERVATION, FACTS, Table
from postledger.sources.model import read_table

SCHEMA = "wh"

_TYPES = {
    StringType(): "text",
    LongType(): "bigint",
    IntegerType(): "integer",
    DoubleType(): "double precision",
    BooleanType(): "boolean",
    DateType(): "date",
}


def table_name(table: Table, schema: str = SCHEMA) -> str:
    """Qualified name of a table."""
    return f"{schema}.{table.name}"


def staged_name(table: Table, run: str, schema: str = SCHEMA) -> str:
    """Qualified name of the staging table that one load has for a table."""
    return f"{schema}.{table.name}_{run}"


def _new_run() -> str:
    """A name that no other load has; short, as databases limit the length of names."""
    return f"staged_{uuid4().hex[:12]}"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def schema_statements(schema: str = SCHEMA) -> list[str]:
    """Statements that create the tables where they are missing, keys and comments included."""
    statements = [f"CREATE SCHEMA IF NOT EXISTS {schema}"]
    for table in ALL_TABLES:
        targets = {r.column: f" REFERENCES {schema}.{r.table}({r.key})" for r in table.references}
        lines = [
            f"{f.name} {_TYPES[f.dataType]}{'' if f.nullable else ' NOT NULL'}{targets.get(f.name, '')}"
            for f in table.schema.fields
        ]
        lines.append(f"PRIMARY KEY ({', '.join(table.key)})")
        statements.append(f"CREATE TABLE IF NOT EXISTS {table_name(table, schema)} ({', '.join(lines)})")
        statements.append(f"COMMENT ON TABLE {table_name(table, schema)} IS {_text(table.comment)}")
        statements.extend(
            f"COMMENT ON COLUMN {table_name(table, schema)}.{f.name} IS {_text(f.metadata['comment'])}"
            for f in table.schema.fields
            if f.metadata
        )
    return statements


def _move(table: Table, run: str, schema: str) -> str:
    columns = ", ".join(table.columns)
    return f"INSERT INTO {table_name(table, schema)} ({columns}) SELECT {columns} FROM {staged_name(table, run, schema)}"


def replace_all_statements(run: str, schema: str = SCHEMA) -> list[str]:
    """Statements that put the staged rows of all tables in place of the present ones."""
    names = ", ".join(table_name(table, schema) for table in ALL_TABLES)
    return [f"TRUNCATE {names}", *(_move(table, run, schema) for table in ALL_TABLES)]


def replace_date_statements(ingest_date: str, run: str, schema: str = SCHEMA) -> list[str]:
    """Statements that put the staged observations of one date in place of the present ones."""
    fact = FACT_OBSERVATION
    return [
        f"DELETE FROM {table_name(fact, schema)} WHERE ingest_date = DATE {_text(ingest_date)}",
        _move(fact, run, schema),
    ]


def change_statements(run: str, schema: str = SCHEMA) -> list[str]:
    """Statements that apply staged change sets: rows come before what refers to them, and go behind it."""
    statements = []
    for table in ALL_TABLES:
        target, staged = table_name(table, schema), staged_name(table, run, schema)
        same = " AND ".join(f"t.{c} = s.{c}" for c in table.key)
        values = ", ".join(f"{c} = s.{c}" for c in table.columns if c not in table.key)
        statements.append(
            f"MERGE INTO {target} AS t USING {staged} AS s ON {same} "
            f"WHEN MATCHED AND NOT s.{GONE} THEN UPDATE SET {values} "
            f"WHEN NOT MATCHED AND NOT s.{GONE} THEN INSERT ({', '.join(table.columns)}) "
            f"VALUES ({', '.join(f's.{c}' for c in table.columns)})"
        )
    for table in reversed(ALL_TABLES):
        target, staged = table_name(table, schema), staged_name(table, run, schema)
        same = " AND ".join(f"t.{c} = s.{c}" for c in table.key)
        statements.append(f"DELETE FROM {target} AS t USING {staged} AS s WHERE {same} AND s.{GONE}")
    return statements


def statistics_statements(schema: str = SCHEMA) -> list[str]:
    """Statements that give the database fresh statistics of both facts."""
    return [f"ANALYZE {table_name(table, schema)}" for table in FACTS]


def _stage(df: DataFrame, name: str, url: str, properties: dict[str, str]) -> None:
    df.write.jdbc(url, name, mode="overwrite", properties=properties)


def _stage_counted(stage, df: DataFrame, name: str, url: str, properties: dict[str, str]) -> int:
    """Stage rows; how many they were, counted while they were written."""
    if not str(properties.get("numPartitions", "")).isdigit():
        raise ValueError("properties must bound the connections of a load by numPartitions")
    counted = Observation(f"staged-{uuid4().hex}")
    stage(df.observe(counted, F.count(F.lit(1)).alias("rows")), name, url, properties)
    return counted.get["rows"]


def _transact(connection: Any, statements: Iterable[str]) -> None:
    """Run statements on a DB-API connection as one transaction."""
    try:
        cursor = connection.cursor()
        for statement in statements:
            cursor.execute(statement)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise


def _drop_staged(tables: Sequence[Table], run: str, schema: str) -> list[str]:
    return [f"DROP TABLE IF EXISTS {staged_name(table, run, schema)}" for table in tables]


def create_schema(connection: Any, schema: str = SCHEMA) -> None:
    """Create the tables where they are missing; safe to repeat."""
    _transact(connection, schema_statements(schema))


def publish_full_jdbc(
    spark: SparkSession,
    model_dir: str,
    url: str,
    properties: dict[str, str],
    connection: Any,
    schema: str = SCHEMA,
    stage=_stage,
) -> dict[str, int]:
    """Replace all six tables in one transaction, dimensions before facts; the rows of each.

    ``properties`` go to the JDBC writer, ``numPartitions`` among them, which bounds how
    many executors write at once. ``connection`` is a DB-API connection to the same
    database, not in autocommit mode. Loads have staging tables of their own.
    """
    run = _new_run()
    counts = {
        table.name: _stage_counted(stage, read_table(spark, model_dir, table), staged_name(table, run, schema), url, properties)
        for table in ALL_TABLES
    }
    _transact(connection, replace_all_statements(run, schema))
    _transact(connection, [*statistics_statements(schema), *_drop_staged(ALL_TABLES, run, schema)])
    return counts


def publish_changes_jdbc(
    old: Mapping[str, DataFrame],
    new: Mapping[str, DataFrame],
    url: str,
    properties: dict[str, str],
    connection: Any,
    schema: str = SCHEMA,
    stage=_stage,
) -> dict[str, int]:
    """Make the tables of a database that hold ``old`` hold ``new``, in one transaction; the rows changed in each.

    Only the change sets between the two are sent: rows to insert or update, and keys to delete.
    """
    run = _new_run()
    counts = {
        table.name: _stage_counted(
            stage, change_set(old[table.name], new[table.name], table.key), staged_name(table, run, schema), url, properties
        )
        for table in ALL_TABLES
    }
    _transact(connection, change_statements(run, schema))
    _transact(connection, [*statistics_statements(schema), *_drop_staged(ALL_TABLES, run, schema)])
    return counts


def publish_partition_jdbc(
    spark: SparkSession,
    model_dir: str,
    ingest_date: str,
    url: str,
    properties: dict[str, str],
    connection: Any,
    schema: str = SCHEMA,
    stage=_stage,
) -> dict[str, int]:
    """Replace one ingest date of the observations in one transaction, and nothing else; the rows written."""
    fact, run = FACT_OBSERVATION, _new_run()
    rows = read_table(spark, model_dir, fact).filter(
        F.col("ingest_date") == F.lit(ingest_date).cast("date")
    )
    count = _stage_counted(stage, rows, staged_name(fact, run, schema), url, properties)
    _transact(connection, replace_date_statements(ingest_date, run, schema))
    _transact(connection, _drop_staged([fact], run, schema))
    return {fact.name: count}
