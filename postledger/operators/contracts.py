"""Contracts of the model, each a query whose rows are the violations."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postledger.schemas import ALL_TABLES, Table


class ContractViolation(RuntimeError):
    """A table does not keep its contract."""


def check_columns(df: DataFrame, table: Table) -> None:
    """Fail unless ``df`` has the declared columns and types, in the declared order."""
    found = [(f.name, f.dataType) for f in df.schema.fields]
    declared = [(f.name, f.dataType) for f in table.schema.fields]
    if found != declared:
        raise ContractViolation(f"{table.name}: found {found}, declared {declared}")


def key_violations(df: DataFrame, table: Table) -> DataFrame:
    """Keys that occur more than once, with the number of rows that share them."""
    key = F.to_json(F.struct(*table.key), {"ignoreNullFields": "false"})
    return (
        df.groupBy(*table.key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
        .select(F.lit(table.name).alias("table_name"), key.alias("key"), "rows")
    )


def null_violations(df: DataFrame, table: Table) -> DataFrame:
    """Required columns that hold NULLs, counted in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.required])
    return (
        counts.unpivot([], table.required, "column_name", "rows")
        .filter(F.col("rows") > 0)
        .select(F.lit(table.name).alias("table_name"), "column_name", "rows")
    )


def reference_violations(tables: Mapping[str, DataFrame], table: Table) -> DataFrame:
    """Values of referring columns that the table referred to does not hold.

    The fact shrinks to its distinct (column, value) pairs, all references in one pass,
    before it meets the keys: a value that a third of the fact shares joins as one row.
    Dimensions keep a row per unparsed location and may grow large, so the join carries
    no broadcast hint and Spark chooses by size.
    """
    names = [r.column for r in table.references]
    used = (
        tables[table.name].select(*names)
        .unpivot([], names, "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            tables[r.table].select(F.lit(r.column).alias("column_name"), F.col(r.key).alias("value"))
            for r in table.references
        ],
    )
    return used.join(known, ["column_name", "value"], "left_anti").select(
        F.lit(table.name).alias("table_name"), "column_name", "value", "rows"
    )


def violations(
    tables: Mapping[str, DataFrame], checked: Sequence[Table] = ALL_TABLES
) -> DataFrame:
    """Every broken key, required column and reference of ``checked``, in one table."""
    found = []
    for table in checked:
        df = tables[table.name]
        found.append(key_violations(df, table).select(
            "table_name", F.lit("key").alias("contract"), F.col("key").alias("what"), "rows"))
        found.append(null_violations(df, table).select(
            "table_name", F.lit("required").alias("contract"), F.col("column_name").alias("what"), "rows"))
        if table.references:
            found.append(reference_violations(tables, table).select(
                "table_name", F.lit("reference").alias("contract"),
                F.concat_ws("=", "column_name", "value").alias("what"), "rows"))
    return reduce(DataFrame.unionByName, found)


def require_contracts(
    tables: Mapping[str, DataFrame], checked: Sequence[Table] = ALL_TABLES
) -> None:
    """Fail, naming some of the violations, unless every contract of ``checked`` holds."""
    for table in checked:
        check_columns(tables[table.name], table)
    broken = violations(tables, checked).groupBy("table_name", "contract").agg(
        F.count(F.lit(1)).alias("n"), F.min("what").alias("what")
    ).collect()
    if broken:
        raise ContractViolation(
            "; ".join(f"{r.table_name}: {r.n} broken {r.contract} contracts, such as {r.what}" for r in broken)
        )
