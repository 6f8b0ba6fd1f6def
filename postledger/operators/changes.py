"""Where two versions of a table differ, and a version made of another one and what changed.

A change set holds whole rows of a keyed table: those that are new or changed, and for each key
that left a row marked as gone. It is a table itself, so a large one is shuffled, and applying
it rewrites nothing.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.operators.fingerprint import row_digest
from postledger.storage import scratch_dir

# Marks the keys of a change set that have no row any more.
GONE = "_gone"


def _same(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in key])


def _without(rows: DataFrame, keys: DataFrame, key: Sequence[str], kind: str = "left_anti") -> DataFrame:
    """The rows whose key is not among ``keys``, NULL being a key like others; with ``left_semi`` those whose is."""
    renamed = keys.select(*[F.col(c).alias(f"_key_{c}") for c in key])
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(renamed[f"_key_{c}"]) for c in key])
    return rows.join(renamed, same, kind)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that what reads it twice does not make it twice."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def differing_hashes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that one of two tables has more often than the other, by hashes: (_digest, _hash, copies).

    ``copies`` is how many more ``new`` has, negative where ``old`` has more. Of each row two
    numbers are shuffled: the digest over all columns, and another hash of them.
    """
    columns = old.columns
    sides = [df.select(row_digest(columns).alias("_digest"), F.xxhash64(*columns).alias("_hash"), F.lit(n).cast("long").alias("n"))
             for df, n in ((old, -1), (new, 1))]
    return sides[0].unionAll(sides[1]).groupBy("_digest", "_hash").agg(F.sum("n").alias("copies")).filter("copies <> 0")


def differing_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that one of two tables has more often than the other: (copies, row), as a written table.

    What the tables agree in goes by hashes; only rows that differ are looked up, in a second
    scan of each table, and these are all that is written.
    """
    columns = old.columns
    apart = _written(differing_hashes(old, new), "differing-hashes")

    def found(df: DataFrame, wanted: str) -> DataFrame:
        # Rows meet by the hash that costs little. No equation between the digests, which would be
        # a key and so be made of every row; this way only rows that meet have theirs made.
        met = df.withColumn("_hash", F.xxhash64(*columns)).join(apart.filter(wanted), "_hash")
        same = row_digest(columns).bitwiseXOR(F.col("_digest")) == 0
        # Equal rows are one row with a count.
        return met.filter(same).groupBy("_digest", "_hash", "copies").agg(F.min(F.struct(*columns)).alias("row"))

    rows = found(old, "copies < 0").unionByName(found(new, "copies > 0"))
    return _written(rows.select("copies", "row"), "differing-rows")


def version_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """How two versions of a table differ: (key..., change, rows, columns, before, after).

    Tables are compared as multisets of rows. Where a key has one differing row on either side
    that is a ``changed`` row, and ``columns`` names what differs. All other differing rows are
    ``removed`` or ``added`` as they are, ``rows`` of each; ``before`` and ``after`` hold them.
    A key may be NULL or repeat, and the versions may be equal, which gives no rows.
    """
    rest = [c for c in old.columns if c not in key]
    rows = differing_rows(old, new).select(
        "copies", "row", *[F.col(f"row.{c}").alias(f"_key_{c}") for c in key]
    )
    keys = [f"_key_{c}" for c in key]
    removed, added = F.col("copies") < 0, F.col("copies") > 0
    by_key = rows.groupBy(*keys).agg(
        F.sum(F.when(removed, -F.col("copies")).otherwise(0)).alias("removed"),
        F.sum(F.when(added, F.col("copies")).otherwise(0)).alias("added"),
        F.min(F.when(removed, F.col("row"))).alias("before"),
        F.min(F.when(added, F.col("row"))).alias("after"),
    )
    alone = (F.col("removed") == 1) & (F.col("added") == 1)
    differ = F.filter(
        F.array(*[F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in rest]),
        lambda name: name.isNotNull(),
    )
    changed = by_key.filter(alone).select(
        *keys, F.lit("changed").alias("change"), F.lit(1).cast("long").alias("rows"),
        differ.alias("columns"), "before", "after",
    )
    nothing = F.lit(None).cast(rows.schema["row"].dataType)
    # One row per key on the other side, so a key with many rows joins like one with few.
    pairs = by_key.filter(alone).select(*[F.col(c).alias(f"{c}_") for c in keys])
    others = rows.join(pairs, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in keys]), "left_anti")
    apart = others.select(
        *keys, F.when(removed, F.lit("removed")).otherwise(F.lit("added")).alias("change"),
        F.abs("copies").alias("rows"), F.array().cast("array<string>").alias("columns"),
        F.when(removed, F.col("row")).otherwise(nothing).alias("before"),
        F.when(added, F.col("row")).otherwise(nothing).alias("after"),
    )
    return changed.unionByName(apart).withColumnsRenamed(dict(zip(keys, key, strict=True)))


def change_set(old: DataFrame, new: DataFrame, key: Sequence[str], kinds: bool = False) -> DataFrame:
    """What makes ``new`` of ``old``, both with unique keys: rows of ``new``, and keys that are gone.

    The other columns of a key that is gone keep what they were. With ``kinds`` a column
    ``_kind`` says added, changed or removed.
    """
    found = version_diff(old, new, key)
    row = F.coalesce("after", "before")
    kind = [F.col("change").alias("_kind")] if kinds else []
    return found.select(*[row[c].alias(c) for c in old.columns], F.col("after").isNull().alias(GONE), *kind)


def folded(changes: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Change sets that follow each other as one: of each key what the last of them says."""
    if len(changes) == 1:
        return changes[0]
    columns = changes[0].columns
    levels = [c.select(F.lit(i).alias("_level"), F.struct(*columns).alias("_row")) for i, c in enumerate(changes)]
    every = reduce(DataFrame.unionByName, levels)
    keys = [F.col(f"_row.{c}").alias(f"_key_{c}") for c in key]
    return every.groupBy(*keys).agg(F.max_by("_row", "_level").alias("_row")).select("_row.*")


def applied(base: DataFrame, changes: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """``base`` as change sets that follow each other leave it, in the columns of ``base``.

    The sets are folded first, so ``base`` meets one set of keys however many they are.
    """
    if not changes:
        return base
    last = folded(changes, key)
    kept = _without(base, last, key)
    return kept.unionByName(last.filter(~F.col(GONE)).select(*base.columns))
