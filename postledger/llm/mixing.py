"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target of words. Complete passes over a source come first; what is left
of its target is filled with documents in the order of exponential keys, divided by their
quality weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postledger.llm.common import WORD, free_name, shuffle_partitions, text_or_empty, written

# What a document weighs at least, so that none is out of reach.
LEAST_WEIGHT = 0.05


def word_count(text: str) -> Column:
    """Words of a text; none in a NULL one."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def word_length_quality(text: str, words: Column) -> Column:
    """A quality weight from 0.05 to 1 that falls as words grow shorter or longer than usual prose.

    Six code points a word, the blank included, weigh 1.
    """
    mean = F.length(text_or_empty(text)) / words
    ratio = F.least(mean / 6, F.lit(6.0) / mean)
    return F.when(words > 0, F.greatest(F.lit(LEAST_WEIGHT), ratio)).otherwise(F.lit(LEAST_WEIGHT))


def targets(sources: DataFrame, share: float, weights: Sequence[float], most: float) -> DataFrame:
    """The target of each source: (source, source_size, target); one row per source goes in.

    ``share`` times all sizes is dealt out by weight. A target stops at ``most`` times the
    size of its source, and what is over is dealt to the others by weight, until none is above.

    Sources by code point, NULL last, weigh ``weights`` in turn. Filling up by weight caps the
    sources with the smallest caps per weight, so those are found in one pass in that order.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") - 1) % len(weights) + 1)
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("_cap") / F.col("_weight"), "_n")
    before, from_here = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    full = F.col("_cap") <= F.col("_weight") * F.col("_level")
    return (
        sources.withColumn("_n", F.row_number().over(ordered))
        .withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * float(most))
        .withColumn("_all", F.sum("source_size").over(everything) * float(share))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(from_here))
        .withColumn("_full", full)
        .withColumn("_used", F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0.0)))
        .withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything))
        .withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_weight") * (F.col("_all") - F.col("_used")) / F.col("_open")))
        .select("source", "source_size", "source_rows", "target")
    )


def _nth_of_equal(rows: DataFrame) -> DataFrame:
    """The rows with ``nth``, 0 for a row that is alone with its id and digest; equal ones are numbered from 0.

    Only rows that repeat are numbered, within the partitions they were written in, behind as
    many as the partitions before hold of the same: a sum over one row per partition. So equal
    rows, however many, are never one group.
    """
    same = ["id", "digest"]
    repeated = rows.groupBy(*same).agg(F.count("*").alias("_held")).filter("_held > 1")
    repeated = written(repeated.select(F.col("id").alias("_id"), F.col("digest").alias("_digest")), "mix-repeated")
    equal = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    alone = rows.join(repeated, equal, "left_anti").withColumn("nth", F.lit(0).cast("long"))
    found = rows.join(repeated, equal, "left_semi")
    again = written(found.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "mix-again")
    held = again.groupBy(*same, "_part").agg(F.count("*").alias("_held"))
    earlier = Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select(
        F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("_part").alias("_in"), F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(*same, "_part").orderBy("_at")
    numbered = again.withColumn("_nth", F.row_number().over(within) - 1).join(before, equal & (F.col("_part") == F.col("_in")))
    return alone.unionByName(numbered.select(*rows.columns, (F.col("_before") + F.col("_nth")).cast("long").alias("nth")))


def mix(
    docs: DataFrame,
    share: float = 1.5,
    weights: Sequence[float] = (5, 2, 1),
    most: float = 2.0,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality=word_length_quality,
    row_col: str | None = None,
    weight_col: str | None = None,
) -> DataFrame:
    """How much of each row the mix takes: (id, size, source_size, target, copies, taken).

    ``size`` counts words; ``copies`` says how often the row is taken, ``taken`` how many
    words that makes. Whole passes come first. Of the last, incomplete pass a row is taken if
    the middle of its words, in the order of keys, lies within what the target leaves, so a
    source misses its target by half a document at most.

    A row's key is ``-ln(u) / quality``; u is hashed from ``seed``, its id, its text and its number
    among the rows that are equal in both, so every row has a draw of its own and reruns agree.
    ``weight_col`` names a column that holds the quality instead, 0.05 where it holds less or NULL.
    Equal keys follow by id and size. A NULL text has size 0 and is part of each whole pass; a
    text of any length is one row that is taken or not. NULL sources are one source, the last; a
    NULL id is hashed as the text "null". Other columns are not read. No rows give no rows.

    ``row_col`` names a column that tells the rows apart; it is given out as the last column,
    and orders rows that are equal in all else.

    Rows are dealt to groups by ranges of their keys, and the order within a source is summed in
    these, so a source that holds most rows is spread over all tasks, whatever its weights are.
    """
    row = [F.col(row_col).alias("row")] if row_col else []
    number = ["row"] if row_col else []
    texts = docs.withColumn(free_name(docs, "_size"), word_count(text_col))
    size = F.col(texts.columns[-1])
    weight = F.greatest(F.lit(LEAST_WEIGHT), F.col(weight_col)) if weight_col else quality(text_col, size)
    digest = F.unhex(F.md5(text_or_empty(text_col).cast("binary")))
    rows = written(
        texts.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), weight.alias("weight"), digest.alias("digest"), *row),
        "mix-rows",
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    wanted = written(targets(sources, share, weights, most), "mix-targets")
    drawn = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lower(F.hex("digest")), F.col("nth").cast("string"))
    uniform = (F.conv(F.substring(F.md5(drawn.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    keyed = _nth_of_equal(rows).withColumn("key", -F.log(uniform) / F.col("weight")).select("id", "source", "size", "key", *number)
    # Written, which fixes what lies in each range. Ranges follow each other by number.
    spread = keyed.repartitionByRange(shuffle_partitions(docs.sparkSession), F.col("source").asc_nulls_last(), "key", "id", "size")
    ordered = written(spread.withColumn("place", F.spark_partition_id()), "mix-ordered")
    same = ordered["source"].eqNullSafe(wanted["source"])
    placed = ordered.join(wanted, same).drop(wanted["source"])
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = (
        placed.withColumn("passes", passes.cast("long"))
        .withColumn("left", F.col("target") - F.col("passes") * F.col("source_size"))
    )
    by_place = placed.groupBy("source", "place").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_place.select(
        F.col("source").alias("_source"), F.col("place").alias("_place"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("source", "place").orderBy("key", "id", "size", *number).rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / 2
    return (
        placed.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("place") == F.col("_place")))
        .withColumn("copies", F.col("passes") + F.when(middle <= F.col("left"), 1).otherwise(0))
        .select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
                *(F.col(n).alias(row_col) for n in number))
    )
