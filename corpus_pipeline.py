"""A corpus pipeline: quality, exact dedup, near-dedup, mixing and tokens, stage by stage.

Every stage reads what the one before has written, whole. All but the last give rows with the
columns of ``documents``. Ids may be NULL or repeat: each row follows the decision on itself, by
a number it has within the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postledger.llm import bpe, exact_dedup, mixing, quality, simhash
from postledger.llm.common import free_name, numbered, only_rows, shuffle_partitions, table, written
from postledger.llm.queries import TOKENIZER
from postledger.storage import scratch_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text the classifier rejects."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each text: the one with the smallest id, NULL last."""
    rows, row = numbered(docs)
    index = exact_dedup.DigestIndex(
        spark, scratch_dir(spark, "digest-index"), docs.schema["doc_id"].dataType.simpleString(), buckets=shuffle_partitions(spark)
    )
    verdicts = exact_dedup.exact_dedup(rows, index, row_col=row)
    return only_rows(rows, verdicts.filter("kept"), row)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the one with the smallest id, NULL last."""
    rows, row = numbered(docs)
    # An id that names one row, and sorts like doc_id.
    key = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    groups = simhash.near_duplicates(rows.select(key.alias("key"), "text"), shingle_words=3, max_bits=2, id_col="key")
    return only_rows(rows, groups.filter("key = component_id").select(F.col("key.row").alias(row)), row)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each row as often as the mix does: not at all, once or more. Rows weigh what the classifier scores them."""
    rows, row = numbered(docs)
    copies, weight = free_name(rows, "copies"), free_name(rows, "weight")
    # The stages before hand on documents alone, so the score is learned and taken again.
    scored = quality.with_score(rows, quality.fit(docs, table(spark, sf_dir, "labels")), weight)
    chosen = mixing.mix(scored, row_col=row, weight_col=weight).filter("copies > 0").select(F.col(row), F.col("copies").alias(copies))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(free_name(rows, "copy"))
    return rows.join(chosen, row).select(*(F.col(f"`{c}`") for c in docs.columns), each).select(*(f"`{c}`" for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each row, as digests."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", tokens),
]

# A learned classifier, XXH64 and BPE cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
