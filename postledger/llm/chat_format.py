"""Chat formatting by prefix-target expansion.

A conversation becomes one marked-up text. Every assistant turn then becomes an example of
its own: the text up to the end of that turn, where only that reply is trained on.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts every ``<|``
is written ``<||``, so no marker can be found there and the original can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postledger.llm.common import text_or_empty

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_LINE_END = "<|n|>"


def escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _role_in(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(_LINE_END))


def _role_out(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(_LINE_END), F.lit("\n")))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", target_role: str = "assistant") -> DataFrame:
    """A row per conversation: (conv, text, targets).

    ``text`` has all turns in order of ``turn``. ``targets`` holds for each turn of
    ``target_role`` where its own text begins (counted from 0) and how many code points it
    has, as escaped.

    A NULL role or text is empty; a NULL turn comes first; turns of one number follow in order
    of role and text; rows with a NULL conversation form one. Other columns are not read. No
    rows give no rows. A conversation's text must fit in one row (2 GB).
    """
    piece = F.concat(F.lit(OPEN), "_role", F.lit("\n"), "_text", F.lit(CLOSE))
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_text")
    placed = (
        turns.select(
            F.col(conv_col).alias("_conv"),
            F.col("turn").alias("_turn"),
            _role_in(text_or_empty("role")).alias("_role"),
            escaped(text_or_empty("text")).alias("_text"),
            (text_or_empty("role") == target_role).alias("_target"),
        )
        .withColumn("_piece", piece)
        .withColumn("_at", F.row_number().over(order))
        .withColumn("_end", F.sum(F.length("_piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    chars = F.length("_text").cast("long")
    target = F.struct("_at", (F.col("_end") - len(CLOSE) - chars).alias("start"), chars.alias("chars"))
    whole = placed.groupBy("_conv").agg(
        F.sort_array(F.collect_list(F.struct("_at", "_piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("_target"), target))).alias("targets"),
    )
    return whole.select(
        F.col("_conv").alias(conv_col),
        F.array_join("pieces._piece", "").alias("text"),
        F.transform("targets", lambda t: F.struct(t["start"].alias("start"), t["chars"].alias("chars"))).alias("targets"),
    )


def expand_targets(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """An example per target: (conv, example, text, loss_start, loss_chars).

    ``text`` is the conversation up to the end of the target turn; the loss mask covers
    ``loss_chars`` code points of it from ``loss_start`` on, which is the reply alone.
    """
    start, chars = F.col("target.start"), F.col("target.chars")
    return formatted.select(conv_col, "text", F.posexplode("targets").alias("example", "target")).select(
        conv_col,
        "example",
        F.substring("text", F.lit(1), (start + chars + len(CLOSE)).cast("int")).alias("text"),
        start.alias("loss_start"),
        chars.alias("loss_chars"),
    )


def masked_text(examples: DataFrame) -> Column:
    """The text under an example's loss mask, as it was before it was escaped."""
    return unescaped(F.substring("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text: an array of structs (role, text)."""
    split = F.split(text, r"<\|im_start\|>")
    pieces = F.slice(split, F.lit(2), F.size(split))

    def turn(piece: Column) -> Column:
        cut = F.locate("\n", piece)
        body = F.substring(piece, cut + 1, F.length(piece) - cut - len(CLOSE))
        return F.struct(_role_out(F.substring(piece, F.lit(1), cut - 1)).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)
