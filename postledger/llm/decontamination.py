"""Benchmark decontamination by Wu-Manber search for windows of words.

The alphabet is words, a block is two of them. The shift table says for each block how far the
search may move on before a window can end; a block that it lacks lets it jump over all but one
word of a window. Where a shift is 0, the hash of the last block names a bucket of windows, and
that of the first block those within it that are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postledger.llm.common import numbered, process_cache, written
from postledger.llm.terms import in_blocks, term_pieces, terms_of

WINDOW = 10
# Windows whose tables a worker holds at a time, and windows of an item that stay together.
BLOCK_WINDOWS, PIECE_WINDOWS = 200_000, 4096
_FOUND = "n_words long, spans array<struct<begin:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


class WuManber:
    """Finds windows that are all ``length`` words long."""

    def __init__(self, windows: Iterable[tuple[bytes, ...]], length: int):
        """Distinct ``windows``; they are numbered in this order."""
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[tuple[int, list[bytes]]]]] = {}
        for number, window in enumerate(windows):
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            alike = self.buckets.setdefault(window[-self.block :], {}).setdefault(window[: self.block], [])
            alike.append((number, list(window)))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Where a window begins, and its number, in order of places."""
        shift, buckets, block, jump, length = self.shift, self.buckets, self.block, self.jump, self.length
        end = length
        while end <= len(words):
            last = tuple(words[end - block : end])
            step = shift.get(last, jump)
            if step:
                end += step
                continue
            begin = end - length
            for number, window in buckets[last].get(tuple(words[begin : begin + block]), ()):
                if words[begin:end] == window:
                    yield begin, number
                    break
            end += 1


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (begin, end) in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((begin, end))
    return out


class Windows:
    """All windows of a block of items, by length: most have ``window`` words, those of shorter items fewer."""

    def __init__(self, pieces: Iterable[tuple[str, Sequence[str]]], window: int):
        """``pieces``: item, and consecutive words of it."""
        self.window = window
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for item, words in pieces:
            own = [w.encode() for w in words]
            length = min(window, len(own))
            held = by_length.setdefault(length, {})
            for begin in range(len(own) - length + 1):
                held.setdefault(tuple(own[begin : begin + length]), set()).add(item)
        self.searches = [(WuManber(held, length), list(held.values())) for length, held in by_length.items()]

    def find(self, data: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Words of a text, the spans of them that lie in windows, and the items whose windows occur."""
        before, carry, spans, seen = 0, [], [], [set() for _ in self.searches]
        for words in term_pieces(data):
            # Windows may begin within the words of the piece before.
            words = carry + words
            for (search, _), numbers in zip(self.searches, seen, strict=True):
                for begin, number in search.occurrences(words):
                    numbers.add(number)
                    spans.append((before + begin, before + begin + search.length))
            spans = merged(spans)
            moved = max(0, len(words) - self.window + 1)
            before += moved
            carry = words[moved:]
        items = {item for (_, held), numbers in zip(self.searches, seen, strict=True) for number in numbers for item in held[number]}
        return before + len(carry), spans, sorted(items)


def _item_pieces(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item, words): items of many words in pieces, which share all but one word of a window."""
    words = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), terms_of(text_col).alias("words")).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    begins = words.select("item", "words", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE_WINDOWS))).alias("begin"))
    return begins.select("item", F.slice("words", F.col("begin") + 1, F.lit(PIECE_WINDOWS + window - 1)).alias("words"))


def _search(rows: DataFrame, block: list[tuple[str, list[str]]], window: int, kept: Sequence[str], hits_only: bool = False) -> DataFrame:
    """The columns ``kept`` of the rows (..., _text) with what is found of a block of items in each text."""
    name, pieces = uuid4().hex, rows.sparkSession.sparkContext.broadcast(block)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches):
        cache = process_cache("windows")
        if name not in cache:
            cache.clear()
            cache[name] = Windows(pieces.value, window)
        for batch in batches:
            found = [cache[name].find(data.as_py()) for data in batch.column(len(kept))]
            chosen = [i for i, (_, spans, _) in enumerate(found) if spans] if hits_only else range(len(found))
            columns = [batch.column(i).take(pa.array(chosen, pa.int64())) for i in range(len(kept))]
            counts, spans, items = ([found[i][j] for i in chosen] for j in range(3))
            spans = [[{"begin": b, "end": e} for b, e in own] for own in spans]
            arrays = [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], [*kept, "n_words", "spans", "items"])

    return rows.select(*kept, F.coalesce(F.col("_text").cast("binary"), F.lit(b"")).alias("_text")).mapInArrow(run, f"{schema}, {_FOUND}")


def find_benchmarks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """What each row of ``docs`` repeats of the items: (id, n_words, spans, items).

    ``window`` consecutive words of an item that occur in a text are a hit, and so is a whole
    item of fewer words. ``spans`` are the hit words of the text, from ``begin`` to before
    ``end``, counted from 0, in order and apart; ``items`` are the ids, as texts, of the items
    whose windows occur, each once, in order.

    Items come to the tasks in blocks of some ``block_windows`` windows, so what is broadcast is
    bounded; each block is one pass over the texts, and a map without a shuffle where one block
    holds all. Texts are read in pieces, so a very long one takes little more than itself.

    NULL texts have no words, empty ones neither. An item without words has no windows. Items
    that share an id are one; a NULL item id reads as the empty text. Rows that repeat an id or
    a text are kept, each as a row, and so are NULL ids. Other columns are not read. No rows
    give no rows; no items leave every row without a hit.
    """
    blocks = in_blocks(_item_pieces(items, window, item_id_col, item_text_col), "words", block_windows)
    block = [(row.item, row.words) for row in next(blocks, [])]
    following = next(blocks, None)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    if following is None:
        return _search(rows, block, window, ["id"]).withColumnRenamed("id", id_col)
    rows, row = numbered(rows)
    parts = [written(_search(rows, block, window, ["id", row]), "windows")]
    while following is not None:
        block = [(r.item, r.words) for r in following]
        parts.append(written(_search(rows, block, window, ["id", row], hits_only=True), "windows"))
        following = next(blocks, None)
    hits = parts[0].filter(F.size("spans") > 0)
    for part in parts[1:]:
        hits = hits.unionByName(part)

    def join_spans(batches):
        for batch in batches:
            spans = [merged((s["begin"], s["end"]) for s in own) for own in batch.column(1).to_pylist()]
            spans = [[{"begin": b, "end": e} for b, e in own] for own in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS), batch.column(2)], ["_row", "spans", "items"])

    together = hits.groupBy(F.col(row).alias("_row")).agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    found = together.mapInArrow(join_spans, "_row long, spans array<struct<begin:long,end:long>>, items array<string>")
    nothing = [F.array().cast(t).alias(c) for c, t in (("spans", "array<struct<begin:bigint,end:bigint>>"), ("items", "array<string>"))]
    none = [F.coalesce(F.col(c), nothing[i]).alias(c) for i, c in enumerate(("spans", "items"))]
    return parts[0].select("id", row, "n_words").join(found, F.col(row) == F.col("_row"), "left").select(F.col("id").alias(id_col), "n_words", *none)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of what ``find_benchmarks`` gives."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["begin"])
    return found.select(
        id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
