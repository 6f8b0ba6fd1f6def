"""Ranked lexical search by dual trees.

Items and documents are points whose coordinates are terms: an item's are the weights of its
terms, a document's what a term adds to a score there. The score of a pair is their product. Over
both stand hierarchies whose nodes hold the coordinate maxima of what is below them, so the
product of two nodes bounds the scores of all their pairs. A pair of nodes whose bound is below
the weakest k-th score of the node's items is left out with everything below it; that is exact.

Weights need counts over all documents, which are taken first. A task then keeps the best
documents of its own for each item, and the best of these are the result.
"""

from __future__ import annotations

import math
from collections import Counter
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from postledger.llm.common import process_cache, shuffle_partitions, written
from postledger.llm.terms import in_blocks, term_pieces, terms_of

# Terms of items whose tree a worker holds at a time.
BLOCK_TERMS = 50_000
# Children of a node, and cells of the table of documents that a task searches at a time.
FANOUT, CELLS = 16, 1 << 21
# Up to here doubles hold all integers.
_EXACT = 1 << 53


def added(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score per unit of weight, below a million."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(documents: int, having: int) -> int:
    """The weight of a term that ``having`` of ``documents`` documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


class Tree:
    """Rows of a table, and above them nodes of ``FANOUT`` children each that hold their maxima."""

    def __init__(self, rows: np.ndarray, levels: int):
        self.levels = [rows]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), FANOUT), axis=0))


def children(nodes: np.ndarray, count: int) -> np.ndarray:
    """The children of nodes, where the level below has ``count``."""
    below = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    return below[below < count]


def alike_first(rows: np.ndarray) -> np.ndarray:
    """An order of rows that puts those side by side whose two largest coordinates are the same."""
    if not len(rows):
        return np.zeros(0, np.int64)
    first = rows.argmax(axis=1)
    rest = rows.copy()
    rest[np.arange(len(rows)), first] = 0
    return np.lexsort((rest.argmax(axis=1), first))


class Search:
    """The ``k`` best documents of each item among those that were searched."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, k: int):
        """``items``: the places of each item's terms among all terms, which weigh ``weights``."""
        self.k = k
        # Sums of all coordinates must be exact.
        self.kind = np.float64 if len(weights) * int(weights.max(initial=1)) * 1_000_000 < _EXACT else np.int64
        table = np.zeros((len(items), len(weights)), self.kind)
        for i, own in enumerate(items):
            table[i, own] = weights[own]
        self.items = alike_first(table)
        self.tree = Tree(table[self.items], 2)
        self.best: list[list[tuple]] = [[] for _ in items]
        self.weakest = np.zeros(len(items), self.kind)
        self.weights = weights

    def add(self, ids: list, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> None:
        """Search documents ``ids``, of which ``doc`` holds ``term`` so many times; ``m`` by document."""
        table = np.zeros((len(ids), len(self.weights)), self.kind)
        table[doc, term] = added(tf, m[doc])
        order = alike_first(table * self.weights.astype(self.kind))
        docs = Tree(table[order], 2)
        tops = (self.tree.levels[2] @ docs.levels[2].T).max(axis=0, initial=0)
        for top in np.argsort(-tops, kind="stable"):
            self._descend(docs, top, order, ids)

    def _bound(self, level: int) -> np.ndarray:
        """The weakest k-th score below each node of the items."""
        weakest = self.weakest
        for _ in range(level):
            weakest = np.minimum.reduceat(weakest, np.arange(0, len(weakest), FANOUT))
        return weakest

    def _descend(self, docs: Tree, top: int, order: np.ndarray, ids: list) -> None:
        items = self.tree
        bounds = items.levels[2] @ docs.levels[2][top]
        rows = np.flatnonzero((bounds >= self._bound(2)) & (bounds > 0))
        if not len(rows):
            return
        rows = children(rows, len(items.levels[1]))
        columns = children(np.array([top]), len(docs.levels[1]))
        bounds = items.levels[1][rows] @ docs.levels[1][columns].T
        alive = (bounds >= self._bound(1)[rows][:, None]) & (bounds > 0)
        found: dict[int, list[tuple]] = {}
        for j in np.flatnonzero(alive.any(axis=0)):
            below = children(rows[alive[:, j]], len(items.levels[0]))
            leaves = children(columns[j : j + 1], len(docs.levels[0]))
            scores = items.levels[0][below] @ docs.levels[0][leaves].T
            hit = (scores >= self.weakest[below][:, None]) & (scores > 0)
            for a, b in zip(*np.nonzero(hit), strict=True):
                id_ = ids[order[leaves[b]]]
                found.setdefault(int(below[a]), []).append((-int(scores[a, b]), id_ is None, 0 if id_ is None else id_))
        for item, new in found.items():
            self.best[item] = sorted(self.best[item] + new)[: self.k]
            if len(self.best[item]) == self.k:
                self.weakest[item] = -self.best[item][-1][0]

    def results(self) -> list[tuple]:
        """(item, id, score)."""
        return [(int(self.items[i]), None if none else id_, -score) for i, best in enumerate(self.best) for score, none, id_ in best]


def _counts(data: bytes, places: dict[bytes, int]) -> tuple[int, Counter]:
    """The terms of a text, and how often it has those of the items, by place."""
    n, held = 0, Counter()
    for words in term_pieces(data):
        n += len(words)
        held.update(map(places.get, words))
    held.pop(None, None)
    return n, held


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))


def statistics(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the documents that hold each term of ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast([term.encode() for term in vocabulary])

    def run(batches):
        places = {term: i for i, term in enumerate(shared.value)}
        having, documents, terms = np.zeros(len(places), np.int64), 0, 0
        for batch in batches:
            for data in batch.column(0):
                n, held = _counts(data.as_py(), places)
                documents, terms = documents + (n > 0), terms + n
                having[list(held)] += 1
        some = np.flatnonzero(having)
        numbers = pa.array(np.r_[[-2, -1], some].astype(np.int64))
        yield pa.RecordBatch.from_arrays([numbers, pa.array(np.r_[[documents, terms], having[some]].astype(np.int64))], ["term", "n"])

    counted = _texts(docs, text_col, text_col).select("text").mapInArrow(run, "term long, n long")
    # A row per term of the items comes back, whatever the documents hold.
    totals = counted.groupBy("term").agg(F.sum("n").alias("n"))
    found = {row.term: row.n for row in totals.collect()}
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(i, 0) for i in range(len(vocabulary))], np.int64)


def _search(docs: DataFrame, block: list, id_type, k: int, id_col: str, text_col: str) -> DataFrame:
    """The best documents of a block of items (id, terms) in each task: (item, item_id, id, score)."""
    vocabulary = sorted({term for _, terms in block for term in terms})
    documents, length, having = statistics(docs, vocabulary, text_col)
    weights = np.array([weight(documents, int(n)) for n in having], np.int64)
    places = {term.encode(): i for i, term in enumerate(vocabulary)}
    items = [np.array([places[t.encode()] for t in terms], np.int64) for _, terms in block]
    shared = docs.sparkSession.sparkContext.broadcast((places, items, [id_ for id_, _ in block], weights))
    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    arrow_type = to_arrow_type(id_type)

    def run(batches):
        places, items, item_ids, weights = shared.value
        search = Search(items, weights, k)
        most = max(FANOUT, CELLS // max(1, len(weights)))
        ids, sizes, doc, term, tf = [], [], [], [], []
        doc_type = None

        def flush():
            if ids:
                # A document's length against the mean, in percent.
                m = np.array([10 + 90 * n * documents // length for n in sizes], np.int64)
                search.add(ids, np.array(doc, np.int64), np.array(term, np.int64), np.array(tf, np.int64), m)
            for held in (ids, sizes, doc, term, tf):
                held.clear()

        for batch in batches:
            doc_type = batch.column(0).type
            for id_, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, held = _counts(data.as_py(), places)
                if not held:
                    continue
                doc.extend([len(ids)] * len(held))
                term.extend(held)
                tf.extend(held.values())
                ids.append(id_)
                sizes.append(n)
                if len(ids) == most:
                    flush()
        flush()
        found = search.results()
        if found:
            numbers, own, scores = zip(*found, strict=True)
            columns = [pa.array(numbers, pa.int64()), pa.array([item_ids[i] for i in numbers], arrow_type), pa.array(own, doc_type), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "id", "score"])

    return rows.mapInArrow(run, f"item long, item_id {id_type.simpleString()}, id {kind}, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: (item id, rank, id, score), ranked from 1.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.
    A term weighs the more the fewer documents hold it; a document scores the weights of the
    item's terms, each counted once, by how often it holds them for its length. All but the
    logarithm is integer arithmetic. Only scores above 0 count; equal ones rank by ascending id,
    NULL last.

    Items come in blocks of some ``block_terms`` terms, so what is broadcast is bounded; each
    block is two passes over the texts. Of every task at most ``k`` documents an item are
    shuffled. Texts are read in pieces, so a very long one takes little more than itself.

    A NULL text has no terms, and neither has an empty one; without terms a document is never
    found, and an item finds none. Every row of ``items`` is ranked by itself, also where ids are
    NULL or repeat. So is every row of ``docs``: rows that are equal take a rank each. Other
    columns are not read. No documents, or no items, give no rows.
    """
    asked = items.select(F.col(item_id_col).alias("id"), F.array_distinct(terms_of(item_text_col)).alias("terms")).filter(F.size("terms") > 0)
    id_type = asked.schema["id"].dataType
    parts = []
    for number, block in enumerate(in_blocks(asked, "terms", block_terms)):
        found = _search(docs, [(row.id, row.terms) for row in block], id_type, k, id_col, text_col)
        parts.append(found.withColumn("block", F.lit(number)))
    if not parts:
        kind = docs.schema[id_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"`{item_id_col}` {id_type.simpleString()}, rank int, `{id_col}` {kind}, score long")
    if len(parts) > 1:
        # Written, so that the tasks of one block end before those of the next begin.
        parts = [written(part, "found") for part in parts]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return (
        found.repartition(shuffle_partitions(docs.sparkSession), "block", "item")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(F.col("item_id").alias(item_id_col), "rank", F.col("id").alias(id_col), "score")
    )
