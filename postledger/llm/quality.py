"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Every passage of its whole text is encoded from its
characters and words, a hidden layer embeds it, and gated attention weighs the embeddings:
``a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k)))``. The weighted embedding is scored. Only the
document's label is known when the weights are learned (Ilse, Tomczak and Welling, 2018).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from postledger.llm.common import in_slices, written
from postledger.llm.mixing import word_count

PASSAGE_WORDS = 64
# Bounds of the labelled sample that weights are learned from.
MAX_LABELLED, MAX_PASSAGES = 4000, 60_000
# A document of more than this part of the passages is learned from only where smaller ones leave room.
LARGE = 64
# This part of both bounds is kept free for the label that the other would crowd out.
RESERVED = 16
# The score from which a text is predicted 1.
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    """A class for each byte: letters, digits, marks of several kinds, parts of longer characters."""
    kinds = np.full(256, 9, np.int64)
    kinds[ord("a") : ord("z") + 1] = 0
    kinds[ord("A") : ord("Z") + 1] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    for kind, marks in enumerate((b" ", b".,;:", b"!?", b"'\"()-", b"|/\\_<>[]{}", b"#$%&*+=@^~`"), start=3):
        kinds[list(marks)] = kind
    kinds[0x80:0xC0] = 10
    kinds[0xC0:] = 11
    return kinds


_KINDS = _classes()
_N = 12
FEATURES = _N + _N * _N + 6


def passage_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, and how many passages each text has (one at least).

    A passage is ``PASSAGE_WORDS`` words. Its features: shares of byte classes and of their
    pairs, mean and spread of word lengths, shares of distinct words and of words that repeat
    the one before, its length, and the text's.
    """
    words = [text.encode("utf-8", "surrogatepass").split() for text in texts]
    counts = np.array([max(1, -(-len(w) // PASSAGE_WORDS)) for w in words], np.int64)
    total = int(counts.sum())
    every = [word for own in words for word in own]
    per_text = np.array([len(w) for w in words], np.int64)
    begins = np.cumsum(per_text) - per_text
    first = np.cumsum(counts) - counts
    at = np.arange(len(every)) - np.repeat(begins, per_text)
    passage = np.repeat(first, per_text) + at // PASSAGE_WORDS
    lengths = np.fromiter(map(len, every), np.int64, len(every))
    raw = np.frombuffer(b" ".join(every) + b" " if every else b"", np.uint8)
    kind = _KINDS[raw]
    of = np.repeat(passage, lengths + 1)
    single = np.bincount(of * _N + kind, minlength=total * _N).reshape(total, _N).astype(np.float64)
    within = of[1:] == of[:-1]
    pair_at = (of[:-1] * _N + kind[:-1]) * _N + kind[1:]
    pairs = np.bincount(pair_at[within], minlength=total * _N * _N).reshape(total, _N * _N)
    size = np.maximum(single.sum(axis=1), 1)[:, None]
    held = np.bincount(passage, minlength=total)
    some = np.maximum(held, 1)
    mean = np.bincount(passage, lengths, total) / some
    spread = np.sqrt(np.maximum(np.bincount(passage, lengths**2.0, total) / some - mean**2, 0))
    hashes = np.fromiter(map(hash, every), np.int64, len(every))
    order = np.lexsort((hashes, passage))
    p, h = passage[order], hashes[order]
    fresh = np.r_[True, (p[1:] != p[:-1]) | (h[1:] != h[:-1])][: len(every)]
    distinct = np.bincount(p[fresh], minlength=total) / some
    again = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    repeats = np.bincount(passage[1:][again], minlength=total) / some
    shape = np.column_stack([mean / 10, spread / 10, distinct, repeats, held / PASSAGE_WORDS, np.repeat(np.log1p(per_text) / 10, counts)])
    return np.hstack([single / size, pairs / size, shape]).astype(np.float32), counts


@dataclass
class Attention:
    """Learned weights. ``constant`` replaces them where the sample has one label or none."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    constant: float | None = None

    def scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The score of each bag, from 0 to 1."""
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        return _forward(self.weights, (features - self.mean) / self.scale, counts)["score"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    begins = np.cumsum(counts) - counts
    h = np.tanh(x @ w["E"] + w["e"])
    t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    logit = (t * s) @ w["w"]
    top = np.repeat(np.maximum.reduceat(logit, begins), counts)
    raised = np.exp(logit - top)
    a = raised / np.repeat(np.add.reduceat(raised, begins), counts)
    z = np.add.reduceat(a[:, None] * h, begins, axis=0)
    score = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "score": score}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, counts: np.ndarray, labels: np.ndarray, decay: float) -> dict[str, np.ndarray]:
    f = _forward(w, x, counts)
    begins = np.cumsum(counts) - counts
    error = (f["score"] - labels) / len(labels)
    dz = np.repeat(error[:, None] * w["c"], counts, axis=0)
    da = (dz * f["h"]).sum(axis=1)
    mixed = np.repeat(np.add.reduceat(f["a"] * da, begins), counts)
    dlogit = f["a"] * (da - mixed)
    dt = dlogit[:, None] * w["w"] * f["s"] * (1 - f["t"] ** 2)
    ds = dlogit[:, None] * w["w"] * f["t"] * f["s"] * (1 - f["s"])
    dh = (f["a"][:, None] * dz + dt @ w["V"].T + ds @ w["U"].T) * (1 - f["h"] ** 2)
    grads = {
        "E": x.T @ dh, "e": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
        "w": (f["t"] * f["s"]).T @ dlogit, "c": f["z"].T @ error, "d": error.sum(keepdims=True),
    }
    return {k: g + decay * w[k] for k, g in grads.items()}


def fit_bags(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 30, seed: int = 7) -> Attention:
    """Learn the weights by Adam on mini-batches of bags. The same input gives the same weights."""
    if not len(labels) or labels.min() == labels.max():
        return Attention({}, np.zeros(1), np.ones(1), float(labels[0]) if len(labels) else 0.5)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 0.01
    x = ((features - mean) / scale).astype(np.float64)
    draw = np.random.default_rng(seed)
    sizes = {"E": (FEATURES, hidden), "e": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "d": (1,)}
    w = {k: draw.normal(0, 1 / np.sqrt(shape[0]), shape) if len(shape) == 2 or k in "wc" else np.zeros(shape) for k, shape in sizes.items()}
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    begins = np.cumsum(counts) - counts
    for epoch in range(epochs):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), 64):
            bags = order[at : at + 64]
            rows = np.concatenate([np.arange(begins[b], begins[b] + counts[b]) for b in bags])
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 1e-4
            for k, g in _gradients(w, x[rows], counts[bags], labels[bags], 1e-5).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Attention(w, mean, scale)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning: one in five, by checksum of its id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def choose(sizes: list[tuple[int, int]], max_labelled: int, max_passages: int) -> list[int]:
    """Places of the documents to learn from; ``sizes`` has (label, passages) of each, the preferred first.

    A document that does not fit is passed over. Neither label takes the reserved part of the bounds.
    """
    rows, passages = {0: 0, 1: 0}, {0: 0, 1: 0}
    free_rows, free_passages = -(-max_labelled // RESERVED), max_passages // RESERVED
    chosen = []
    for at, (label, size) in enumerate(sizes):
        other = 1 - label
        if max(rows[other], free_rows) + rows[label] < max_labelled and max(passages[other], free_passages) + passages[label] + size <= max_passages:
            rows[label] += 1
            passages[label] += size
            chosen.append(at)
    return chosen


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_passages: int = MAX_PASSAGES, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> Attention:
    """Learn from labelled rows that are not held out.

    The sample is bounded: ``max_labelled`` whole documents that have ``max_passages`` passages
    together, by hash of their ids, those above a ``LARGE`` part of the passages last and by
    size. One that does not fit is passed over, and a ``RESERVED`` part of both bounds stays
    free for either label. Only their features come to the driver. Ids that ``docs`` lacks do
    not count. An id that has both labels is left out, as are NULL ids and labels; an id that
    repeats is one row, the text with the smallest hash.

    Where ``docs`` has one label only, every score will be that label; 0.5 where it has none.
    Fails where no document of a label fits in the part of the passages reserved for it.
    """
    agreed = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    agreed = agreed.agg(F.min(label_col).alias("label"), F.max(label_col).alias("most")).filter("label = most").select("id", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("id").isNotNull() & ~held_out("id"))
    passages = F.greatest(F.lit(1), F.ceil(word_count("text") / PASSAGE_WORDS)).cast("long")
    first = texts.select("id", F.struct(F.xxhash64("text").alias("hash"), passages.alias("passages")).alias("own")).groupBy("id").agg(F.min("own").alias("own"))
    sized = first.join(agreed, "id").select("id", F.col("label").cast("int").alias("label"), F.xxhash64("id").alias("order"), "own.hash", "own.passages")
    sized = written(sized, "labelled-sizes")
    present = {r["label"] for r in sized.select("label").distinct().collect()}
    large = F.when(F.col("passages") > max_passages // LARGE, F.col("passages")).otherwise(0)
    fitting = sized.filter(F.col("passages") <= max_passages // RESERVED).withColumn("large", large)
    # As many rows as the bound, of each label.
    found = [r for label in sorted(present) for r in fitting.filter(F.col("label") == label).orderBy("large", "order", "id").limit(max_labelled).collect()]
    if len(present) == 2 and {r["label"] for r in found} != present:
        raise ValueError(f"no document of a label has {max_passages // RESERVED} passages or fewer; raise max_passages")
    if len(present) < 2:
        return fit_bags(np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), np.array(sorted(present), np.float64))
    found.sort(key=lambda r: (r["large"], r["order"], r["id"]))
    taken = [found[at] for at in choose([(r["label"], r["passages"]) for r in found], max_labelled, max_passages)]
    chosen = docs.sparkSession.createDataFrame([(r["id"], r["hash"]) for r in taken], sized.select("id", F.col("hash").alias("wanted")).schema)
    # The chosen ids are few by their bound.
    rows = texts.join(F.broadcast(chosen), "id").filter(F.xxhash64("text") == F.col("wanted")).select("id", "text").dropDuplicates(["id"])
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, text in enumerate(batch.column(1)):
                features, counts = passage_features([text.as_py() or ""])
                values = pa.array([features.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), pa.array(counts, pa.int64()), values], ["id", "passages", "features"])

    bags = {r["id"]: r for r in rows.mapInArrow(run, f"id {kind}, passages long, features binary").collect()}
    taken.sort(key=lambda r: (r["order"], r["id"]))
    features = np.frombuffer(b"".join(bytes(bags[r["id"]]["features"]) for r in taken), np.float32).reshape(-1, FEATURES)
    counts = np.array([bags[r["id"]]["passages"] for r in taken], np.int64)
    return fit_bags(features, counts, np.array([r["label"] for r in taken], np.float64))


def accepted(docs: DataFrame, model: Attention, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that ``score`` predicts 1, with all their columns. Each row follows its own text, whatever its id."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = [model.scores(*passage_features(some)) for some in in_slices(batch.column(at))]
            yield batch.filter(pa.array((np.concatenate(found) if found else np.zeros(0)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def with_score(docs: DataFrame, model: Attention, column: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and the score of each row's text as ``column``, a new name."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = [model.scores(*passage_features(some)) for some in in_slices(batch.column(at))]
            scores = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def score(docs: DataFrame, model: Attention, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every row's whole text: (id, held_out, score, predicted).

    ``score`` runs from 0 to 1, higher where label 1 is likelier; ``predicted`` is 1 from
    ``threshold`` on. Nothing but the text is an input. A NULL text is scored as the empty one,
    which is one passage without words. Repeated rows and NULL ids (never held out) are kept;
    other columns are not read. No rows give no rows.
    """
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [model.scores(*passage_features(some)) for some in in_slices(batch.column(2))]
            scores = np.concatenate(found) if found else np.zeros(0)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), predicted], [id_col, "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"{id_col} {kind}, held_out boolean, score double, predicted int")
