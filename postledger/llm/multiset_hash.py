"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A paragraph (the text between line ends) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors. So it does not depend on their order, and a
paragraph is put in or taken out by adding or subtracting its vector.

A vector has ``MARKS`` lanes modulo 2**64 that hash the paragraph as a whole and tell texts
apart, and ``LANES`` lanes modulo 2**32 in which every pair of neighbouring words counts up or
down by one. Sums of the latter keep lengths and angles of the documents' counts of word pairs
(a count sketch), so the likeness of two documents is read off their fingerprints alone.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postledger.llm.common import shingle_hashes, shuffle_partitions, text_or_empty, written

MARKS, LANES = 8, 128


class Fingerprint:
    """A sum of paragraph vectors."""

    __slots__ = ("lanes", "marks")

    def __init__(self, marks: np.ndarray | None = None, lanes: np.ndarray | None = None):
        self.marks = np.zeros(MARKS, np.uint64) if marks is None else marks
        self.lanes = np.zeros(LANES, np.int32) if lanes is None else lanes

    @classmethod
    def of(cls, paragraphs: Sequence[str]) -> Fingerprint:
        """The sum of the vectors of ``paragraphs``."""
        raw = [p.encode("utf-8", "surrogatepass") for p in paragraphs]
        if not raw:
            return cls()
        digests = b"".join(hashlib.blake2b(p, digest_size=8 * MARKS).digest() for p in raw)
        marks = np.frombuffer(digests, "<u8").reshape(-1, MARKS).sum(axis=0, dtype=np.uint64)
        hashes = np.concatenate([shingle_hashes(p.split(), 2) for p in raw])
        lane = (hashes % np.uint64(LANES)).astype(np.int64)
        up = (hashes >> np.uint64(63)).astype(np.int64)
        counts = np.bincount(2 * lane + up, minlength=2 * LANES)
        return cls(marks, (counts[1::2] - counts[::2]).astype(np.int32))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.marks + other.marks, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.marks - other.marks, self.lanes - other.lanes)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.hex() == other.hex()

    __hash__ = None

    def hex(self) -> str:
        return self.marks.astype("<u8").tobytes().hex() + self.lanes.astype("<i4").tobytes().hex()

    @classmethod
    def from_hex(cls, digits: str) -> Fingerprint:
        raw = bytes.fromhex(digits)
        return cls(np.frombuffer(raw, "<u8", MARKS).copy(), np.frombuffer(raw, "<i4", LANES, 8 * MARKS).copy())

    def likeness(self, other: Fingerprint) -> float:
        """From 0 for unlike to 1 for equal: twice the shared counts of word pairs over all, as the lanes show them."""
        if (self.marks == other.marks).all() and (self.lanes == other.lanes).all():
            return 1.0
        a, b = self.lanes.astype(np.float64), other.lanes.astype(np.float64)
        size = float(a @ a + b @ b)
        return min(1.0, max(0.0, 2 * float(a @ b) / size)) if size else 0.0


def paragraphs(text: str) -> list[str]:
    """What line ends part; none of an empty text."""
    return text.split("\n") if text else []


def fingerprint(text: str | None) -> Fingerprint:
    """The fingerprint of a text; that of NULL is the empty sum."""
    return Fingerprint.of(paragraphs(text or ""))


def after_edit(before: Fingerprint, taken_out: Sequence[str], put_in: Sequence[str]) -> Fingerprint:
    """The fingerprint of a document once paragraphs were taken out of it and others put in."""
    return before - Fingerprint.of(taken_out) + Fingerprint.of(put_in)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint of every row's whole text: (id, fingerprint), hexadecimal.

    NULL counts as empty; equal texts, and texts with the same paragraphs in any order, have
    equal fingerprints. Repeated rows and NULL ids are kept; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [fingerprint(text.as_py()).hex() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, fingerprint string")


def in_descending_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (part, guest, id, text) such that each row's successor is the next row of its part.

    Rows run by descending id, NULL ids last; rows of one id by a hash of their text. A part is
    a range of ids and sorted within one task; behind it stands, as a guest, the first row of
    the part that follows, and behind the last part that of the first one. Texts are shuffled
    once. ``id`` must be a number. All rows that share an id fall in one part.
    """
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    # As many numbers as there are partitions.
    bounds = np.array(rows.agg(F.percentile_approx("id", shares, 100 * parts)).first()[0] or [], np.float64)

    def part_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(bounds, ids[known].to_numpy(np.float64)) + 1
        return pd.Series(out)

    part = F.pandas_udf(part_of, "int")("id")
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("part", part)
    heads = written(rows.groupBy("part").agg(F.max(F.struct("id", "hash")).alias("head")), "heads")
    # A row per part: small, however large the parts are.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    host = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(order))
    asked = heads.select("part", "head", host.alias("host"))
    is_head = F.struct("id", "hash").eqNullSafe(F.col("head"))
    own = F.struct(F.col("part"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("host").alias("part"), F.lit(1).alias("guest"))
    at = F.explode(F.when(is_head, F.array(own, guest)).otherwise(F.array(own)))
    placed = rows.join(F.broadcast(asked), "part").select("id", "hash", "text", at.alias("at"))
    dealt = placed.select("at.part", "at.guest", "id", "hash", "text").repartitionById(len(bounds) + 2, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", "guest", F.col("id").desc_nulls_last(), F.col("hash").desc())
    return ordered.select("part", "guest", "id", "text")


def fingerprints_and_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and of how like these and the next text are.

    Gives (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    The edited text has its last ``n_chars // 2`` code points replaced by the first as many of
    the next text (all, where it has fewer). The next text is that of the next smaller id; behind
    the last comes the first. The edited fingerprint is made by taking out and putting in the
    paragraphs that differ.

    NULL and empty texts have the empty sum for a fingerprint. A single row is its own next.
    Repeated rows and NULL ids are kept (see ``in_descending_order``); other columns are not
    read. No rows give no rows.
    """
    rows = in_descending_order(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def compare(text: str, own: Fingerprint, after: str, own_after: Fingerprint) -> tuple:
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        old_parts, new_parts = paragraphs(text), paragraphs(new)
        same = sum(1 for _ in itertools.takewhile(lambda x: x[0] == x[1], zip(old_parts, new_parts, strict=False)))
        changed = after_edit(own, old_parts[same:], new_parts[same:])
        digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        return len(text), digest, own.hex(), changed.hex(), own.likeness(changed), own.likeness(own_after)

    def run(batches):
        part, waiting = None, None  # the row whose successor comes next
        for batch in batches:
            ids, out = [], []
            for at, guest, key, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                own = fingerprint(text)
                if at == part and waiting:
                    ids.append(waiting[0])
                    out.append(compare(*waiting[1:], text, own))
                part, waiting = at, None if guest else (key, text, own)
            if out:
                counts, digests, own, changed, near, near_next = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(2).type), pa.array(counts, pa.int64()), *map(pa.array, (digests, own, changed, near, near_next))],
                    [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return rows.mapInArrow(
        run,
        f"{id_col} {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
