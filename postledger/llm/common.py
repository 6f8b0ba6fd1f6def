"""What several operators share: written intermediate tables, texts, word shingles."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postledger.storage import scratch_dir

# Characters between words: space, and tab to carriage return.
BLANKS = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and outlives executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and the name of that column.

    Rows of Parquet files are known by file and place, which stay what they are however often
    the files are read. Others get a number, and are written, which fixes it.
    """
    row = free_name(docs, "row")
    with_place = _with_place(docs, row)
    if with_place is not None:
        return with_place, row
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _with_place(docs: DataFrame, row: str) -> DataFrame | None:
    """``docs`` with the file and place of each row; None where they are not rows of Parquet files."""
    if "_metadata" in (c.lower() for c in docs.columns):
        return None
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        found = docs.withColumn(row, place)
        found.schema  # noqa: B018
    except AnalysisException:
        return None
    return found


def only_rows(rows: DataFrame, chosen: DataFrame, row: str) -> DataFrame:
    """The rows whose number is among ``chosen``, without the number."""
    return rows.join(chosen.select(row), row, "left_semi").drop(row)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions the session asks of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(text: str | Column) -> Column:
    """The text; empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks.

    Functions come to a worker by value, each time with globals of their own, so what is
    costly to build is kept in a module that only the worker has.
    """
    module = sys.modules.setdefault("_postledger_llm_cache", types.ModuleType("_postledger_llm_cache"))
    return module.__dict__.setdefault(name, {})


def lowered_words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased. ``bytes`` knows ASCII blanks and letters only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], length: int) -> Iterator[bytes]:
    """Runs of ``length`` words, repeats included; all words where there are fewer; none of none."""
    if len(words) < length:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(length)), strict=False))


def shingle_hashes(words: list[bytes], length: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle."""
    count = max(len(words) - length + 1, min(len(words), 1))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, length), repeat(seed)), np.uint64, count)


_BLANK_BEFORE_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
# What Python takes for a blank, in front of a space, for Arrow's matcher.
_ANY_BLANK = "".join(f"\\x{{{i:x}}}" for i in range(sys.maxunicode + 1) if chr(i).isspace())


def units(text: str) -> list[str]:
    """``text`` cut before every space that follows a character which is no blank.

    No token of a byte-level pre-tokenizer reaches over such a place, so units are encoded
    each by itself, and repeated ones only once.
    """
    return _CUT.split(text) if text else []


class UnitStore:
    """Ids of units that were encoded before. Forgets the older half when it is full."""

    def __init__(self, encode, most_chars: int = 4_000_000):
        """``encode`` gives the ids of each unit of a list, as bytes."""
        self.encode, self.most_chars = encode, most_chars
        self.chars = 0
        self.whole: dict[str, bytes] = {}
        # Most units are a space and what follows; these are kept by the latter.
        self.spaced: dict[str, bytes] = {}

    def _forget(self) -> None:
        self.whole, self.spaced = (dict(islice(held.items(), len(held) // 2, None)) for held in (self.whole, self.spaced))
        self.chars = sum(map(len, self.whole)) + sum(map(len, self.spaced))

    def _learn(self, plain: list[str], spaced: list[str]) -> None:
        kept = self.encode([*plain, *(" " + piece for piece in spaced)])
        self.whole.update(zip(plain, kept, strict=False))
        self.spaced.update(zip(spaced, kept[len(plain) :], strict=True))
        self.chars += sum(map(len, plain)) + sum(map(len, spaced))

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        cut: list[tuple[list[str], list[str]]] = []  # units as they are, and then pieces behind a space
        for text in texts:
            if _BLANK_BEFORE_SPACE.search(text) or text.startswith(" "):
                cut.append((units(text), []))
            else:
                pieces = text.split(" ")
                cut.append((pieces[:1] if text else [], pieces[1:]))
        if self.chars > self.most_chars:
            self._forget()
        plain = set().union(*(own for own, _ in cut)).difference(self.whole)
        spaced = set().union(*(own for _, own in cut)).difference(self.spaced)
        if plain or spaced:
            self._learn(list(plain), list(spaced))
        whole, behind = self.whole.__getitem__, self.spaced.__getitem__
        return [b"".join([*map(whole, own), *map(behind, rest)]) for own, rest in cut]

    def column_ids(self, texts: pa.Array) -> pa.Array:
        """The ids of each text of an Arrow column without NULLs, as binary: what ``ids`` gives.

        Arrow cuts the texts, finds the distinct pieces of all of them and puts the ids together;
        only distinct pieces are looked up here.
        """
        blank = pc.or_(pc.match_substring_regex(texts, f"[{_ANY_BLANK}] "), pc.starts_with(texts, " "))
        odd = dict(zip(np.flatnonzero(blank.to_numpy(zero_copy_only=False)).tolist(), self.ids(texts.filter(blank).to_pylist()), strict=True))
        cut = pc.split_pattern(pc.if_else(blank, "", texts) if odd else texts, " ")
        offsets = cut.offsets.to_numpy()
        pieces = cut.values.slice(offsets[0], offsets[-1] - offsets[0])
        begins = offsets[:-1] - offsets[0]
        first = pieces.take(pa.array(begins)).to_pylist()
        coded = pieces.dictionary_encode()
        # Pieces that only begin texts are not behind a space.
        at = coded.indices.to_numpy().copy()
        at[begins] = -1
        seen = np.bincount(at + 1, minlength=len(coded.dictionary) + 1)[1:] > 0
        behind = np.flatnonzero(seen)
        spaced = coded.dictionary.take(pa.array(behind)).to_pylist()
        if self.chars > self.most_chars:
            self._forget()
        plain = {piece for piece in first if piece}.difference(self.whole)
        fresh = [piece for piece in spaced if piece not in self.spaced]
        if plain or fresh:
            self._learn(list(plain), fresh)
        heads = [odd[i] if i in odd else self.whole[piece] if piece else b"" for i, piece in enumerate(first)]
        known = pa.array([*map(self.spaced.__getitem__, spaced), *heads], pa.large_binary())
        place = np.zeros(len(seen), np.int64)
        place[behind] = np.arange(len(behind))
        at = place[at]
        at[begins] = len(behind) + np.arange(len(begins))
        _, ends, data = known.take(pa.array(at)).buffers()
        bounds = np.frombuffer(ends, np.int64, len(at) + 1)[np.r_[begins, len(at)]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds.copy()), data])


def gathered(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of all elements of runs that begin at ``starts`` and hold ``counts`` elements."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def in_slices(column, chars: int = 250_000, rows: int = 128) -> Iterator[list[str]]:
    """The texts of an Arrow column in order, some at a time, so that what is made of them stays small."""
    for at in range(0, len(column), rows):
        texts = [text or "" for text in column.slice(at, rows).to_pylist()]
        begin = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= chars:
                yield texts[begin : i + 1]
                begin, size = i + 1, 0
        if begin < len(texts):
            yield texts[begin:]


def in_pieces(column: pa.Array, size: int = 3 << 20) -> Iterator[pa.Array]:
    """An Arrow column of texts in order, some ``size`` bytes at a time, NULLs as empty texts."""
    column = column.fill_null("")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(column):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, "right")))
        yield column.slice(begin, end - begin)
        begin = end
