"""Token ids as raw binary shards with a minimal perfect hash index in each.

A shard file holds the ids of its documents one behind the other, each document ended by id 0,
as little-endian unsigned numbers of 2 or 4 bytes. Behind them stands the index:

    keys | key runs | offsets | hash levels | slots | footer

* ``keys``: JSON list of the distinct document keys, in order of the documents.
* ``key runs``: for each key the first of its documents, as u32, and one more for the end.
* ``offsets``: where each document's ids begin, counted in ids, as u64, and one more.
* ``hash levels``: bit arrays of a minimal perfect hash. A key's slot is the number of set bits
  before the bit it hashes to, in the first level where that bit is set.
* ``slots``: for each slot a 32-bit fingerprint of its key, and the key's place, as u32 each.
* ``footer``: the counts and sizes needed to find all this from the end of the file.

Shards are written by Spark's text writer, whose line end is id 0, and read as binary files:
no executor needs to reach the storage but through Spark. A shard's first and last key are in
a manifest, so that a key is looked up in one shard only.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postledger.llm.bpe import ByteBpe, byte_letters, cut_words, joined_words
from postledger.llm.common import UnitStore, in_pieces, process_cache, shuffle_partitions, text_or_empty, written

FOOTER = "<QQQQQQ8s"
MAGIC = b"PLTOKEN1"  # little-endian throughout
MAX_LEVELS = 48
SHARD_BYTES = 64 * 1024 * 1024
# Units that any byte-level pre-tokenizer cuts alike: Latin letters, all of which are letters
# in every version of Unicode, a space before and marks behind them; then perhaps a line end
# and such a word again. Marks that added tokens are usually made of are not among these.
LATIN, CLOSING = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f", r"!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~"
PLAIN = re.compile(f"( ?[{LATIN}]+)([{CLOSING}]{{0,8}})(?:\n([{LATIN}]+)([{CLOSING}]{{0,8}}))?")
PLAIN_CHARS = re.compile(f"[ \n{LATIN}{CLOSING}]*")


def _key_hash(key, seed: int) -> int:
    return xxhash.xxh64_intdigest(b"\0" if key is None else str(key).encode(), seed)


def _spread(hashes: np.ndarray, level: int) -> np.ndarray:
    """Another hash of each hash, for one level (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys, without the keys: some three bits for each."""

    def __init__(self, levels: list[np.ndarray]):
        """``levels``: per level an array of 0 and 1."""
        self.levels = levels
        sizes = [int(x.sum()) for x in levels]
        self.before = np.cumsum([0, *sizes])[: len(sizes)]
        self.ranks = [np.cumsum(x) - x for x in levels]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """From distinct hashes of the keys. Keys that share a bit of a level go on to the next."""
        levels, left = [], hashes
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys with equal hashes")
            size = max(64, 2 * len(left))
            at = (_spread(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.int64))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit. A key that was not built in may get any."""
        out = np.full(len(hashes), -1, np.int64)
        for level, bits in enumerate(self.levels):
            at = (_spread(hashes, level) % np.uint64(len(bits))).astype(np.int64)
            hit = (out < 0) & (bits[at] == 1)
            out[hit] = self.before[level] + self.ranks[level][at[hit]]
        return out

    def to_bytes(self) -> bytes:
        sizes = struct.pack(f"<{1 + len(self.levels)}Q", len(self.levels), *map(len, self.levels))
        return sizes + b"".join(np.packbits(x.astype(np.uint8)).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        (count,) = struct.unpack_from("<Q", data)
        levels, at = [], 8 + 8 * count
        for size in struct.unpack_from(f"<{count}Q", data, 8):
            length = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, length, at), count=size).astype(np.int64))
            at += length
        return cls(levels)


def build_index(keys: Sequence, counts: Sequence[int]) -> bytes:
    """The index of a shard: ``keys`` of its documents, equal ones side by side, and ids of each (the last one included)."""
    firsts = [i for i, key in enumerate(keys) if i == 0 or key != keys[i - 1]]
    distinct = [keys[i] for i in firsts]
    hashes = np.array([_key_hash(key, 0) for key in distinct], np.uint64)
    perfect = PerfectHash.build(hashes)
    places = np.zeros((len(distinct), 2), "<u4")
    slots = perfect.slots(hashes)
    places[slots, 0] = [_key_hash(key, 1) & 0xFFFFFFFF for key in distinct]
    places[slots, 1] = np.arange(len(distinct))
    offsets = np.cumsum([0, *counts]).astype("<u8")
    parts = [
        json.dumps(distinct).encode(),
        np.array([*firsts, len(keys)], "<u4").tobytes(),
        offsets.tobytes(),
        perfect.to_bytes(),
        places.tobytes(),
    ]
    payload = int(offsets[-1])
    return b"".join(parts) + struct.pack(FOOTER, payload, len(keys), len(distinct), len(parts[0]), len(parts[3]), sum(map(len, parts)), MAGIC)


class Shard:
    """A shard file, as it was read."""

    def __init__(self, content: bytes, width: int):
        self.content, self.width = content, width
        end = len(content) - width - struct.calcsize(FOOTER)
        self.n_ids, self.n_docs, self.n_keys, key_bytes, level_bytes, index_bytes, magic = struct.unpack_from(FOOTER, content, end)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = end - index_bytes
        self.keys = json.loads(content[at : at + key_bytes])
        at += key_bytes
        self.runs = np.frombuffer(content, "<u4", self.n_keys + 1, at).astype(np.int64)
        at += 4 * (self.n_keys + 1)
        self.offsets = np.frombuffer(content, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.hash = PerfectHash.from_bytes(content[at : at + level_bytes])
        at += level_bytes
        self.places = np.frombuffer(content, "<u4", 2 * self.n_keys, at).reshape(-1, 2)

    def look_up(self, keys: Sequence) -> list[range]:
        """The documents of each key, by place in the shard; none for a key that it lacks."""
        slots = self.hash.slots(np.array([_key_hash(key, 0) for key in keys], np.uint64))
        out = []
        for key, slot in zip(keys, slots.tolist(), strict=True):
            known = slot >= 0 and int(self.places[slot, 0]) == _key_hash(key, 1) & 0xFFFFFFFF
            place = int(self.places[slot, 1]) if known else -1
            known = known and self.keys[place] == key
            out.append(range(self.runs[place], self.runs[place + 1]) if known else range(0))
        return out

    def ids(self, document: int) -> np.ndarray:
        """The ids of a document, its last one included."""
        begin, end = self.offsets[document], self.offsets[document + 1]
        return np.frombuffer(self.content, f"<u{self.width}", end - begin, begin * self.width)


def _library(content, width: int) -> UnitStore:
    """Encodes with the tokenizers library, each distinct unit once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    cache = process_cache("tokenizers")
    if (content.value, width) not in cache:
        tokenizer = Tokenizer.from_buffer(content.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        byte_level = ByteBpe(content.value)
        marks, added, cut = byte_level.marks, byte_level.added, tokenizer.pre_tokenizer.pre_tokenize_str
        merge, plain, letters, kind = tokenizer.model.tokenize, PLAIN.fullmatch, dict(enumerate(byte_letters())), "H" if width == 2 else "I"
        # Where every added token has a character that plain units lack, none needs a look.
        may_be_added = marks.search if any(map(PLAIN_CHARS.fullmatch, added)) else None
        closing: dict[str, bytes] = {"": b""}

        def packed(ids: list[int]) -> bytes:
            try:
                return array(kind, ids).tobytes()
            except OverflowError:
                raise ValueError(f"ids need more than {width} bytes") from None

        def of_words(found: list[str]) -> list[bytes]:
            # The library cuts a unit to words, and its model merges each distinct word once.
            parts, words = cut_words(found, cut, marks, added)
            ids = [packed([token.id for token in merge(w)]) for w in words]
            return joined_words(parts, ids, lambda i: packed([i]))

        def of_word(word: str) -> bytes:
            word = word.replace(" ", letters[0x20]) if word.isascii() else word.encode().decode("latin-1").translate(letters)
            return packed([token.id for token in merge(word)])

        def of_marks(found: str) -> bytes:
            if found not in closing:
                closing[found] = packed([token.id for token in merge(found.replace("\n", letters[0x0A]))])
            return closing[found]

        def encode(found: list[str]) -> list[bytes]:
            out: list[bytes] = []
            others: list[int] = []
            for i, unit in enumerate(found):
                cut_here = plain(unit)
                if cut_here is None or (may_be_added and may_be_added(unit)):
                    others.append(i)
                    out.append(b"")
                    continue
                # Words, and what closes them: the library would cut here, too.
                word, end, below, last = cut_here.groups()
                # A word may be known without what closes it.
                ids = (store.spaced.get(word[1:]) if end or below else None) or of_word(word) if word[0] == " " else of_word(word)
                if end:
                    ids += of_marks(end)
                if below:
                    ids += of_marks("\n") + (store.whole.get(below) or of_word(below)) + of_marks(last)
                out.append(ids)
            for i, ids in zip(others, of_words([found[i] for i in others]), strict=True):
                out[i] = ids
            return out

        store = cache[content.value, width] = UnitStore(encode, 6_000_000)
    return cache[content.value, width]


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, width: int = 2, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every row's whole text and write the ids to shards under ``path``, by ascending id.

    ``tokenizer`` is a file of the tokenizers library with byte-level pre-tokenization, on the
    driver; ``width`` 2 holds ids up to 65535, 4 all. There are as many shards as the
    session's shuffle partitions, or more, so that each has some ``shard_bytes`` of text.

    A NULL text is empty: just the last id. A NULL id comes first. Rows of one id lie side by
    side, in any order, and are found together; a range of ids is split at random where one id
    has very many rows. Other columns are not read. No rows give no documents.
    """
    with open(tokenizer, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(shuffle_partitions(docs.sparkSession), -(-size // shard_bytes))
    spread = rows.withColumn("salt", F.rand(42)).repartitionByRange(shards, F.col("id").asc_nulls_first(), "salt")
    ordered = spread.sortWithinPartitions(F.col("id").asc_nulls_first()).select("id", "text")

    def run(batches):
        store = _library(content, width)
        keys, counts = [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            for texts in in_pieces(batch.column(1)):
                parts = store.column_ids(texts)
                counts += (pc.binary_length(parts).to_numpy(zero_copy_only=False) // width + 1).tolist()
                yield pa.RecordBatch.from_arrays([parts.cast(pa.binary())], ["value"])
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([build_index(keys, counts)], pa.binary())], ["value"])

    encoded = ordered.mapInArrow(run, "value binary")
    # The line end behind each row is the last id of its document.
    encoded.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0" * width).text(path)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")


def read_index(spark: SparkSession, path: str, width: int = 2, id_type: str = "bigint") -> DataFrame:
    """Every document of the shards, found by its key: (id, shard, start, n_tokens, ids_crc32).

    ``start`` counts the ids of the shard before the document; the checksum is that of the ids
    as little-endian unsigned 32-bit numbers.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(content.as_py(), width)
                found = shard.look_up(shard.keys)
                rows = [(key, i) for key, places in zip(shard.keys, found, strict=True) for i in places]
                sums = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for _, i in rows]
                at = np.array([i for _, i in rows], np.int64)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array([key for key, _ in rows]).cast(pa_type),
                    "shard": pa.array([number] * len(rows), pa.int32()),
                    "start": shard.offsets[at],
                    "n_tokens": shard.offsets[at + 1] - shard.offsets[at],
                    "ids_crc32": pa.array(sums, pa.int64()),
                })

    pa_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    # Empty partitions leave empty files.
    held = _shards(spark, path).filter(F.length("content") > 0)
    return held.mapInArrow(run, f"id {id_type}, shard int, start long, n_tokens long, ids_crc32 long")


def in_corpus(index: DataFrame) -> DataFrame:
    """The rows of ``read_index`` with ``start`` counted over all shards.

    One row per shard is summed up in order, a small table however large the shards are.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    offsets = totals.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    return index.join(offsets, "shard").withColumn("start", F.col("start") + F.col("before")).drop("before")


def manifest(index: DataFrame) -> DataFrame:
    """First and last key of each shard: what a lookup needs to choose one."""
    return index.groupBy("shard").agg(F.min("id").alias("first"), F.max("id").alias("last"))


def fetch(spark: SparkSession, path: str, wanted: DataFrame, shards: DataFrame, width: int = 2, id_col: str = "doc_id") -> DataFrame:
    """The ids of the documents with the keys ``wanted`` asks for: (id, ids), last id included.

    ``shards`` is a manifest. Keys meet the shards whose range holds them; a key that no shard
    has, or a NULL one, gives no row.
    """
    kind = wanted.schema[id_col].dataType.simpleString()
    keys = wanted.select(F.col(id_col).alias("id")).distinct().join(shards, F.col("id").between(F.col("first"), F.col("last")))
    asked = keys.groupBy("shard").agg(F.collect_list("id").alias("ids"))

    def run(batches):
        for batch in batches:
            for content, ids in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                shard = Shard(content.as_py(), width)
                found = [(key, shard.ids(i)) for key, places in zip(ids, shard.look_up(ids), strict=True) for i in places]
                lists = pa.array([x.astype(np.int64) for _, x in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([key for key, _ in found], batch.column(1).type.value_type), lists], [id_col, "ids"])

    return _shards(spark, path).join(asked, "shard").select("content", "ids").mapInArrow(run, f"{id_col} {kind}, ids array<long>")


def stored(spark: SparkSession, path: str, width: int = 2, id_type: str = "bigint") -> DataFrame:
    """``read_index`` with corpus-wide starts, the shards read once."""
    return in_corpus(written(read_index(spark, path, width, id_type), "token-index"))
