"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the pairs that changed by
binary search over sorted pair keys, merges in each word every occurrence of its
lowest-ranked pair, and closes the gaps. Words without a mergeable pair leave the array.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postledger.llm.common import UnitStore, gathered, in_slices, process_cache, text_or_empty

_NEVER = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where it prints, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(others)) for b in range(256)]


def word_cutter(content: bytes):
    """Cuts a text into words as the tokenizers library does: (word in byte letters, place) each."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(content).pre_tokenizer.pre_tokenize_str


def cut_words(found: list[str], cut, marks: re.Pattern | None, added: dict[str, int]) -> tuple[list[list[int]], list[str]]:
    """For each unit its distinct words by place, added tokens as -1 - id; and the words, in byte letters.

    ``cut`` is a ``word_cutter``. ``marks`` splits a text at the added tokens, which are cut out
    before words are.
    """
    place: dict[str, int] = {}
    parts: list[list[int]] = []
    for unit in found:
        if marks and marks.search(unit):
            own = []
            for i, piece in enumerate(marks.split(unit)):
                own += [-1 - added[piece]] if i % 2 else [place.setdefault(w, len(place)) for w, _ in cut(piece)]
        else:
            own = [place.setdefault(w, len(place)) for w, _ in cut(unit)]
        parts.append(own)
    return parts, list(place)


def joined_words(parts: list[list[int]], ids: list[bytes], added) -> list[bytes]:
    """The ids of units, from those of their words and ``added`` for added tokens."""
    return [ids[own[0]] if len(own) == 1 and own[0] >= 0 else b"".join([ids[p] if p >= 0 else added(-1 - p) for p in own]) for own in parts]


def mark_pattern(added: dict[str, int]) -> re.Pattern | None:
    """Finds added tokens, the longest first."""
    return re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None


class ByteBpe:
    """A byte-level BPE vocabulary with its merges, read from a tokenizer file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
        added = spec.get("added_tokens", [])
        if not plain or any(odd) or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError("only byte-level BPE without normalizer, prefix or suffix is supported")
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")) or any(" " in t["content"] for t in added):
            raise ValueError("only added tokens that are matched as they are, and hold no blank, are supported")
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in added}
        self.size = max([*vocab.values(), *self.added.values()]) + 1
        letters = byte_letters()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        # Where every token is made before it is used, merging one pair never makes a pair of
        # lower rank, and all its occurrences may go at once.
        made = np.full(self.size, -1, np.int64)
        made[merged] = np.arange(len(merges))
        self.at_once = bool(len(set(merged.tolist())) == len(merges) and (np.maximum(made[left], made[right]) < np.arange(len(merges))).all())
        to_byte = {c: b for b, c in enumerate(letters)}
        pieces = [b""] * self.size
        for token, i in vocab.items():
            pieces[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for token, i in self.added.items():
            pieces[i] = token.encode()
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.lengths = np.fromiter(map(len, pieces), np.int64, self.size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letter_bytes = {ord(c): b for c, b in to_byte.items()}
        self.cut = word_cutter(content)
        self.marks = mark_pattern(self.added)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; rank ``_NEVER`` where there is no merge."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.ranks[at], _NEVER), self.merged[at]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes of 32-bit numbers."""
        out = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        ranks, merged = np.full(len(symbols), _NEVER, np.int64), np.zeros(len(symbols), np.int64)
        stale = np.arange(len(symbols))
        while len(symbols):
            # Rank of the pair that begins at each symbol; the last of a word begins none.
            pairs = stale[(stale < len(symbols) - 1)]
            pairs = pairs[word[pairs] == word[pairs + 1]]
            ranks[stale] = _NEVER
            ranks[pairs], merged[pairs] = self._look_up(symbols[pairs], symbols[pairs + 1])
            begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[begins, len(symbols)])
            least = np.minimum.reduceat(ranks, begins)
            done = least == _NEVER
            data = symbols.astype("<i4").tobytes()
            for w, b, n in zip(word[begins[done]].tolist(), (4 * begins[done]).tolist(), (4 * counts[done]).tolist(), strict=True):
                out[w] = data[b : b + n]
            keep = np.repeat(~done, counts)
            symbols, word, ranks, merged = symbols[keep], word[keep], ranks[keep], merged[keep]
            if not len(symbols):
                break
            hit = ranks == np.repeat(least[~done], counts[~done])
            at = np.flatnonzero(hit)
            if self.at_once:
                # Of hits that overlap, as in a run of one symbol, every other one from the left.
                run = np.flatnonzero(np.r_[True, np.diff(at) > 1])
                at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            else:
                at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            symbols[at] = merged[at]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            symbols, word, ranks, merged = symbols[~gone], word[~gone], ranks[~gone], merged[~gone]
            stale = np.flatnonzero(changed[~gone])
        return out

    def encode_units(self, found: list[str]) -> list[bytes]:
        """The ids of each unit of a text (see ``units``), as bytes of 32-bit numbers."""
        parts, words = cut_words(found, self.cut, self.marks, self.added)
        return joined_words(parts, self.merge([w.translate(self.letter_bytes).encode("latin-1") for w in words]), lambda i: i.to_bytes(4, "little"))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, ids of no token nothing."""
        ids = ids[(ids >= 0) & (ids < self.size)]
        return self.bytes[gathered(self.starts[ids], self.lengths[ids])].tobytes().decode("utf-8", "replace")


def _bpe_of(content) -> tuple[ByteBpe, UnitStore]:
    cache = process_cache("bpe")
    name = hashlib.sha256(content.value).digest()
    if name not in cache:
        bpe = ByteBpe(content.value)
        cache[name] = bpe, UnitStore(bpe.encode_units)
    return cache[name]


def _content(docs: DataFrame, tokenizer: str):
    """The tokenizer file for all tasks: its size is fixed and small."""
    with open(tokenizer, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token ids of every row's whole text: (id, ids).

    ``tokenizer`` is the path of a byte-level BPE file on the driver. Added tokens are matched
    in the text first; truncation, padding and post-processing of the file are not used. A
    NULL text is empty and has no ids. Rows, repeated ones too, are kept as they are, NULL ids
    included; other columns are not read. No rows give no rows.
    """
    content = _content(docs, tokenizer)
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    schema = f"{id_col} {rows.schema[id_col].dataType.simpleString()}, ids array<int>"

    def run(batches):
        _, store = _bpe_of(content)
        for batch in batches:
            at = 0
            for texts in in_slices(batch.column(1)):
                found = store.ids(texts)
                ends = np.cumsum([0, *map(len, found)]) // 4
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), lists], [id_col, "ids"])
                at += len(texts)

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """The text of every row's ids, added tokens included: (id, ids, text). NULL ids are an empty text."""
    content = _content(tokens, tokenizer)
    kind = tokens.schema[id_col].dataType.simpleString()
    rows = tokens.select(id_col, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        bpe, _ = _bpe_of(content)
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            begins = np.r_[0, ends[:-1]]
            texts = [bpe.decode(flat[b:e]) for b, e in zip(begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], [id_col, "ids", "text"])

    return rows.mapInArrow(run, f"{id_col} {kind}, ids array<int>, text string")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's whole text encoded, and its ids decoded, as digests: (id, n_tokens, ids_sha256, decoded_sha256).

    The first digest is that of the decimal ids joined by commas. Does what ``encode`` and
    ``decode`` do, in one worker and without sending ids and texts back.
    """
    content = _content(docs, tokenizer)
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches):
        bpe, store = _bpe_of(content)
        for batch in batches:
            counts, names, decoded = [], [], []
            for texts in in_slices(batch.column(1)):
                for data in store.ids(texts):
                    ids = np.frombuffer(data, "<i4").astype(np.int64)
                    counts.append(len(ids))
                    names.append(digest(",".join(map(str, ids.tolist()))))
                    decoded.append(digest(bpe.decode(ids)))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
