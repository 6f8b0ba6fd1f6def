"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A string of ``length`` bytes that occurs twice is found in sorted order of suffixes, next to its
other occurrence. Not every suffix is sorted: each string has one anchor, the place of the
smallest hash among its ``GRAM``-byte grams, and equal strings have their anchor at the same
place. So it is enough to sort the suffixes that begin at anchors, with what stands before each.

1. Anchors of all documents are found by rolling hashes; those whose gram is nowhere else go.
2. Each task sorts the anchored suffixes of its documents to runs, one for each partition of
   anchors, merges equal ones, and front-codes them: a suffix is written as the length of the
   prefix it shares with the one before, and the rest.
3. Each partition merges its runs with a loser tree that keeps, for each run, how long a prefix
   its suffix shares with the last one given out. Two suffixes are compared from there on only,
   and not at all where these lengths differ.
   A gram that very many documents share would put them all into one partition. Its strings are
   counted by 128-bit digests instead, which partial aggregates spread over all tasks.
4. Suffixes that share a prefix of ``r`` bytes, and ``l`` bytes before their anchors, repeat each
   other over ``l + r`` bytes, which are removed where that is ``length`` at least.
"""

from __future__ import annotations

import hashlib
import pickle
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postledger.llm.common import process_cache, shuffle_partitions, written

LENGTH, GRAM = 400, 160
# A gram that more documents than this have is not merged in one partition.
CROWD = 50_000
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE_BITS = 24


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix of two strings that share ``start`` bytes."""
    most = min(len(a), len(b))
    step = 32
    while start < most:
        end = min(start + step, most)
        x, y = a[start:end], b[start:end]
        if x != y:
            differ = int.from_bytes(x, "little") ^ int.from_bytes(y, "little")
            return start + ((differ & -differ).bit_length() - 1) // 8
        start, step = end, step * 4
    return most


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    cache = process_cache("powers")
    if len(cache.get("up", ())) < count:
        size = max(count, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            cache[name] = np.multiply.accumulate(steps)
    return cache["up"][:count], cache["down"][:count]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` bytes."""
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        x = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    to_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_right[:count], from_left[width - 1 : width - 1 + count])


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of one document: gram hash, place, first and last start of the strings they stand for.

    Strings that start side by side and share an anchor are one entry, so an anchor has one or,
    where a long document is read in steps, two of them.
    """
    found: list[tuple[np.ndarray, ...]] = []
    step = (1 << _PLACE_BITS) - length
    for begin in range(0, len(data) - length + 1, step):
        # All strings that begin in this step; a document longer than that takes several.
        part = np.frombuffer(data, np.uint8)[begin : begin + step + length - 1]
        hashes = gram_hashes(part, gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        # The place is part of the value, so the leftmost of equal hashes is the least.
        keys = (hashes & ~np.uint64((1 << _PLACE_BITS) - 1)) | places
        at = (window_least(keys, length - gram + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        runs = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        ends = np.r_[runs[1:], len(at)] - 1
        found.append((hashes[at[runs]].view(np.int64), at[runs] + begin, runs + begin, ends + begin))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def front_coded(suffixes: Iterable[tuple]) -> list[tuple]:
    """Sorted (suffix, *rest) as (shared, rest of the suffix, *rest): without the prefix shared with the one before."""
    out, last = [], b""
    for suffix, *rest in suffixes:
        shared = common_prefix(last, suffix)
        out.append((shared, suffix[shared:], *rest))
        last = suffix
    return out


class LoserTree:
    """Merges front-coded sorted runs; gives (shared, suffix, *rest), shared with the one given before."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(run) for run in runs]
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        # Of each run the next entry, and how long a prefix it shares with the last one given out.
        self.entry: list[tuple | None] = [None] * self.size
        self.suffix: list[bytes] = [b""] * self.size
        self.shared = [0] * self.size
        for i in range(len(runs)):
            self._advance(i)
        self.losers = [0] * self.size
        self.winner = self._start(1)

    def _advance(self, i: int) -> None:
        entry = next(self.runs[i], None)
        if entry:
            self.suffix[i] = self.suffix[i][: entry[0]] + entry[1]
            self.shared[i] = entry[0]
        self.entry[i] = entry

    def _play(self, i: int, j: int) -> tuple[int, int]:
        """Winner and loser. Both know what they share with the last one given out."""
        if self.entry[j] is None:
            return i, j
        if self.entry[i] is None:
            return j, i
        if self.shared[i] != self.shared[j]:
            return (i, j) if self.shared[i] > self.shared[j] else (j, i)
        same = common_prefix(self.suffix[i], self.suffix[j], self.shared[i])
        if self.suffix[j][same : same + 1] < self.suffix[i][same : same + 1]:
            i, j = j, i
        self.shared[j] = same
        return i, j

    def _start(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, loser = self._play(self._start(2 * node), self._start(2 * node + 1))
        self.losers[node] = loser
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while (entry := self.entry[self.winner]) is not None:
            winner = self.winner
            yield self.shared[winner], self.suffix[winner], *entry[2:]
            self._advance(winner)
            node = (winner + self.size) // 2
            while node:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node //= 2
            self.winner = winner


def repeats(group: Iterable[tuple], length: int) -> Iterator[tuple]:
    """Byte ranges (document, begin, end) of sorted suffixes (shared, suffix, before, document, anchor, twin).

    ``twin`` says that an equal one was seen, and its ranges given, already.

    Suffixes that share ``r`` bytes or more are neighbours. Going down from the longest shared
    prefixes, neighbouring sets are joined, the smaller into the larger, each in order of what
    stands before the anchors: whoever shares most of that with a member stands next to it.
    """
    items: list[list] = []  # shared with the item before, suffix, reversed bytes before, occurrences, twin
    same: dict[bytes, int] = {}
    for shared, suffix, before, doc, at, twin in group:
        if not (items and shared == len(suffix) == len(items[-1][1])):
            same = {}
        if before in same:
            item = items[same[before]]
            item[3].append((doc, at, twin))
            item[4] = True
        else:
            same[before] = len(items)
            items.append([shared, suffix, before[::-1], [(doc, at, twin)], twin])
    for _, suffix, before, found, _ in items:
        if len(found) > 1:
            for doc, at, twin in found:
                if not twin:
                    yield doc, at - len(before), at + len(suffix)
    if len(items) < 2:
        return
    order = sorted(range(len(items)), key=lambda i: items[i][2])
    rank = [0] * len(items)
    for place, i in enumerate(order):
        rank[i] = place
    parent = list(range(len(items)))
    sets = {i: [rank[i]] for i in range(len(items))}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in sorted(range(1, len(items)), key=lambda i: -items[i][0]):
        r = items[i][0]
        small, large = sorted((root(i - 1), root(i)), key=lambda x: len(sets[x]))
        held = sets[large]
        for own in sets[small]:
            place = bisect_left(held, own)
            for other in held[max(0, place - 1) : place + 1]:
                a, b = items[order[own]], items[order[other]]
                shared = common_prefix(a[2], b[2])
                if shared + r >= length:
                    for _, _, _, found, known in (a, b):
                        if not known:
                            yield found[0][0], found[0][1] - shared, found[0][1] + r
        for own in sets.pop(small):
            insort(held, own)
        parent[small] = large


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, check, data): whole texts as bytes, partitioned by 128 bits that name the row.

    They are hashed from id and text, so rows have one name only if they are equal, and then
    come to one task.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"))
    named = rows.select("id", F.xxhash64("id", "data").alias("key"), F.xxhash64("data", "id").alias("check"), "data")
    return named.repartition(shuffle_partitions(docs.sparkSession), "key", "check")


def repeated_ranges(texts: DataFrame, length: int, gram: int, crowd: int = CROWD) -> DataFrame:
    """Byte ranges to remove, (key, check, begin, end), of the texts that ``_keyed`` gives."""
    parts = 2 * shuffle_partitions(texts.sparkSession)
    # Strings of an anchor begin at most ``length - 1`` bytes before it.
    bits = (length - 1).bit_length()
    low = (1 << bits) - 1

    def find(batches):
        """Anchors: a place is the anchor's, what its strings span, and whether the document has the gram further on."""
        for batch in batches:
            for key, check, data in zip(*(batch.column(i).to_pylist() for i in (1, 2)), batch.column(3), strict=True):
                grams, at, first, last = anchors(data.as_py(), length, gram)
                if len(at):
                    again = np.ones(len(at), np.int64)
                    again[np.unique(grams, return_index=True)[1]] = 0
                    places = (at << 2 * bits | at - first << bits | at - last) << 1 | again
                    names = [pa.array(np.full(len(at), x, np.int64)) for x in (key, check)]
                    yield pa.RecordBatch.from_arrays([pa.array(grams), *names, pa.array(places)], ["gram", "key", "check", "place"])

    found = written(texts.mapInArrow(find, "gram long, key long, check long, place long"), "anchors")
    documents = F.sum(1 - F.col("place").bitwiseAND(F.lit(1)))
    # Written, so that the join with it shuffles both sides and a gram that many share can be split.
    shared = written(
        found.groupBy("gram").agg(F.count("*").alias("held"), documents.alias("documents")).filter("held > 1").select("gram", "documents"), "shared-grams"
    )

    def with_anchors(grams: DataFrame) -> DataFrame:
        """The texts with those of their anchors that have one of the grams.

        All columns of the texts are read, so that their exchange is the one that the caller
        reads too. Anchors are a set, since equal rows have one name.
        """
        own = found.join(grams.select("gram"), "gram").groupBy("key", "check").agg(F.collect_set(F.struct("gram", "place")).alias("anchors"))
        return texts.join(own, ["key", "check"]).select("id", "key", "check", "data", "anchors")

    def distinct_suffixes(batches):
        """The task's suffixes by gram, (from the anchor on, before it) to (name, anchor), and ranges of those that have a twin here."""
        held: dict[int, dict[tuple[bytes, bytes], list]] = {}
        done: dict[int, list[tuple]] = {}
        row = 0
        for batch in batches:
            names = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for name, data, found_here in zip(names, batch.column(3), batch.column(4).to_pylist(), strict=True):
                row += 1
                data = data.as_py()
                for anchor in found_here:
                    own, place = anchor["gram"], anchor["place"] >> 1
                    at = place >> 2 * bits
                    first, last = at - (place >> bits & low), at - (place & low)
                    suffix, before = data[at : last + length], data[first:at]
                    known = held.setdefault(own, {}).setdefault((suffix, before), [name, at, False, row])
                    if known[3] != row or known[1] != at:
                        done.setdefault(own, []).append((*name, first, last + length))
                        if not known[2]:
                            known[2] = True
                            done[own].append((*known[0], known[1] - len(before), known[1] + len(suffix)))
        return held, done

    def make_runs(batches):
        """A front-coded run for each partition of anchors; equal suffixes of the task come as one."""
        held, done = distinct_suffixes(batches)
        by_part: dict[int, tuple[list, list]] = {}
        for own, suffixes in held.items():
            entries, ranges = by_part.setdefault(own % parts, ([], []))
            entries += [(*place, *rest[:3]) for place, rest in suffixes.items()]
            ranges += done.get(own, [])
        pack = zstandard.ZstdCompressor(level=1)
        for part, (entries, ranges) in by_part.items():
            entries.sort(key=lambda x: x[:2])
            data = pack.compress(pickle.dumps((front_coded(entries), ranges), protocol=5))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([data], pa.binary())], ["part", "run"])

    def merge_runs(rows: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        runs, out = [], []
        for data in rows["run"]:
            run, done = pickle.loads(unpack.decompress(data))
            runs.append(run)
            out += done
        group: list[tuple] = []

        def close() -> None:
            if len(group) > 1:
                out.extend((*name, begin, end) for name, begin, end in repeats(group, length))
            group.clear()

        for entry in LoserTree(runs):
            # Whoever shares less than a gram shares no string.
            if entry[0] < gram:
                close()
            group.append(entry)
        close()
        return pd.DataFrame(out, columns=["key", "check", "begin", "end"], dtype="int64")

    runs = with_anchors(shared.filter(F.col("documents") <= crowd)).mapInArrow(make_runs, "part int, run binary")
    ranges = runs.groupBy("part").applyInPandas(merge_runs, "key long, check long, begin long, end long")
    crowded = shared.filter(F.col("documents") > crowd)
    if crowded.isEmpty():
        return ranges

    def make_strings(batches):
        """Ranges of suffixes with a twin in the task, and a digest of each string of the distinct ones."""
        names = ["digest", "key", "check", "begin", "end"]
        held, done = distinct_suffixes(batches)
        for own, suffixes in held.items():
            rows = [(None, *known) for known in done.get(own, [])]
            for (suffix, before), (name, at, _, _) in suffixes.items():
                whole, start = before + suffix, at - len(before)
                for s in range(len(whole) - length + 1):
                    digest = hashlib.blake2b(whole[s : s + length], digest_size=16).digest()
                    rows.append((digest, *name, start + s, start + s + length))
            columns = zip(*rows, strict=True)
            kinds = [pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    strings = with_anchors(crowded).mapInArrow(make_strings, "digest binary, key long, check long, begin long, end long")
    strings = written(strings, "crowded-strings")
    again = written(strings.groupBy("digest").agg(F.count("*").alias("held")).filter("held > 1").select("digest"), "crowded-digests")
    known = strings.filter("digest IS NULL").unionByName(strings.join(again, "digest"))
    return ranges.union(known.select("key", "check", "begin", "end"))


def cut(data: bytes, ranges: Iterable[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``data``, how many bytes went, and in how many runs."""
    kept, at, gone, spans = [], 0, 0, 0
    end_before = -1
    for begin, end in sorted(ranges):
        if begin > end_before:
            spans += 1
            kept.append(data[at:begin])
            gone += end - begin
        elif end > end_before:
            gone += end - end_before
        end_before = at = max(end_before, end)
    return b"".join([*kept, data[at:]]), gone, spans


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Whole texts without their repeated bytes: (id, data, kept, n_removed, n_spans), texts as UTF-8 bytes.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in the
    same text or another one; strings are judged on the input.

    A NULL text is empty. Rows may repeat an id or be equal: each is a text of its own, and
    equal ones of ``length`` bytes or more lose everything. NULL ids are kept. Other columns
    are not read. No rows give no rows.
    """
    texts = _keyed(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    found = repeated_ranges(texts, length, gram, crowd)
    ranges = found.groupBy("key", "check").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))

    def run(batches):
        for batch in batches:
            out = [cut(data.as_py(), ((r["begin"], r["end"]) for r in own or ())) for data, own in zip(batch.column(1), batch.column(2).to_pylist(), strict=True)]
            kept, gone, spans = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(kept, pa.binary()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64())],
                [id_col, "data", "kept", "n_removed", "n_spans"],
            )

    joined = texts.join(ranges, ["key", "check"], "left").select("id", "data", "ranges")
    return joined.mapInArrow(run, f"{id_col} {kind}, data binary, kept binary, n_removed long, n_spans long")


def digests(removed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256)."""
    size = F.octet_length("data").cast("long").alias("n_bytes")
    return removed.select(id_col, size, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

