"""SimHash near-dedup with BK-trees.

Fingerprints that differ in at most ``max_bits`` bits agree in one of ``max_bits + 1`` blocks
of bits. So each distinct fingerprint goes to one shard per block, and a shard holds all that
share a block's value. There they form a BK-tree, whose children are keyed by their Hamming
distance to the parent; a search follows only the edges within the radius. A tree stays with
the fingerprints that are looked up in it: trees of the whole corpus grow with it and must not
be broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.llm.common import lowered_words, shingle_hashes, shuffle_partitions, written
from postledger.llm.components import components

# A shard with more fingerprints than this is linked by shared neighbours, not by a tree.
TREE_SIZE = 16384


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The SimHash of every row's whole text: (id, fingerprint), the latter as a signed long."""
    rows = docs.select(id_col, F.col(text_col).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [simhash(shingle_hashes(lowered_words(text.as_py()), shingle_words)) for text in batch.column(1)]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], [id_col, "fingerprint"])

    return rows.mapInArrow(run, f"{id_col} {kind}, fingerprint long")


class BkTree:
    """Distinct fingerprints; children are keyed by their Hamming distance to the parent."""

    def __init__(self, values: np.ndarray):
        """The same tree as inserting ``values`` one by one makes, built a subtree at a time."""
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        waiting = [(0, np.arange(1, len(values)))] if len(values) else []
        while waiting:
            node, below = waiting.pop()
            distance = np.bitwise_count(values[below] ^ values[node])
            for d in np.unique(distance).tolist():
                own = below[distance == d]
                self.children[node][d] = int(own[0])
                if len(own) > 1:
                    waiting.append((int(own[0]), own[1:]))

    def within(self, wanted: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``wanted`` and in the tree of all values that differ in ``radius`` bits or fewer."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [(0, np.arange(len(wanted)))] if len(self.values) else []
        while waiting:
            node, asking = waiting.pop()
            distance = np.bitwise_count(wanted[asking] ^ self.values[node]).astype(np.int64)
            near = asking[distance <= radius]
            found.append((near, np.full(len(near), node)))
            for edge, child in self.children[node].items():
                onward = asking[np.abs(distance - edge) <= radius]
                if len(onward):
                    waiting.append((child, onward))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def local_roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``size`` nodes the smallest one that it is linked with."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def _block(fingerprint: Column, i: int, blocks: int) -> Column:
    begin, end = 64 * i // blocks, 64 * (i + 1) // blocks
    return F.shiftrightunsigned(fingerprint, begin).bitwiseAND(F.lit((1 << (end - begin)) - 1 if end - begin < 63 else -1))


def links(distinct: DataFrame, max_bits: int, tree_size: int = TREE_SIZE) -> DataFrame:
    """Edges (a, b) that connect all fingerprints which differ in at most ``max_bits`` bits.

    Of each shard there are at most as many edges as fingerprints: enough to connect those
    that are linked. A shard above ``tree_size`` (for ``max_bits`` up to 2) is linked through
    keys that near fingerprints share: each fingerprint with any one bit masked for 1, or
    itself and all that differ in one bit for 2. These groups hold at most 65.
    """
    blocks = max_bits + 1
    placed = distinct.select(
        "fingerprint",
        F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col("fingerprint"), i, blocks).alias("value")) for i in range(blocks)])).alias("at"),
    ).select("fingerprint", "at.block", "at.value")
    # Written, so that the join with it shuffles both sides and a value that many share can be split.
    counted = written(placed.groupBy("block", "value").agg(F.count("*").alias("held")).filter("held > 1"), "shared-blocks")
    large = counted.filter(F.col("held") > tree_size) if 0 < max_bits <= 2 else None
    shards = 4 * shuffle_partitions(distinct.sparkSession)
    shared = placed.join(counted, ["block", "value"])
    if large is not None:
        shared = shared.filter(F.col("held") <= tree_size)
    dealt = shared.select("fingerprint", "block", "value", F.pmod(F.xxhash64("block", "value"), F.lit(shards)).alias("shard"))

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "value", "fingerprint"], ignore_index=True)
        values = rows["fingerprint"].to_numpy()
        begins = np.flatnonzero((rows[["block", "value"]].diff() != 0).any(axis=1).to_numpy())
        out = []
        for begin, end in zip(begins, np.r_[begins[1:], len(rows)], strict=True):
            own = np.ascontiguousarray(values[begin:end])
            a, b = BkTree(own.view(np.uint64)).within(own.view(np.uint64), max_bits)
            root = local_roots(len(own), a, b)
            moved = root != np.arange(len(own))
            out.append(pd.DataFrame({"a": own[root[moved]], "b": own[moved]}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    # Little data but much work: a number of partitions that adaptive execution leaves alone.
    spread = dealt.repartition(shuffle_partitions(distinct.sparkSession), "shard")
    found = spread.groupBy("shard").applyInPandas(connect, "a long, b long")
    if large is None or large.isEmpty():
        return found
    crowded = placed.join(large.select("block", "value"), ["block", "value"], "left_semi").select("fingerprint").distinct()
    bits = "transform(sequence(0, 63), i -> shiftleft(1L, i))"
    if max_bits == 1:
        keys = f"transform({bits}, m -> named_struct('mask', m, 'rest', fingerprint & ~m))"
    else:
        keys = f"transform(concat(array(0L), {bits}), m -> named_struct('mask', 0L, 'rest', fingerprint ^ m))"
    groups = crowded.select("fingerprint", F.explode(F.expr(keys)).alias("key")).groupBy("key").agg(F.collect_set("fingerprint").alias("near"))
    pairs = groups.filter(F.size("near") > 1).select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a <> b")
    return found.union(pairs.distinct())


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text", tree_size: int = TREE_SIZE
) -> DataFrame:
    """The group of every row: (id, fingerprint as 16 hex digits, component_id).

    Fingerprints are linked when they differ in at most ``max_bits`` bits; ``component_id`` is
    the smallest id that links reach, the row's own included.

    NULL and empty texts, and those of blanks, have fingerprint zero and are linked like any
    other. A NULL id is no candidate for the smallest, so a group of such rows alone has a NULL
    component. Rows that repeat an id or a text are kept, each as a row. Other columns are not
    read. No rows give no rows.
    """
    rows = written(fingerprints(docs.select(F.col(id_col).alias("id"), text_col), shingle_words, "id", text_col), "fingerprints")
    distinct = written(rows.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct, max_bits, tree_size)).select(F.col("node").alias("fingerprint"), "root")
    members = written(
        distinct.join(roots, "fingerprint", "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "members"
    )
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(members.join(least, "root").select("fingerprint", "component_id"), "groups")
    return rows.join(groups, "fingerprint").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
