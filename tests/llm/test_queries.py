"""The registered queries and the pipeline on given tables."""

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from postledger.llm import mixing, multiset_hash, quality, queries
from postledger.llm.common import table
from tests.llm.rows import documents, odd_rows
from tests.llm.test_texts import TOKENIZER, covered, fingerprint_by_bits, linked

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS FROM '{SF_DIR}/{file}'")
    return connection


@pytest.fixture(scope="module")
def texts(database):
    return dict(database.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_equals_its_sql(spark, database, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted(tuple(repr(row[c]) for c in columns) for row in df.collect())
    result = database.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(tuple(repr(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert found == expected and found


def test_simhash_query(spark, texts):
    found = {r.doc_id: r for r in queries.op1_simhash(spark, SF_DIR).collect()}
    prints = {i: fingerprint_by_bits(t) for i, t in texts.items()}
    root = linked(sorted(set(prints.values())), 2)
    least = {}
    for i in sorted(texts, reverse=True):
        least[root[prints[i]]] = i
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {i: (f"{p:016x}", least[root[p]]) for i, p in prints.items()}


def test_quality_query(spark, database):
    labels = dict(database.execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in queries.op3_quality(spark, SF_DIR).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held) > 0


def test_token_queries(spark, texts):
    library = Tokenizer.from_file(TOKENIZER)
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    stored, start = {}, 0
    for i in sorted(ids):
        tokens = np.array([*ids[i], 0], "<u4")
        stored[i] = start, len(tokens), zlib.crc32(tokens.tobytes())
        start += len(tokens)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op5_token_store(spark, SF_DIR).collect()} == stored
    digests = {
        i: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest())
        for i, x in ids.items()
    }
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op9_bpe(spark, SF_DIR).collect()} == digests


def test_suffix_query(spark, texts):
    data = [t.encode() for t in texts.values()]
    expected = {}
    for i, raw, gone in zip(texts, data, covered(data, 400), strict=True):
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        expected[i] = len(raw), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op7_suffix_dedup(spark, SF_DIR).collect()} == expected


def test_pipeline(spark, database, tmp_path):
    docs, labels = table(spark, SF_DIR, "documents"), dict(database.execute("SELECT doc_id, quality FROM labels").fetchall())
    good = corpus_pipeline.good_quality(spark, docs, SF_DIR)
    kept = {r.doc_id for r in good.collect()}
    assert sum((i in kept) == (q == 1) for i, q in labels.items()) >= 0.95 * len(labels)
    once = corpus_pipeline.without_copies(spark, good, SF_DIR)
    normal = {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        normal.setdefault(" ".join((r.text or "").split()), r.doc_id)
    assert once.count() <= len(normal) + 5 and once.columns == docs.columns
    apart = corpus_pipeline.without_near_copies(spark, once, SF_DIR)
    prints = {r.doc_id: fingerprint_by_bits(r.text) for r in once.collect()}
    root = linked(sorted(set(prints.values())), 2)
    assert {r.doc_id for r in apart.collect()} == {min(i for i, p in prints.items() if root[p] == x) for x in set(root.values())}
    mix = corpus_pipeline.mixed(spark, apart, SF_DIR)
    assert mix.columns == docs.columns and max(Counter(r.doc_id for r in mix.collect()).values()) <= 2
    final = corpus_pipeline.run(spark, SF_DIR)
    assert Counter(r.doc_id for r in final.collect()) == Counter(r.doc_id for r in mix.collect())


def test_rows_of_an_id_follow_their_own_decisions(spark, database):
    words = "harbour lantern meadow copper thistle window gravel orchard saddle pebble ribbon candle".split()
    texts = [" ".join(f"{w}{n}" for w in words for n in range(k, k + 5)) for k in (10, 200, 3000)]
    # Clean rows without an id, or that repeat one; and two copies, one of them the only row of its id.
    rows = [(None, texts[0], "a"), (None, texts[1], "a"), (5, texts[2], "b"), (5, texts[0] + " more of it here", "b"), (5, texts[1], "b"), (4, texts[2], "b")]
    once = corpus_pipeline.without_copies(spark, documents(spark, rows), SF_DIR).collect()
    assert Counter((r.doc_id, r.text) for r in once) == Counter([(None, texts[0]), (5, rows[3][1]), (5, texts[1]), (4, texts[2])])
    apart = corpus_pipeline.without_near_copies(spark, documents(spark, rows), SF_DIR).collect()
    prints = [fingerprint_by_bits(t) for _, t, _ in rows]
    root = linked(sorted(set(prints)), 2)
    kept = {}
    for (i, t, _), p in sorted(zip(rows, prints, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        kept.setdefault(root[p], (i, t))
    assert Counter((r.doc_id, r.text) for r in apart) == Counter(kept.values()) and len(kept) >= 3

    many = [(None if n % 2 else 7, "word " * (n + 20), "b" if n % 5 else "c") for n in range(60)]
    docs = documents(spark, many)
    copies = {r.size: r.copies for r in mixing.mix(docs).collect()}
    mix = Counter(len(r.text.split()) for r in corpus_pipeline.mixed(spark, docs, SF_DIR).collect())
    assert mix == Counter({size: n for size, n in copies.items() if n}) and len(set(copies.values())) > 1

    good = database.execute("SELECT text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND length(text) > 400 LIMIT 20").fetchall()
    bad = database.execute("SELECT text FROM documents JOIN labels USING (doc_id) WHERE quality = 0 LIMIT 20").fetchall()
    given = table(spark, SF_DIR, "documents")
    extra = spark.createDataFrame([(None, t) for (t,) in good + bad], "doc_id long, text string")
    kept = corpus_pipeline.good_quality(spark, given.unionByName(extra, allowMissingColumns=True), SF_DIR).filter("doc_id IS NULL").collect()
    rejected = {t for (t,) in bad} - {r.text for r in kept}
    assert len(rejected) >= 0.8 * len({t for (t,) in bad}) > 0 and len(kept) >= 0.8 * len(good)


def test_multiset_query(spark, texts):
    order = sorted(texts, reverse=True)
    found = {r.doc_id: r for r in queries.op2_multiset_hash(spark, SF_DIR).collect()}
    assert sorted(found, reverse=True) == order
    for i, following in zip(order, order[1:] + order[:1], strict=True):
        text, after, row = texts[i], texts[following], found[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        prints = [multiset_hash.fingerprint(t) for t in (text, edited, after)]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (prints[0].hex(), prints[1].hex())
        assert (row.near_edited, row.near_next) == (prints[0].likeness(prints[1]), prints[0].likeness(prints[2]))


def rows_expected(spark, docs, stage):
    """How many rows a stage gives of the odd rows, worked out apart from it."""
    rows = odd_rows()
    if stage is corpus_pipeline.good_quality:
        model = quality.fit(docs, table(spark, SF_DIR, "labels"))
        return quality.score(docs, model).filter("predicted = 1").count()
    if stage is corpus_pipeline.without_copies:
        return len({re.sub(r"[ \t-\r]+", " ", t or "") for _, t, _ in rows})
    if stage is corpus_pipeline.without_near_copies:
        return len(set(linked(sorted({fingerprint_by_bits(t) for _, t, _ in rows}), 2).values()))
    if stage is corpus_pipeline.mixed:
        weight = quality.with_score(docs, quality.fit(docs, table(spark, SF_DIR, "labels")), "_w")
        return sum(r.copies for r in mixing.mix(weight, weight_col="_w").collect())
    return len(rows)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_stand_odd_rows(spark, name, stage):
    docs = documents(spark, odd_rows(), clashing=True)
    found = stage(spark, docs, SF_DIR)
    assert found.count() == rows_expected(spark, docs, stage)
    if stage is not corpus_pipeline.tokens:
        assert found.columns == docs.columns
    assert stage(spark, documents(spark, []), SF_DIR).collect() == []
