"""Decontamination, fill-in-middle and lexical search, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postledger.llm import decontamination, fill_middle, lexical_search
from postledger.llm.terms import term_pieces
from tests.llm.rows import documents, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, doc_id string, words string")


def odd_items():
    """Items that odd rows hold, short, long, empty and repeated ones, some without an id."""
    texts = [t for _, t, _ in odd_rows() if t and 12 < len(t) < 2000]
    rows = [("b", " ".join(texts[0].split()[3:20])), ("a", "alpha"), ("c", " ".join(texts[1].split()[:4])), ("d", None), ("e", " \n."), (None, texts[2])]
    rows += [("word", "word " * 12), ("a", " ".join(texts[3].split()[:11])), ("b", rows[0][1]), ("x", "nowhere said by anyone at all"), ("10", "It's"), ("9", "it s x")]
    rows += [("long", " ".join(texts[4].split() + [f"w{n}" for n in range(9000)] + texts[5].split()))]
    return [(*row, "clash", "clash") for row in rows]


def hits_by_hand(text, items, window=10):
    words = words_of(text)
    hit, seen = set(), set()
    for item, said, *_ in items:
        own = words_of(said)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                seen.add(item or "")
    return len(words), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), max_size=6), st.lists(st.sampled_from("abcd"), max_size=60), st.integers(1, 4))
def test_windows_are_found_as_by_hand(items, words, window):
    items = [(str(i), " ".join(own)) for i, own in enumerate(items)]
    text = " ".join(words)
    n, spans, seen = decontamination.Windows([(i, said.split()) for i, said in items], window).find(text.encode())
    expected = hits_by_hand(text, items, window)
    assert (n, sum(e - b for b, e in spans), len(seen)) == expected[:3] and seen == sorted(seen)
    assert all(b < e for b, e in spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_windows_over_pieces_of_a_long_text(monkeypatch):
    draw = random.Random(5)
    text = " ".join(draw.choice(["aa", "b", "Cc"]) for _ in range(3000))
    items = [(str(i), " ".join(draw.choice(["aa", "b", "cc"]) for _ in range(n))) for i, n in enumerate([1, 3, 7, 9, 10, 14, 40])]
    windows = decontamination.Windows([(i, said.split()) for i, said in items], 7)
    monkeypatch.setattr(decontamination, "term_pieces", lambda data: term_pieces(data, 50))
    n, spans, seen = windows.find(text.encode())
    assert (n, sum(e - b for b, e in spans), len(seen)) == hits_by_hand(text, items, 7)[:3]


def test_search_skips_what_cannot_match():
    probed = []

    class Counted(dict):
        def get(self, key, other=None):
            probed.append(key)
            return dict.get(self, key, other)

    search = decontamination.WuManber([tuple(f"w{i}" for i in range(10)).__class__(f"w{i}".encode() for i in range(10))], 10)
    search.shift = Counted(search.shift)
    words = [b"other"] * 900 + [f"w{i}".encode() for i in range(10)]
    assert list(search.occurrences(words)) == [(900, 0)]
    assert len(probed) < 900 / 9 + 15


@pytest.mark.parametrize("block_windows", [200_000, 5])
@pytest.mark.parametrize("clashing", [False, True])
def test_decontamination(spark, clashing, block_windows):
    rows, items = odd_rows(), odd_items()
    found = decontamination.find_benchmarks(documents(spark, rows, clashing), items_of(spark, items), block_windows=block_windows)
    digests = decontamination.digests(found)
    expected = Counter((i, *hits_by_hand(text, items)) for i, text, _ in rows)
    assert Counter(tuple(r) for r in digests.collect()) == expected
    assert any(r[-1] for r in expected) and not all(r[-1] for r in expected)
    assert decontamination.find_benchmarks(documents(spark, []), items_of(spark, items), block_windows=block_windows).collect() == []
    none = decontamination.digests(decontamination.find_benchmarks(documents(spark, rows), items_of(spark, [])))
    assert Counter((r.doc_id, r.n_words) for r in none.filter("NOT contaminated").collect()) == Counter((i, len(words_of(t))) for i, t, _ in rows)


def test_decontamination_shuffles_nothing(spark):
    found = decontamination.find_benchmarks(documents(spark, odd_rows()).coalesce(1), items_of(spark, odd_items()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == documents(spark, odd_rows()).coalesce(1)._jdf.queryExecution().executedPlan().toString().count("Exchange")


def middle_by_hand(id_, text, seed=1, plain=10, spm=20):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'null' if id_ is None else id_}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return id_, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return id_, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return id_, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def marked_rows():
    """Texts that hold marks, parts of them and what looks like them, beside the odd rows."""
    parts = ["<P>", "<S>", "<M>", "<", "<P", "<S", "<M", "P>", "S>", ">", "<<S", "a", "bc", " "]
    draw = random.Random(11)
    made = ["".join(draw.choice(parts[3:]) for _ in range(draw.randint(1, 40))) for _ in range(150)]
    return [*odd_rows(), *((1000 + i, t, "m") for i, t in enumerate([*made, *parts, "x<P>y", "<S>", "aé" * 700]))]


@pytest.mark.parametrize("chunk_units", [1, 7, 8192])
@pytest.mark.parametrize("clashing", [False, True])
def test_fill_in_middle(spark, clashing, chunk_units):
    rows = marked_rows() if chunk_units > 1 else [r for r in marked_rows() if len(r[1] or "") < 2000]
    expected = [middle_by_hand(i, t) for i, t, _ in rows]
    made = fill_middle.fill_in_middle(documents(spark, rows, clashing), chunk_units=chunk_units).collect()
    assert Counter(tuple(r) for r in made) == Counter(expected)
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    digests = fill_middle.digests(documents(spark, rows, clashing), chunk_units=chunk_units).collect()
    sha = [hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in rows]
    assert Counter(tuple(r) for r in digests) == Counter((*e[:5], hashlib.sha256(e[5].encode()).hexdigest(), s) for e, s in zip(expected, sha, strict=True))
    assert fill_middle.digests(documents(spark, [])).collect() == fill_middle.fill_in_middle(documents(spark, [])).collect() == []


def test_fill_in_middle_of_texts_longer_than_a_scan(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "_SCAN_CHARS", 64)
    draw = random.Random(2)
    for n in range(40):
        text = "".join(draw.choice(["ab", "c", "É", " ", "\n", "z" * 70]) for _ in range(draw.randint(0, 400)))
        count, form, first, second, starts = fill_middle.plan(text, n, 1, 10, 20)
        pieces, before, middle = fill_middle._pieces(text, count, form, first, second, starts, 9)
        assert (n, count, form, before, middle, "".join(pieces)) == middle_by_hand(n, text)


def test_fill_in_middle_takes_one_exchange(spark, tmp_path):
    documents(spark, odd_rows()).write.parquet(f"{tmp_path}/docs")
    plan = fill_middle.digests(spark.read.parquet(f"{tmp_path}/docs"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(row") == 1 == plan.count("Exchange")


def ranked_by_hand(rows, items, k):
    docs = [(i, Counter(words_of(t))) for i, t, _ in rows]
    held = [(i, c) for i, c in docs if c]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text, *_ in items:
        scores = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words_of(text)) if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block_terms", [50_000, 20])
@pytest.mark.parametrize("clashing", [False, True])
def test_lexical_search(spark, clashing, block_terms):
    rows, items = odd_rows(), odd_items()
    found = lexical_search.search(documents(spark, rows, clashing), items_of(spark, items), k=4, block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == ranked_by_hand(rows, items, 4)
    empty = documents(spark, [])
    assert lexical_search.search(empty, items_of(spark, items)).collect() == []
    assert lexical_search.search(documents(spark, rows), items_of(spark, [])).collect() == []
    assert lexical_search.search(documents(spark, [(1, None), (2, " . ")]), items_of(spark, items)).collect() == []


def test_trees_prune_and_stay_exact():
    draw = np.random.default_rng(3)
    weights = draw.integers(0, 9000, 300)
    items = [np.unique(draw.integers(0, 300, draw.integers(1, 20))) for _ in range(90)]
    search = lexical_search.Search(items, weights, 5)
    pairs, scored = [], 0
    for start in range(0, 3000, 500):
        doc, term = np.nonzero(draw.random((500, 300)) < np.where(np.arange(300) < 5, 0.9, 0.02))
        tf, m = draw.integers(1, 6, len(doc)), draw.integers(10, 300, 500)
        pairs.append((start + doc, term, lexical_search.added(tf, m[doc])))
        search.add([int(i) for i in range(start, start + 500)], doc, term, tf, m)
    table = np.zeros((3000, 300), np.int64)
    for doc, term, c in pairs:
        table[doc, term] = c
    expected = set()
    for i, own in enumerate(items):
        scores = table[:, own] @ weights[own]
        order = sorted((-int(s), d) for d, s in enumerate(scores.tolist()) if s > 0)[:5]
        expected |= {(i, d, -s) for s, d in order}
    assert set(search.results()) == expected


def test_trees_leave_pairs_out(monkeypatch):
    """Documents about other things than an item are never multiplied with it once its best are known."""
    items = [np.arange(10 * i, 10 * i + 10) for i in range(64)]
    search = lexical_search.Search(items, np.full(640, 5000), 2)
    asked = []
    monkeypatch.setattr(lexical_search, "children", lambda nodes, count, f=lexical_search.children: asked.append(len(f(nodes, count))) or f(nodes, count))
    for _ in range(3):
        asked.clear()
        doc = np.repeat(np.arange(640), 10)
        term = (doc // 10) * 10 + np.tile(np.arange(10), 640)
        search.add(list(range(640)), doc, term, np.ones(len(doc), np.int64), np.full(640, 100))
    # Of 64 items and 640 documents each document meets the items of its own node.
    assert sum(asked) < 64 * 640 / 4
