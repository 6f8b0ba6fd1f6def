"""Operators made of DataFrame functions, and the URL filter, against plain Python."""

import hashlib
import re
from collections import defaultdict

import pytest

from postledger.llm import chat_format, exact_dedup, mixing, url_filter
from postledger.llm.queries import RULES
from tests.llm.rows import documents, odd_rows


def plain(text):
    return re.sub(r"[ \t-\r]+", " ", text or "")


def index_at(spark, path):
    return exact_dedup.DigestIndex(spark, str(path), buckets=4)


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_dedup(spark, tmp_path, clashing):
    rows = odd_rows()
    found = exact_dedup.exact_dedup(documents(spark, rows, clashing), index_at(spark, tmp_path / "index")).collect()
    groups = defaultdict(list)
    for row in rows:
        groups[plain(row[1])].append(row[0])
    assert len(found) == len(rows)
    by_digest = defaultdict(list)
    for row in found:
        by_digest[row.text_sha256].append(row)
    assert len(by_digest) == len(groups)
    for text, ids in groups.items():
        own = by_digest[hashlib.sha256(text.encode()).hexdigest()]
        keep = min((i for i in ids if i is not None), default=None)
        assert sorted(str(r.doc_id) for r in own) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in own} == {(keep, len(ids))}
        assert [r.doc_id for r in own if r.kept] == [keep]


def test_exact_dedup_against_what_the_index_holds(spark, tmp_path):
    index = index_at(spark, tmp_path / "index")
    first = exact_dedup.exact_dedup(documents(spark, [(5, "a b"), (6, "c")]), index)
    assert {(r.doc_id, r.kept) for r in first.collect()} == {(5, True), (6, True)}
    # The index is found again at its path; a smaller id that comes later does not replace an older row.
    again = index_at(spark, tmp_path / "index")
    later = exact_dedup.exact_dedup(documents(spark, [(1, "a  b"), (2, "d"), (3, "d")]), again).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in later} == {(1, 5, 1, False), (2, 2, 2, True), (3, 2, 2, False)}
    assert again.entries().count() == 3
    again.close()


def test_exact_dedup_shuffles_no_index(spark, tmp_path):
    index = index_at(spark, tmp_path / "index")
    exact_dedup.exact_dedup(documents(spark, [(1, "a")]), index)
    digests = index.entries().select("digest").groupBy("digest").count()
    plan = digests._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_empty_tables(spark, tmp_path):
    docs = documents(spark, [])
    assert exact_dedup.exact_dedup(docs, index_at(spark, tmp_path / "index")).collect() == []
    assert mixing.mix(docs).collect() == []
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_conversations(turns)
    assert formatted.collect() == [] and chat_format.expand_targets(formatted).collect() == []
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []


def water(sizes, share, weights, most):
    """Targets by dealing out what is over again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        level = (left - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


@pytest.mark.parametrize("clashing", [False, True])
def test_mixing(spark, clashing):
    rows = odd_rows()
    docs = documents(spark, rows, clashing)
    found = mixing.mix(docs).collect()
    sizes, words, largest = defaultdict(int), {}, defaultdict(int)
    for _, text, source in rows:
        n = len(re.findall(r"[^ \t-\r]+", text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    targets = water(sizes, 1.5, (5, 2, 1), 2)
    assert len(found) == len(rows)
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mix(docs.repartition(5)).collect()))
    by_size = {size: source for source, size in sizes.items()}
    taken = defaultdict(int)
    for row in found:
        source = by_size[row.source_size]
        assert row.target == pytest.approx(targets[source])
        assert 0 <= row.taken <= 2 * row.size and row.taken == row.copies * row.size
        assert row.copies >= row.target // row.source_size
        taken[source] += row.taken
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    del words


def test_mixing_prefers_quality(spark):
    rows = [(i, ("fine words here " if i % 2 else "x y z a b c d e f ") * 40, "a") for i in range(400)]
    rows += [(1000 + i, "other words stand here " * 300, "b") for i in range(40)]
    found = mixing.mix(documents(spark, rows), share=0.3).collect()
    share = {odd: sum(r.copies for r in found if r.doc_id < 1000 and r.doc_id % 2 == odd) for odd in (0, 1)}
    assert share[1] > 1.5 * share[0] > 0


TURNS = [
    (1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "<||im_start|>a<|b"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "x\n<|n|>y"),
    (2, 0, "user", "no answer"), (3, None, "assistant", "first"), (3, 1, None, "b"), (3, 1, "us\ner", "a"), (3, 1, "us\ner", "a"),
    (None, 0, "assistant", "lost"), (None, 0, "assistant", "lost"), (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (4, 0, "assistant", "漢😀 " * 20_000),
]


def test_chat_format_reads_back(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("targets", url_filter.F.lit("x"))
    formatted = chat_format.format_conversations(turns.repartition(3))
    expected = defaultdict(list)
    for conv, turn, role, text in sorted(TURNS, key=lambda t: (-9 if t[1] is None else t[1], t[2] or "", t[3] or "")):
        expected[conv].append((role or "", text or ""))
    found = {r.conv_id: r for r in formatted.withColumn("turns", chat_format.parse_turns(formatted["text"])).collect()}
    assert {c: [tuple(t) for t in r.turns] for c, r in found.items()} == expected
    assert all(r.text.count("<|im_start|>") == r.text.count("<|im_end|>") == len(r.turns) for r in found.values())
    examples = chat_format.expand_targets(formatted)
    replies = defaultdict(list)
    for row in sorted(examples.withColumn("reply", chat_format.masked_text(examples)).collect(), key=lambda r: r.example):
        replies[row.conv_id].append(row.reply)
        whole = found[row.conv_id].text
        # All turns before as context, and nothing behind the reply.
        assert whole.startswith(row.text) and row.text.endswith("<|im_end|>\n")
        assert row.loss_start + row.loss_chars + len("<|im_end|>\n") == len(row.text)
    assert replies == {c: out for c, t in expected.items() if (out := [text for role, text in t if role == "assistant"])}


def test_url_filter(spark):
    urls = [
        None, "", "no-scheme.net/en/", "http://A.Example.NET/en/x?q=1", "http://example.net", "http://badexample.net/en/", "http://xnet/",
        "http://casino.example.org/a", "http://casinoroyale.example.org/a", "http://free-cash.example.org/a", "http://free-free.example.org/",
        "http://a.org/fr/casino", "https://example.com/de/1#x", "x://b.example.com/de", "http://é.org/FR/Porn", "a\nb://H\n.net/x", "http://a.net/",
    ]
    pages = spark.createDataFrame([*enumerate(urls), (0, None)], "page_id long, url string").withColumn("host", url_filter.F.lit("clash"))
    found = sorted(url_filter.judge_urls(pages, RULES).collect())
    assert len(found) == len(urls) + 1
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"),
        3: ("a.example.net", "/en/x", "example.net/en/", "allow"), 4: ("example.net", "", None, "allow"),
        5: ("badexample.net", "/en/", "net/", "block"), 6: ("xnet", "/", None, "allow"),
        7: ("casino.example.org", "/a", None, "block"), 8: ("casinoroyale.example.org", "/a", None, "allow"),
        9: ("free-cash.example.org", "/a", None, "block"), 10: ("free-free.example.org", "/", None, "allow"),
        11: ("a.org", "/fr/casino", "org/fr/", "allow"), 12: ("example.com", "/de/1", "example.com/de/", "block"),
        13: ("b.example.com", "/de", None, "allow"), 14: ("é.org", "/FR/Porn", None, "block"),
        15: ("h\n.net", "/x", "net/", "block"), 16: ("a.net", "/", "net/", "block"),
    }


def test_url_vocabulary_knows_usual_forms(spark):
    vocabulary = url_filter.VOCABULARY
    assert len(vocabulary) >= 300 and all(re.fullmatch("[a-z0-9]+", term) for term in vocabulary)
    assert not set(url_filter.STRICT_TERMS) & set(url_filter.SOFT_TERMS)
    bad = ["free-bets", "cheap-pills", "ads-track", "adult-x", "spam-farm", "sexy-girls", "betting-bonus", "quick-loans", "pokies", "escort", "slot-wins"]
    good = ["cheap-flights", "track", "bets", "river-loans", "essex", "adsorption", "scunthorpe", "hot-springs", "news"]
    pages = spark.createDataFrame([(name, f"http://{name}.example.com/en/1") for name in bad + good], "page_id string, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}
    assert got == {**dict.fromkeys(bad, "block"), **dict.fromkeys(good, "allow")}


# Named by hand: what a reader of the URL would call junk, and pages that merely speak of such things.
JUNK_URLS = """
freecasino.com/ www.casinos-online.net/x best.com/%63asino a.io/%43%41%53%49%4E%4F bet-bonus.com/ cheap-viagra.org/buy hotgirls.tv/
sexcams.com/live b.com/free-xxx-movies pornhub.com/view c.net/poker/bonus/free-spins pills-discount.biz/ payday-loan.co/ spins.win.com/
quickcash.loans/ d.com/warez/keygen luckyslots.co/free/slots/bonus/win e.org/hentai/3 xvideos.com/a adult-dating.info/ teen-webcams.net/
forex-profits.biz/ f.com/buy-cheap-cialis replica-rolex.shop/ sportsbook.ag/ g.com/online-casino-bonus nudewebcam.com/ click-track.ads.net/
""".split()
ORDINARY_URLS = """
a.org/health/diazepam b.com/credit/loans c.org/drug/prescription d.com/sport/winning-stakes e.com/gift/discount f.org/crypto/mortgage
g.edu/adult-teens/books h.com/girl/kiss news.com/economy/interest-rates i.org/deal/deals j.net/ad/ads
wikipedia.org/wiki/Essex scunthorpe.gov.uk/ l.org/birds/great-tits m.com/analysis/adsorption n.org/currency/pegging o.edu/library/downloads
bank.com/mortgages p.com/shop/gift-vouchers q.org/cancer/drugs r.com/recipes/hot-cross-buns s.net/games/dice t.com/track/42 u.org/casinoroyale
pharmacy.edu/courses v.com/music/singles w.com/tv/girls lottery.gov/results x.com/i y.org/ritalin z.com/law/gambling cocktails.com/list
""".split()


def test_url_filter_on_named_urls(spark):
    pages = spark.createDataFrame([(u, f"https://{u}") for u in JUNK_URLS + ORDINARY_URLS], "page_id string, url string")
    blocked = {r.page_id for r in url_filter.judge_urls(pages).collect() if r.verdict == "block"}
    assert set(JUNK_URLS) <= blocked
    assert not blocked & set(ORDINARY_URLS)


def test_stems_are_terms_and_inflections_are_one_hit(spark):
    found = url_filter.stems(url_filter.VOCABULARY)
    assert set(found.values()) <= set(url_filter.VOCABULARY) and all(found[s] == s for s in found.values())
    same = {"bets": "bet", "betting": "bet", "bettors": "bet", "lotteries": "lottery", "sexiest": "sex", "advertising": "advertise", "ads": "ad", "hottest": "hot"}
    assert {term: found[term] for term in same} == same
    url = f"http://a.org/{'deal/deals/' * 50_000}"
    row = url_filter.judge_urls(spark.createDataFrame([(1, url)], "page_id int, url string")).first()
    assert (row.strict_hits, row.soft_hits, row.soft_in_host, row.verdict) == (0, 1, 0, "allow")


class Broken(RuntimeError):
    pass


def test_a_batch_that_runs_again_keeps_what_it_kept(spark, tmp_path):
    rows = odd_rows()
    expected = None
    for name in ("one", "two"):
        index = index_at(spark, tmp_path / name)
        exact_dedup.exact_dedup(documents(spark, [(900, "a"), (901, "seen before")]), index, batch="first")
        if name == "two":
            # The digests are entered, and then the job fails.
            exact_dedup.exact_dedup(documents(spark, rows), index, batch="second")
            index = index_at(spark, tmp_path / name)
        found = exact_dedup.exact_dedup(documents(spark, rows), index, batch="second").collect()
        verdicts = sorted(map(str, found))
        expected = expected or verdicts
        assert verdicts == expected and sum(r.kept for r in found) > 10
        digests = [bytes(r.digest) for r in index.entries().collect()]
        assert len(digests) == len(set(digests))
    # Without its name the same rows are another batch, and all seen.
    assert not any(r.kept for r in exact_dedup.exact_dedup(documents(spark, rows), index).collect())


def test_a_batch_that_fails_before_it_is_logged_leaves_nothing(spark, tmp_path, monkeypatch):
    index = index_at(spark, tmp_path / "index")
    with monkeypatch.context() as broken:
        broken.setattr(exact_dedup, "create_file", lambda *a: (_ for _ in ()).throw(Broken()))
        with pytest.raises(Broken):
            exact_dedup.exact_dedup(documents(spark, [(1, "a")]), index, batch="b")
    assert index.entries().collect() == []
    assert [r.kept for r in exact_dedup.exact_dedup(documents(spark, [(1, "a")]), index, batch="b").collect()] == [True]


def test_two_batches_at_a_time(spark, tmp_path, monkeypatch):
    index, entered = index_at(spark, tmp_path / "index"), []
    real = exact_dedup.create_file

    def late(*args):
        if not entered:
            entered.append(True)
            exact_dedup.exact_dedup(documents(spark, [(1, "a"), (2, "b")]), index_at(spark, tmp_path / "index"), batch="other")
        return real(*args)

    monkeypatch.setattr(exact_dedup, "create_file", late)
    found = exact_dedup.exact_dedup(documents(spark, [(3, "b"), (4, "c")]), index, batch="mine").collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in found} == {(3, 2, False), (4, 4, True)} and index.entries().count() == 3


def test_the_index_keeps_its_buckets(spark, tmp_path):
    path = str(tmp_path / "index")
    exact_dedup.exact_dedup(documents(spark, odd_rows()), exact_dedup.DigestIndex(spark, path, buckets=8))
    with pytest.raises(ValueError, match="8 buckets, not 3"):
        exact_dedup.DigestIndex(spark, path, buckets=3)
    with pytest.raises(ValueError, match="ids of type bigint, not string"):
        exact_dedup.DigestIndex(spark, path, id_type="string")
    assert exact_dedup.DigestIndex(spark, path).buckets == 8


def test_later_batches_neither_shuffle_nor_sort_the_index(spark, tmp_path):
    index = index_at(spark, tmp_path / "index")
    for n in range(4):
        exact_dedup.exact_dedup(documents(spark, [(n, f"text {n}"), (10 + n, "shared")]), index, batch=str(n))
    levels = index.levels()
    assert len(levels) == 4
    groups = documents(spark, [(1, "a")]).select(exact_dedup.text_digest("text").alias("digest"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with index._trusted_order():
            plan = index.known(groups, levels)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    # One shuffle to the buckets and one sort, of the new digests; none above a scan of the index.
    assert plan.count("SortMergeJoin") == 4 and plan.count("Exchange hashpartitioning(digest") == 1
    assert plan.count("Sort [digest") == 1
    before = sorted(map(str, index.entries().collect()))
    index.compact()
    assert len(index.levels()) == 2 and sorted(map(str, index.entries().collect())) == before
    with pytest.raises(ValueError, match="batch 0 is compacted"):
        exact_dedup.exact_dedup(documents(spark, [(1, "a")]), index, batch="0")
    assert [r.kept for r in exact_dedup.exact_dedup(documents(spark, [(7, "text  1"), (8, "new")]), index).orderBy("doc_id").collect()] == [False, True]


def test_every_row_has_a_draw_of_its_own(spark):
    # A third of the rows have ids; others have none, repeat one, or are equal in id and text.
    words = ["alpha beta", "gamma delta epsilon", "zeta"]
    rows = [(i if i % 3 == 0 else None if i % 3 == 1 else 7, f"{words[i % 2]} w{i % 500 if i % 3 else i}", "a") for i in range(12_000)]
    found = mixing.mix(documents(spark, rows), share=1.5).collect()
    assert len(found) == len(rows) and sum(r.taken for r in found) == pytest.approx(found[0].target, rel=0.001)
    kinds = {True: [], False: [], None: []}
    for r in found:
        kinds[None if r.doc_id is None else r.doc_id == 7].append(r.copies - 1)
    rates = {k: sum(v) / len(v) for k, v in kinds.items()}
    expected = sum(map(sum, kinds.values())) / len(found)
    for kind, taken in kinds.items():
        error = (expected * (1 - expected) / len(taken)) ** 0.5
        assert abs(rates[kind] - expected) < 3 * error + 0.005, rates
    # Rows of each size come about as often, whether ids are NULL or not.
    again = mixing.mix(documents(spark, rows[::-1]).repartition(5), share=1.5).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_weights_may_be_a_column(spark):
    rows = documents(spark, [(i, "one two three", "a") for i in range(6000)]).selectExpr("*", "CASE WHEN doc_id % 2 = 0 THEN 1.0 ELSE 0.1 END AS w")
    found = mixing.mix(rows, share=0.5, weight_col="w").collect()
    heavy, light = (sum(r.copies for r in found if r.doc_id % 2 == n) / 3000 for n in (0, 1))
    assert heavy > 0.8 and light < 0.2 and sum(r.taken for r in found) == pytest.approx(9000, abs=3)
    nothing = mixing.mix(rows.selectExpr("doc_id", "text", "source", "CAST(NULL AS double) AS w"), weight_col="w").collect()
    assert {r.copies for r in nothing} == {1, 2}


def test_groups_of_a_source_are_even_whatever_it_weighs(spark, tmp_path, monkeypatch):
    held = []
    real = mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, name: held.append((name, real(df, name))) or held[-1][1])
    docs = spark.range(200_000).selectExpr("id AS doc_id", "repeat('漢', CAST(20 + id % 50 AS int)) AS text", "'a' AS source")
    mixing.mix(docs)
    (ordered,) = [df for name, df in held if name == "mix-ordered"]
    sizes = [r["count"] for r in ordered.groupBy("source", "place").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
