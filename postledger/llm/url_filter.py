"""URL filter: a weighted vocabulary found by Aho-Corasick, below explicit rules."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from urllib.parse import unquote

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postledger.llm.url_terms import SOFT_TERMS, STRICT_TERMS

# A term that rejects by itself weighs STRICT, one that needs company weighs SOFT.
STRICT, SOFT = 2, 1

VOCABULARY: dict[str, int] = {**dict.fromkeys(STRICT_TERMS, STRICT), **dict.fromkeys(SOFT_TERMS, SOFT)}

# Letters that a term has at least to be found side by side with another in one word.
GLUED = 3
# What inflections add to a term, a doubled consonant before it or not.
_ENDINGS = ("s", "es", "d", "ed", "r", "rs", "er", "ers", "or", "ors", "ing", "ings", "est", "y")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    """From behind the host to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule that fits, NULL if none does.

    A rule is a host, ``/`` and the start of a path. It fits its host and all subdomains.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):  # the longest is asked first
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def stems(vocabulary: Iterable[str]) -> dict[str, str]:
    """The stem of each term: the shortest term of the vocabulary that it is an inflection of, or itself."""
    terms = set(vocabulary)

    def shorter(term: str) -> str | None:
        for cut in range(2, len(term)):
            stem, end = term[:cut], term[cut:]
            doubled = end[:1] == stem[-1] and end[1:] in _ENDINGS
            if stem in terms and (end in _ENDINGS or doubled):
                return stem
            changed = [stem + "y"] if end in ("ies", "ied", "ier", "iest") else [stem + "e"] if end in ("ing", "ings") else []
            if found := terms.intersection(changed):
                return found.pop()
        return None

    def root(term: str) -> str:
        while (stem := shorter(term)) and stem != term and len(stem) < len(term):
            term = stem
        return term

    return {term: root(term) for term in terms}


def _hits(vocabulary: Mapping[str, int]):
    """A function from URLs and their hosts to how many distinct stems of terms they hold.

    A term counts where neither neighbour is an ASCII letter or digit, and where it and another
    term make up the whole of what lies between such places, each of ``GLUED`` letters or more.
    """
    stem_of = stems(vocabulary)

    def search(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for term, weight in vocabulary.items():
            automaton.add_word(term, (len(term), stem_of[term], weight))
        automaton.make_automaton()
        joined = set(_LOWER + "0123456789")
        fold = str.maketrans(_UPPER, _LOWER)

        def found(url: str | None) -> set[tuple[str, int]]:
            text = (unquote(url) if "%" in (url or "") else url or "").translate(fold)
            seen: set[tuple[str, int]] = set()
            heads: dict[int, list] = {}  # terms that begin a word, by where they end
            tails: list[tuple[int, tuple[str, int]]] = []  # terms that end one, and where they begin
            for end, (length, stem, weight) in automaton.iter(text) if vocabulary else ():
                start = end + 1 - length
                begins = start == 0 or text[start - 1] not in joined
                ends = end + 1 == len(text) or text[end + 1] not in joined
                if begins and ends:
                    seen.add((stem, weight))
                elif begins and length >= GLUED:
                    heads.setdefault(end + 1, []).append((stem, weight))
                elif ends and length >= GLUED:
                    tails.append((start, (stem, weight)))
            for start, tail in tails:
                if start in heads:
                    seen.update([tail, *heads[start]])
            return seen

        for urls, hosts in batches:
            counts = []
            for url, host in zip(urls, hosts, strict=True):
                whole = found(url)
                strict = sum(weight >= STRICT for _, weight in whole)
                in_host = sum(weight < STRICT for _, weight in found(host)) if len(whole) > strict else 0
                counts.append((strict, len(whole) - strict, in_host))
            yield pd.DataFrame(counts, columns=["strict_hits", "soft_hits", "soft_in_host"], dtype="int64")

    return F.pandas_udf(search, "strict_hits long, soft_hits long, soft_in_host long")


def judge_urls(
    pages: DataFrame,
    rules: Mapping[str, str] | None = None,
    vocabulary: Mapping[str, int] = VOCABULARY,
    soft_limit: int = 3,
    soft_limit_host: int = 2,
    keys: Sequence[str] = ("page_id",),
    url_col: str = "url",
) -> DataFrame:
    """Host, path, rule and verdict of every page: (*keys, host, path, rule, verdict, strict_hits, soft_hits, soft_in_host).

    The verdict is that of the longest rule that fits (``rules`` gives "allow" or "block" by
    rule). Else it is "block" on one strict term, on ``soft_limit`` distinct soft ones in the whole
    URL, or on ``soft_limit_host`` in the host: a path is named after what a page is about, a host
    after what it sells. Terms are lower-cased ASCII, looked up once percent-escapes are decoded;
    inflections of one term are one hit, and two terms written as one word are found.

    A NULL URL, or one without ``://``, has an empty host and path, and a NULL one no hits. A URL of
    any length is searched whole, in time linear in it. Repeated rows are judged alike. Columns
    other than ``keys`` and the URL are not read. No rows give no rows.
    """
    rules = rules or {}
    judged = pages.select(
        *(F.col(k) for k in keys),
        host_of(url_col).alias("host"),
        path_of(url_col).alias("path"),
        _hits(vocabulary)(F.col(url_col), host_of(url_col)).alias("_hits"),
    ).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    soft = (F.col("_hits.soft_hits") >= soft_limit) | (F.col("_hits.soft_in_host") >= soft_limit_host)
    rejected = (F.col("_hits.strict_hits") > 0) | soft
    return judged.select(
        *keys, "host", "path", "rule",
        F.coalesce(by_rule, F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "_hits.strict_hits", "_hits.soft_hits", "_hits.soft_in_host",
    )
