"""Terms of texts, and the items of a query set in blocks of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# A term is a run of ASCII letters and digits and of all characters beyond ASCII; A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERM = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_BETWEEN = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of a text that are cut into terms at a time.
PIECE_BYTES = 1 << 20


def terms_of(text: str) -> Column:
    """The terms of a text column in order; none of a NULL one."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))


def term_pieces(data: bytes, most: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, those of some ``most`` bytes at a time. ``bytes`` lower-cases A-Z only."""
    begin = 0
    while begin < len(data):
        end = begin + most
        if end < len(data):
            found = _BETWEEN.search(data, end)
            end = found.start() if found else len(data)
        yield _TERM.findall(data[begin:end].lower())
        begin = end


def in_blocks(items: DataFrame, words: str, most: int) -> Iterator[list[Row]]:
    """The rows of ``items`` in lists whose ``words`` columns hold ``most`` words together, or one row more.

    Rows come to the driver a partition at a time, and a block is given out before the next
    one is gathered, so the driver holds no more than that however many items there are.
    """
    block, held = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        held += len(row[words])
        if held >= most:
            yield block
            block, held = [], 0
    if block:
        yield block
