"""Fill-in-middle transformation by secondary sort.

A text is cut into units, and two places among them part it into prefix, middle and suffix.
Each task emits pieces of some units, keyed by the row and the place in the output. One exchange
by row, sorted within its partitions by place, brings the pieces of an output side by side in
order; they are streamed into what is made of them and never gathered. To restore a text, its
output is read as such a stream, the marks in it say what each piece is, and the pieces are
sorted once more, by their place in the text, without another exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postledger.llm.common import shuffle_partitions, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Marks in the order of each form, and where in the text what follows a mark belongs.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
CHUNK_UNITS = 8192
_SCAN_CHARS = 1 << 20
_HEAD = "n long, form string, prefix_chars long, middle_chars long"


def _unit_starts(text: str) -> Iterator[np.ndarray]:
    """Places where units begin, a stretch of the text at a time: a run of ASCII letters is one, any other character too."""
    in_run = False
    for begin in range(0, len(text), _SCAN_CHARS):
        codes = np.frombuffer(text[begin : begin + _SCAN_CHARS].encode("utf-32-le", "surrogatepass"), "<u4") | 0x20
        letters = (codes >= 97) & (codes <= 122)
        goes_on = np.empty(len(letters), bool)
        goes_on[0] = in_run and letters[0]
        np.logical_and(letters[1:], letters[:-1], out=goes_on[1:])
        in_run = bool(letters[-1])
        yield np.flatnonzero(~goes_on) + begin


def _places(text: str, starts: list[np.ndarray] | None, wanted: np.ndarray) -> np.ndarray:
    """Where in ``text`` the units ``wanted`` begin, in order; its end for the one behind the last."""
    out, before = np.full(len(wanted), len(text), np.int64), 0
    for part in starts or _unit_starts(text):
        low, high = np.searchsorted(wanted, [before, before + len(part)])
        out[low:high] = part[wanted[low:high] - before]
        before += len(part)
    return out


def plan(text: str, id_, seed: int, plain_percent: int, spm_percent: int) -> tuple[int, str, int, int, list[np.ndarray] | None]:
    """Units of a text, its form, and the units before the middle and before the suffix."""
    starts = list(_unit_starts(text)) if len(text) <= _SCAN_CHARS else None
    n = sum(map(len, starts or _unit_starts(text)))
    digest = hashlib.sha256(f"{seed}:{'null' if id_ is None else id_}".encode()).hexdigest()
    draws = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    first, second = sorted(x % (n + 1) for x in draws[:2])
    if not text or any(mark in text for mark in PLACE) or draws[2] % 100 >= 100 - plain_percent:
        return n, "plain", first, second, starts
    return n, "spm" if draws[3] % 100 < spm_percent else "psm", first, second, starts


def _pieces(text: str, n: int, form: str, first: int, second: int, starts, chunk: int) -> tuple[list[str], int | None, int | None]:
    """The output in pieces of ``chunk`` units at most, and the code points of prefix and middle."""
    edges = {PREFIX: (0, first), MIDDLE: (first, second), SUFFIX: (second, n)}
    if form == "plain":
        edges, marks = {"": (0, n)}, ("",)
    else:
        marks = ORDER[form]
    cuts = {mark: np.r_[np.arange(*edges[mark], chunk), edges[mark][1]] for mark in marks}
    wanted = np.unique(np.concatenate(list(cuts.values())))
    at = dict(zip(wanted.tolist(), _places(text, starts, wanted).tolist(), strict=True))
    out: list[str] = []
    for mark in marks:
        if mark:
            out.append(mark)
        units = cuts[mark].tolist()
        out += [text[at[a] : at[b]] for a, b in zip(units, units[1:], strict=False)]
    if form == "plain":
        return out, None, None
    return out, at[first], at[second] - at[first]


class Marks:
    """Takes an output apart again as it streams by. A text that holds a mark is plain, so the first of each kind counts."""

    def __init__(self, form: str):
        self.waiting = list(ORDER.get(form, ()))
        self.place, self.held = 0, ""

    def feed(self, piece: str) -> Iterator[tuple[int, str]]:
        """(place, text) of what is complete: 0 in the prefix or a plain text, 1 in the middle, 2 in the suffix."""
        self.held += piece
        while self.waiting and (found := self.held.find(self.waiting[0])) >= 0:
            if found:
                yield self.place, self.held[:found]
            self.place, self.held = PLACE[self.waiting[0]], self.held[found + len(self.waiting.pop(0)) :]
        # A mark may begin in what is held last.
        sure = len(self.held) - (len(PREFIX) - 1 if self.waiting else 0)
        if sure > 0:
            yield self.place, self.held[:sure]
            self.held = self.held[sure:]


def output_pieces(
    docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, chunk_units: int = CHUNK_UNITS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The outputs of all rows in pieces: (row, at, piece, id, n, form, prefix_chars, middle_chars).

    Pieces of a row lie in one partition, sorted by ``at``; the columns from the id on are set
    in its first piece only. See ``fill_in_middle`` for what they mean.

    Rows are known by a number that depends on the partitions of ``docs``, so these must be
    the same when a task runs again, as those of a written table are.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column(1)
            numbers = batch.column(0).to_pylist()
            columns: list[list] = [[] for _ in range(8)]
            size = 0
            for i, number in enumerate(numbers):
                text = batch.column(2)[i].as_py()
                n, form, first, second, starts = plan(text, ids[i].as_py(), seed, plain_percent, spm_percent)
                pieces, before, middle = _pieces(text, n, form, first, second, starts, chunk_units)
                pieces = pieces or [""]
                rest = [None] * (len(pieces) - 1)
                own = [number] * len(pieces), range(len(pieces)), pieces, [i, *rest], [n, *rest], [form, *rest], [before, *rest], [middle, *rest]
                for column, values in zip(columns, own, strict=True):
                    column.extend(values)
                size += len(text)
                if size >= 1 << 22 or i + 1 == len(numbers):
                    arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()], strict=True)]
                    arrays[3] = ids.take(arrays[3])
                    yield pa.RecordBatch.from_arrays(arrays, ["row", "at", "piece", "id", "n", "form", "prefix_chars", "middle_chars"])
                    columns, size = [[] for _ in range(8)], 0

    pieces = rows.mapInArrow(run, f"row long, at long, piece string, id {kind}, {_HEAD}")
    return pieces.repartition(shuffle_partitions(docs.sparkSession), "row").sortWithinPartitions("row", "at")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Each row's whole text made over for filling in its middle: (id, n, form, prefix_chars, middle_chars, output).

    A text has ``n`` units, runs of ASCII letters and any other character each. Two of its
    places, drawn from ``seed`` and the id, part it into prefix, middle and suffix, either of
    which may be empty. ``form`` is psm, the prefix first, for most; spm, the suffix first, for
    ``spm_percent`` of the others; and plain, the text as it is, for ``plain_percent`` of the
    rows, for empty texts and for those that hold a mark. A plain row has NULL counts.

    A NULL text is empty. A NULL id draws as the text "null"; rows that share an id draw alike.
    Rows, repeated ones too, are kept as they are; other columns are not read. No rows give no
    rows. A very long text is cut and digested in pieces; here its output is one value again.
    """
    pieces = output_pieces(docs, id_col=id_col, **options)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        head, held, row = None, [], None
        for batch in batches:
            done: list[tuple[pa.RecordBatch, str]] = []
            for i, (number, piece) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if number != row:
                    if head is not None:
                        done.append((head, "".join(held)))
                    head, held, row = batch.slice(i, 1), [], number
                held.append(piece)
            if done:
                yield joined(done)
        if head is not None:
            yield joined([(head, "".join(held))])

    def joined(done):
        heads = pa.Table.from_batches([h for h, _ in done]).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [*(heads.column(i) for i in range(3, 8)), pa.array([text for _, text in done], pa.string())], [id_col, "n", "form", "prefix_chars", "middle_chars", "output"]
        )

    return pieces.mapInArrow(run, f"`{id_col}` {kind}, {_HEAD}, output string")


def digests(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Outputs and texts restored from them, as digests: (id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256).

    An output is never whole in a task: it streams by in order, into its digest and through
    ``Marks``; what these give is sorted by row and place in the text, within the partition, and
    streams into the digest of the restored text.
    """
    pieces = output_pieces(docs, id_col=id_col, **options)
    kind = docs.schema[id_col].dataType.simpleString()
    head_names = ["n", "form", "prefix_chars", "middle_chars"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def assemble(batches):
        """Pieces by place in the text, and behind those of a row its head with the digest of its output, at place -1."""
        row, head, marks, digest, count = None, None, None, None, 0
        for batch in batches:
            out: list[tuple] = []
            heads: list[tuple] = []
            forms = batch.column(5)
            for i, (number, piece) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if number != row:
                    if head is not None:
                        heads.append((row, head, digest.hexdigest()))
                    row, head, digest, count = number, batch.slice(i, 1), hashlib.sha256(), 0
                    marks = Marks(forms[i].as_py())
                digest.update(piece.encode("utf-8", "surrogatepass"))
                for place, part in marks.feed(piece):
                    out.append((number, place, count, part))
                    count += 1
            yield rows_of(out, heads, batch.schema)
        if head is not None:
            yield rows_of([], [(row, head, digest.hexdigest())], head.schema)

    def rows_of(out, heads, schema):
        blank = len(out)
        names = [*out, *((number, -1, 0, digest) for number, _, digest in heads)]
        columns = [pa.array([x[i] for x in names], t) for i, t in enumerate(types)]
        # Ids and what else the head says, NULL for pieces.
        held = [pa.concat_arrays([pa.nulls(blank, schema.field(i).type), *(h.column(i) for _, h, _ in heads)]) for i in range(3, 8)]
        return pa.RecordBatch.from_arrays([*columns, *held], ["row", "place", "count", "part", "id", *head_names])

    def restore(batches):
        row, head, digest = None, None, None
        for batch in batches:
            done: list[tuple] = []
            for i, (number, place, part) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if place < 0:
                    if head is not None:
                        done.append((head, digest.hexdigest()))
                    row, head, digest = number, batch.slice(i, 1), hashlib.sha256()
                else:
                    digest.update(part.encode("utf-8", "surrogatepass"))
            if done:
                yield results(done)
        if head is not None:
            yield results([(head, digest.hexdigest())])

    def results(done):
        heads = pa.Table.from_batches([h for h, _ in done]).combine_chunks().to_batches()[0]
        columns = [*(heads.column(i) for i in range(4, 9)), heads.column(3), pa.array([d for _, d in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, [id_col, *head_names, "output_sha256", "restored_sha256"])

    taken = pieces.mapInArrow(assemble, f"row long, place long, count long, part string, id {kind}, {_HEAD}")
    return taken.sortWithinPartitions("row", "place", "count").mapInArrow(restore, f"`{id_col}` {kind}, {_HEAD}, output_sha256 string, restored_sha256 string")
