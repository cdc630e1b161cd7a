"""Repeats of a fixed length over all documents, shared by the two substring operators.

A window is ``size`` consecutive tokens (words or bytes). Every window picks an anchor inside it by
its content alone, so equal windows pick the same anchor; neighbouring windows mostly share theirs.
What goes over the network is one row per run of windows with one anchor, not one per window:

1. Rows meet by anchor name. In a class (same name, same whole run) all but the earliest repeat it.
2. Where an anchor has several classes, the earliest of each is compared window by window, on the
   text itself. Anchors so frequent that one task could not take them are dealt out by class, then
   by window.
3. Each document gets its repeated windows back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import add_columns, as_bytes, bound_batches, mixed, small

_BASE = 0xD1B54A32D192ED03
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def grow(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    return grow(_BASE), grow(_INVERSE)


class Digests:
    """64-bit names of any stretch of a token sequence, from sums over its start."""

    def __init__(self, tokens: np.ndarray):
        room = 1 << max(10, int(len(tokens)).bit_length())
        self.down = _powers(room)[1]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens * _powers(room)[0][: len(tokens)])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def least_in_ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low:high]`` for many non-empty ranges, by blocks of powers of two."""
    out = np.empty(len(low), values.dtype)
    length = high - low
    level, block = values, 1
    longest = int(length.max()) if len(length) else 0
    while block <= longest:
        here = np.flatnonzero((length >= block) & (length < 2 * block))
        out[here] = np.minimum(level[low[here]], level[high[here] - block])
        level = np.minimum(level[: len(level) - block], level[block:]) if len(level) > block else level
        block *= 2
    return out


@dataclass(frozen=True)
class Runs:
    """Runs of windows of a batch: row, first window, number of windows, anchor name and run name."""

    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    key: np.ndarray
    span: np.ndarray


def runs_of_picks(pick: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, n) of runs of windows with one pick, by token; ``starts`` are the rows' first tokens, then the end."""
    first_of, end_of = starts[:-1], starts[1:] - size + 1
    full = end_of > first_of
    rows = np.repeat(np.flatnonzero(full), (end_of - first_of)[full])
    if not len(rows):
        return rows, rows, rows
    windows = np.arange(len(rows)) - np.repeat(np.cumsum((end_of - first_of)[full]) - (end_of - first_of)[full],
                                               (end_of - first_of)[full]) + first_of[rows]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (pick[windows[1:]] != pick[windows[:-1]])))
    at = np.flatnonzero(new)
    return rows[at], windows[at], np.diff(np.append(at, len(rows)))


@dataclass(frozen=True)
class Scheme:
    """How an operator reads texts.

    ``runs`` finds the runs of a text column; ``cut`` takes a text and runs and gives the pieces of
    text they cover; ``windows`` gives the windows of such a piece. With ``same_text``, a window also
    repeats an earlier one of its own document.
    """

    size: int
    same_text: bool
    runs: Callable[[pa.Array], Runs]
    cut: Callable[[bytes, list[tuple[int, int]]], list[bytes]]
    windows: Callable[[bytes, int], list[bytes]]
    batch_bytes: int = 2 << 20


#: Share of the documents in which frequent anchors are looked for. It decides where rows are sent, not what is found.
LOOK = 32
KEPT, REPEATED, OPEN, FREQUENT = -1, 0, 1, 2
_COMPRESS = 3


def _frequent(docs: DataFrame, scheme: Scheme) -> np.ndarray:
    """Anchors with more rows than a quarter of a usual task has; at most four times the number of tasks."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, scheme.batch_bytes):
            key = scheme.runs(batch.column("text")).key.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])

    some = docs.filter(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(LOOK)) == 0)
    counts = settle(some.select("text").mapInArrow(names, "key bigint").groupBy("key").count().filter("count > 1"))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(8, total / (4 * tasks))
    found = counts.filter(F.col("count") >= least).select("key").toArrow()
    return np.sort(found.column("key").to_numpy())


def _is_in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, keys)
    return known[np.minimum(at, len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool)


def _later(doc: np.ndarray, start: np.ndarray, first: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Whether a row comes after the one at ``first``."""
    after = doc > doc[first]
    return after | ((doc == doc[first]) & (start > start[first])) if scheme.same_text else after


def _classes(key: np.ndarray, span: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """Order by class and place, and for each row in that order the place of its class's first row."""
    order = np.lexsort((start, doc, span, key))
    key, span = key[order], span[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (span[1:] != span[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order, new, first


def _anchored(docs: DataFrame, scheme: Scheme, frequent: np.ndarray) -> DataFrame:
    """A row per run. One that repeats another of its batch is already known to (``n`` below zero)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, scheme.batch_bytes):
            found = scheme.runs(batch.column("text"))
            doc = batch.column("doc_id").to_numpy()[found.row]
            key, span = found.key.view(np.int64), found.span.view(np.int64)
            order, _, first = _classes(key, span, doc, found.start)
            key, span, doc, start, n = (x[order] for x in (key, span, doc, found.start, found.n))
            known = _later(doc, start, first, scheme)
            route = np.where(_is_in(key, frequent), mixed((key ^ span).view(np.uint64)).view(np.int64), key)
            route = np.where(known, mixed(doc.view(np.uint64)).view(np.int64), route)
            columns = (route, key, span, doc, start.astype(np.int32), np.where(known, -n, n).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["route", "key", "span", "doc_id", "start", "n"]
            )

    return docs.mapInArrow(run, "route bigint, key bigint, span bigint, doc_id bigint, start int, n int")


def _whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Rows sorted by ``column`` in tables that no group is torn by."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        if cut or (kept and kept[-1].column(column)[-1].as_py() != values[0]):
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


def _sorted_out(anchored: DataFrame, scheme: Scheme, frequent: np.ndarray) -> DataFrame:
    """(doc_id, start, n, key, kind): runs that repeat an earlier one, and those to look at window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, "route"):
            key, span, doc, start, n = (table.column(c).to_numpy() for c in ("key", "span", "doc_id", "start", "n"))
            known = n < 0
            kind = np.full(len(n), KEPT, np.int32)
            kind[known] = REPEATED
            rest = np.flatnonzero(~known)
            order, new, first = _classes(key[rest], span[rest], doc[rest], start[rest])
            rest = rest[order]
            later = _later(doc[rest], start[rest], first, scheme)
            kind[rest[later]] = REPEATED
            # An anchor with several classes: their first rows may still share windows.
            names = key[rest]
            bucket = np.cumsum(np.concatenate(([True], names[1:] != names[:-1]))[: len(names)]) - 1
            several = np.bincount(bucket, new, minlength=1)[bucket] > 1 if len(names) else np.zeros(0, bool)
            often = _is_in(names, frequent)
            kind[rest[~later & several & ~often]] = OPEN
            kind[rest[~later & often]] = FREQUENT
            out = np.flatnonzero(kind != KEPT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[out]), pa.array(start[out]), pa.array(np.abs(n[out]).astype(np.int32)),
                 pa.array(key[out], mask=kind[out] == REPEATED), pa.array(kind[out])],
                names=["doc_id", "start", "n", "key", "kind"],
            )

    grouped = anchored.repartition("route").sortWithinPartitions("route")
    return grouped.mapInArrow(run, "doc_id bigint, start int, n int, key bigint, kind int")


def _pieces(packed: DataFrame, open_runs: DataFrame, scheme: Scheme) -> DataFrame:
    """The text of open runs, named by their anchor; of frequent anchors each window, named by its content."""
    listed = open_runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "key", "kind")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows: list[tuple] = []
            for doc, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "runs"))):
                pieces = scheme.cut(_unpacked(text), [(r["start"], r["n"]) for r in runs])
                for r, piece in zip(runs, pieces):
                    if r["kind"] == OPEN:
                        rows.append((r["key"], doc, r["start"], r["n"], piece))
                    else:
                        found = scheme.windows(piece, r["n"])
                        rows += ((_name(w), doc, r["start"] + k, 1, w) for k, w in enumerate(found))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["route", "doc_id", "start", "n", "piece"]
            )

    return packed.join(listed, "doc_id").mapInArrow(run, "route bigint, doc_id bigint, start int, n int, piece binary")


def _name(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)


def _compared(pieces: DataFrame, scheme: Scheme) -> DataFrame:
    """(doc_id, start, n) of windows that occur earlier among the pieces of one anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, "route"):
            out: list[tuple[int, int]] = []
            for _, rows in groupby(zip(*(c.to_pylist() for c in table.columns)), key=lambda r: r[0]):
                places = [
                    (w, (doc, start + k) if scheme.same_text else (doc,), start + k)
                    for _, doc, start, n, piece in rows
                    for k, w in enumerate(scheme.windows(piece, n))
                ]
                first: dict[bytes, tuple] = {}
                for w, place, _ in places:
                    if w not in first or place < first[w]:
                        first[w] = place
                out += ((place[0], at) for w, place, at in places if place > first[w])
            columns = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array([1] * len(out), pa.int32())],
                names=["doc_id", "start", "n"],
            )

    grouped = pieces.repartition("route").sortWithinPartitions("route")
    return grouped.mapInArrow(run, "doc_id bigint, start int, n int")


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed for the way to their runs; null stays null."""

    def compute(batch: pa.RecordBatch) -> list:
        pack = zstandard.ZstdCompressor(level=_COMPRESS).compress
        return [pa.array([None if t is None else pack(t) for t in as_bytes(batch.column("text"))], pa.binary())]

    return add_columns(docs, "packed binary", compute).select("doc_id", "packed")


def _unpacked(text: bytes | None) -> bytes:
    return b"" if text is None else zstandard.ZstdDecompressor().decompress(text)


def with_repeats(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """(doc_id, packed, runs): every row of ``docs`` (doc_id, text) and its repeated windows, as [start, n] pairs.

    ``packed`` is the compressed text, see :func:`text_of`. Rows without an id neither repeat nor
    are repeated. Rows with equal ids count as one document for what is earlier, and each gets the
    repeats found in any of them; ids are meant to be unique.
    """
    bound_batches(docs.sparkSession)
    columns = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    named = columns.filter(F.col("doc_id").isNotNull())
    frequent = _frequent(named, scheme)
    found = settle(_sorted_out(_anchored(named, scheme, frequent), scheme, frequent))
    packed = _packed(columns)
    compared = _compared(_pieces(packed, found.filter(F.col("kind") > REPEATED), scheme), scheme)
    repeated = found.filter(F.col("kind") == REPEATED).select("doc_id", "start", "n").unionByName(compared)
    runs = repeated.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    return packed.join(runs, "doc_id", "left")


#: Bytes of compressed rows with which a result is worked out at once.
RESULT_BYTES = 1 << 20


def text_of(batch: pa.RecordBatch) -> list[bytes | None]:
    return [None if p is None else _unpacked(p) for p in batch.column("packed").to_pylist()]


def covered(batch: pa.RecordBatch, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which tokens of the batch's rows, end to end, some repeated window covers."""
    runs = batch.column("runs")
    ends = runs.offsets.to_numpy()
    flat = runs.values.slice(ends[0], ends[-1] - ends[0])
    start, n = (flat.field(k).to_numpy().astype(np.int64) for k in range(2))
    row = np.repeat(np.arange(len(lengths)), np.diff(ends))
    base = np.concatenate(([0], np.cumsum(lengths)))
    first = base[row] + np.minimum(start, lengths[row])
    last = base[row] + np.minimum(start + n + size - 1, lengths[row])
    room = int(base[-1]) + 1
    steps = np.bincount(first, minlength=room).astype(np.int32)
    steps -= np.bincount(last, minlength=room).astype(np.int32)
    return np.cumsum(steps, dtype=np.int32)[:-1] > 0
