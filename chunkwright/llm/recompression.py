"""Removal of repeated word sequences by recompression.

Rounds give one name to every run of equal symbols and to every pair of a left and a right symbol;
which side a symbol is on follows from its name. Names are digests of what they stand for, so all
tasks name alike without a shared table, and two symbols are joined or parted by looking at these
two alone. Equal sequences therefore get equal symbols inside, save for a few at their ends.

A window picks, among the symbols of the last round that it determines whole (with the neighbours
that decided their ends), one by name; windows that share a picked symbol with another document are
compared, see :mod:`repeats`. A window that determines no symbol, inside a long run of one word,
stands for itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import add_columns, mixed, word_hashes
from .repeats import RESULT_BYTES, Digests, Runs, Scheme, covered, least_in_ranges, runs_of_picks, text_of, with_repeats

WORDS = 13
_PLACE = np.uint64((1 << 24) - 1)
_FAR = 1 << 40


@dataclass
class Symbols:
    """Names of the symbols of a batch, in order, and the words each one's name and ends depend on."""

    name: np.ndarray
    row: np.ndarray
    low: np.ndarray
    high: np.ndarray


def rounds_for(size: int) -> int:
    """Most rounds after which a window of ``size`` words without runs still determines a symbol."""
    return max(0, int(np.log2((size + 3) / 4)))


def compressed(s: Symbols, level: int) -> Symbols:
    """One round: a run of a left symbol followed by a run of a right one becomes a symbol, as does a run alone."""
    if not len(s.name):
        return s
    side = (mixed(s.name + np.uint64(level + 1)) >> np.uint64(40)) & np.uint64(1)
    near = s.row[1:] == s.row[:-1]
    pair = near & (side[:-1] == 0) & (side[1:] == 1) & (s.name[1:] != s.name[:-1])
    first = np.flatnonzero(np.concatenate(([True], ~(pair | (near & (s.name[1:] == s.name[:-1]))))))
    end = np.append(first[1:], len(s.name))
    # Symbols of the left run; all of them where no right run follows.
    turn = np.concatenate(([0], np.cumsum(pair)))
    paired = turn[end - 1] > turn[first]
    turns = np.flatnonzero(pair)
    at = np.full(len(first), 0, np.int64)
    at[paired] = turns[turn[first[paired]]] + 1
    left = np.where(paired, at - first, end - first).astype(np.uint64)
    right = np.where(paired, end - at, 0).astype(np.uint64)
    joined = mixed(mixed(s.name[first] * np.uint64(0xD6E8FEB86659FD93) + left) + s.name[end - 1] * (right + np.uint64(1)))
    name = np.where(end - first == 1, s.name[first], joined)
    # Each end was decided by the neighbour beyond it; at the end of a text there is none to decide by.
    inner = np.concatenate(([False], near))
    low = np.where(inner[first], s.low[np.maximum(first - 1, 0)], -_FAR)
    inner = np.concatenate((near, [False]))
    high = np.where(inner[end - 1], s.high[np.minimum(end, len(s.high) - 1)], _FAR)
    return Symbols(name, s.row[first], low, high)


def _runs(column: pa.Array, size: int) -> Runs:
    (words,), starts = word_hashes(column)
    count = len(words)
    if count > int(_PLACE):
        raise ValueError("a batch of one text above 16 million words")
    place = np.arange(count)
    symbols = Symbols(words, np.repeat(np.arange(len(starts) - 1), np.diff(starts)), place, place + 1)
    for level in range(rounds_for(size)):
        symbols = compressed(symbols, level)
    digests = Digests(words)
    whole = (symbols.low >= 0) & (symbols.high - symbols.low <= size) & (symbols.high < _FAR)
    low, high = symbols.low[whole], symbols.high[whole]
    # What a symbol depends on is its anchor's name: the words from neighbour to neighbour.
    name = mixed(digests.of(low, high) + (high - low).astype(np.uint64))
    packed = (name & ~_PLACE) | np.arange(len(name), dtype=np.uint64)
    windows = np.arange(max(count - size + 1, 0))
    first, end = np.searchsorted(low, windows), np.searchsorted(high, windows + size, "right")
    some = end > first
    pick = -1 - np.arange(len(windows))
    pick[some] = (least_in_ranges(packed, first[some], end[some]) & _PLACE).astype(np.int64)
    row, start, n = runs_of_picks(pick, starts, size)
    span = mixed(digests.of(start, start + n - 1 + size) + n.astype(np.uint64))
    picked = pick[start]
    key = span.copy()
    key[picked >= 0] = name[picked[picked >= 0]]
    return Runs(row, start - starts[row], n, key, span)


def _cut(text: bytes, runs: list[tuple[int, int]], size: int) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[s : s + n - 1 + size]) for s, n in runs]


def _windows(piece: bytes, n: int, size: int) -> list[bytes]:
    words = piece.split()
    return [b" ".join(words[k : k + size]) for k in range(n)]


def word_scheme(size: int = WORDS) -> Scheme:
    return Scheme(
        size=size,
        same_text=False,
        runs=lambda column: _runs(column, size),
        cut=lambda text, runs: _cut(text, runs, size),
        windows=lambda piece, n: _windows(piece, n, size),
    )


def remove_repeated_words(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) for every row of ``docs`` (doc_id, text).

    Words are runs without ASCII white space. ``kept`` is what is left, joined by single blanks, when
    each word goes that is covered by a window of ``size`` words which also starts in a document with
    a smaller doc_id. Null and empty texts have no words, shorter ones lose none. Rows without an id
    neither lose words nor make others lose them. Input columns other than doc_id and text are left
    out. See :func:`repeats.with_repeats` for equal ids.
    """

    def compute(batch: pa.RecordBatch) -> list:
        texts = [t.split() if t else [] for t in text_of(batch)]
        lengths = np.array([len(words) for words in texts], np.int64)
        gone = covered(batch, lengths, size)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[ends])
        left = [
            b" ".join(compress(words, (~gone[at : at + len(words)]).tolist()) if lost else words)
            for words, at, lost in zip(texts, ends.tolist(), removed.tolist())
        ]
        return [pa.array(left, pa.binary()).cast(pa.string()), *(pa.array(x, pa.int64()) for x in (lengths, removed))]

    found = with_repeats(docs, word_scheme(size))
    out = add_columns(found, "kept string, n_words bigint, n_removed bigint", compute, RESULT_BYTES)
    return out.select("doc_id", "kept", "n_words", "n_removed")
