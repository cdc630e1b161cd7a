"""Removal of repeated byte strings by bucket-pointer refinement of suffixes.

Suffixes are first put into buckets by their first ``gram`` bytes. A bucket is refined by the
bucket of a later offset: two suffixes that share a bucket for ``m`` bytes, and whose suffixes at
that offset do so too, share one for up to ``2m`` bytes. The names of one round are the pointers
of the next, until the wanted length is reached.

Only the suffixes that can begin a bucket worth refining are kept: each string of the wanted length
is filed under the least bucket name among the suffixes inside it, and buckets that hold one string
only are left alone. What remains is refined by the names of whole runs, then string by string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import add_columns, flat_bytes, mixed
from .repeats import RESULT_BYTES, Digests, Runs, Scheme, covered, runs_of_picks, text_of, with_repeats

LENGTH = 100
GRAM = 32
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE = np.uint64((1 << 25) - 1)


def refined(names: np.ndarray, have: int, want: int) -> np.ndarray:
    """Bucket names of the first ``want`` bytes of each suffix from those of the first ``have``."""
    while have < want:
        step = min(have, want - have)
        names = mixed(names[:-step] * np.uint64(0xD6E8FEB86659FD93) + names[step:])
        have += step
    return names


def _least_places(names: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the least name of the next ``width`` lies, the first of equal ones."""
    least = (names & ~_PLACE) | np.arange(len(names), dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least & _PLACE).astype(np.int64)


def _runs(column: pa.Array, length: int, gram: int) -> Runs:
    values, starts = flat_bytes(column)
    none = np.zeros(0, np.int64)
    if len(values) < length:
        return Runs(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    if len(values) > int(_PLACE):
        raise ValueError("a batch of one text above 32 MB")
    half = gram // 2
    digests = Digests(_BYTES[values])
    at = np.arange(len(values) - half + 1)
    buckets = refined(mixed(digests.of(at, at + half)), half, gram)
    pick = _least_places(buckets, length - gram + 1)
    row, first, n = runs_of_picks(pick, starts, length)
    span = mixed(digests.of(first, first + n - 1 + length) + n.astype(np.uint64))
    return Runs(row, first - starts[row], n, buckets[pick[first]], span)


def byte_scheme(length: int = LENGTH, gram: int = GRAM) -> Scheme:
    return Scheme(
        size=length,
        same_text=True,
        runs=lambda column: _runs(column, length, gram),
        cut=lambda text, runs: [text[s : s + n - 1 + length] for s, n in runs],
        windows=lambda piece, n: [piece[k : k + length] for k in range(n)],
    )


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) for every row of ``docs`` (doc_id, text).

    ``kept`` (binary) is the UTF-8 text without the bytes of ``length``-byte strings that also start
    earlier (smaller doc_id, or same document and earlier start). Null and empty texts have no bytes,
    shorter ones lose none. Rows without an id neither lose bytes nor make others lose them. Input
    columns other than doc_id and text are left out. See :func:`repeats.with_repeats` for equal ids.
    """

    def compute(batch: pa.RecordBatch) -> list:
        texts = [t or b"" for t in text_of(batch)]
        values = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.array([len(t) for t in texts], np.int64)
        gone = covered(batch, lengths, length)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        begins = gone & ~np.concatenate(([False], gone[:-1]))
        begins[ends[:-1][lengths > 0]] = gone[ends[:-1][lengths > 0]]
        removed, spans = (np.diff(np.append(np.int32(0), np.cumsum(x, dtype=np.int32))[ends]) for x in (gone, begins))
        kept_ends = np.concatenate(([0], np.cumsum(lengths - removed))).astype(np.int32)
        buffers = [None, pa.py_buffer(kept_ends.tobytes()), pa.py_buffer(values[~gone].tobytes())]
        kept = pa.Array.from_buffers(pa.binary(), len(texts), buffers)
        return [kept, *(pa.array(x, pa.int64()) for x in (lengths, removed, spans))]

    found = with_repeats(docs, byte_scheme(length, gram))
    out = add_columns(found, "kept binary, n_bytes bigint, n_removed bigint, n_spans bigint", compute, RESULT_BYTES)
    return out.select("doc_id", "kept", "n_bytes", "n_removed", "n_spans")
