"""Row-local work on Arrow batches, shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Bytes worked on at once by a task.
BATCH_BYTES = 2 << 20


#: Bytes of an Arrow batch between Spark and a worker.
WIRE_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of the session are limited in bytes, as texts may be long; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    digits = "".join(c for c in spark.conf.get(name) if c.isdigit() or c == "-")
    if not 0 < int(digits) <= WIRE_BYTES:
        spark.conf.set(name, str(WIRE_BYTES))


def add_columns(
    df: DataFrame, fields: str, compute: Callable[[pa.RecordBatch], list], batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``df`` with the columns of the DDL string ``fields`` as ``compute`` returns them per batch.

    A column of ``df`` with the name of a new one (in any case) is replaced.
    ``compute`` gets the whole batch and returns one Arrow array per new field.
    """
    bound_batches(df.sparkSession)
    new = T.StructType.fromDDL(fields)
    taken = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, batch_bytes):
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + list(compute(batch)), names=names + new.names
            )

    return df.mapInArrow(run, T.StructType(kept + list(new)))


def small(batches: Iterator[pa.RecordBatch], batch_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``batch_bytes``, whatever the session's setting in rows."""
    for batch in batches:
        parts = min(batch.num_rows, math.ceil(batch.nbytes / batch_bytes))
        step = math.ceil(batch.num_rows / parts) if parts else 1
        for first in range(0, batch.num_rows, step):
            yield batch.slice(first, step)
    pa.default_memory_pool().release_unused()  # workers live on, next to those of other stages


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Texts of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from its flat values and the length of each row's list."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


#: Bytes that are no letter or digit become blanks, A-Z lower case, all from 0x80 on stay.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_TABLE = np.frombuffer(NORMAL, np.uint8)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of a string column end to end, and where each row starts, then the end; null is empty."""
    filled = pc.fill_null(column, "") if column.null_count else column
    offsets = np.frombuffer(filled.buffers()[1], np.int32)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return values, (offsets - offsets[0]).astype(np.int64)


def word_hashes(column: pa.Array, lanes: int = 1, normal: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """64-bit hashes of all words, ``lanes`` independent ones each, and where each row's words start, then the end.

    Words are runs without ASCII white space; with ``normal``, of lower-cased letters and digits.
    """
    from pandas.util import hash_array

    values, starts = flat_bytes(column)
    if normal:
        values = _TABLE[values]
    offsets = pa.py_buffer(starts.astype(np.int32).tobytes())
    texts = pa.Array.from_buffers(pa.string(), len(column), [None, offsets, pa.py_buffer(values.tobytes())])
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    ends = split.offsets.to_numpy().astype(np.int64)
    known = split.values.dictionary_encode()
    names = known.dictionary.to_numpy(zero_copy_only=False)
    used = known.indices.to_numpy()
    empty = np.diff(ends) == 1
    if empty.any():  # an empty text is split into one empty word
        blank = np.zeros(len(used) + 1, np.int64)
        lone = np.flatnonzero(empty)[[names[used[e]] == "" for e in ends[:-1][empty]]]
        blank[ends[lone] + 1] = 1
        kept = blank[1:] == 0
        used, ends = used[kept], ends - np.cumsum(blank)[ends]
    out = []
    for lane in range(lanes):
        key = f"{lane:016d}"
        hashed = hash_array(names, hash_key=key, categorize=False) if len(names) else np.zeros(0, np.uint64)
        out.append(hashed[used])
    return out, ends


def mixed(values: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers stirred."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
