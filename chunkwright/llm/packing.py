"""Packing of token sequences with lexical neighbours.

A document that fills windows by itself does so at once; only what is left of it, less than a window,
moves. These ends are dealt into shards of alike documents, bounded in tokens. A shard has an inverted
BM25 index of its own: a seed fills its window with its best unused neighbours, the last of them cut
where the window ends, and what remains of that one is the next seed. So all windows but the last of a
shard are full, and that one is cut into powers of two.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.session import settle

from .batches import bound_batches, mixed, small
from .words import Known, byte_tokens, cut, sums

#: Words a worker keeps at most; beyond that it starts anew.
KNOWN_WORDS = 800_000
#: Tokens a shard holds about; it bounds a task's memory and a seed's search, not the packing.
SHARD_TOKENS = 1 << 20
#: Bits of the sketch that brings alike documents into a shard: at most 2**16 sketches, counted by the driver.
SKETCH_BITS = 16
# The usual parameters of BM25.
K1, B = 1.2, 0.75


@lru_cache(maxsize=2)
def _known(data: bytes) -> Known:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokens = byte_tokens(data, special=True)
    return Known(lambda words: [tokens.ids(words)])


@lru_cache(maxsize=2)
def _planes(ids: int) -> list[np.ndarray]:
    """For every id, the bits of its hash, four to a number, 16 bits apart: sums of up to 65,535 ids count each bit."""
    bits = mixed(np.arange(1, ids + 1, dtype=np.uint64))
    lanes = []
    for first in range(0, SKETCH_BITS, 4):
        four = [(bits >> np.uint64(first + i) & np.uint64(1)) << np.uint64(16 * i) for i in range(4)]
        lanes.append(np.bitwise_or.reduce(four).astype(np.int64))
    return lanes


def sketches(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The place of each stretch's similarity hash in Gray order, where neighbours differ in one bit; stretches hold under 65,536 ids."""
    lengths = np.diff(starts)
    code = np.zeros(len(lengths), np.int64)
    for lane, plane in enumerate(_planes(size)):
        total = sums(plane[ids], starts)
        for i in range(4):
            most = 2 * (total >> (16 * i) & 0xFFFF) > lengths
            code |= most.astype(np.int64) << (4 * lane + i)
    shift = SKETCH_BITS // 2
    while shift:
        code ^= code >> shift
        shift //= 2
    return code


def _encoded(docs: DataFrame, model: Broadcast, kept: list[str], window: int, end_id: int) -> DataFrame:
    """(row, uid, start, doc_tokens, ids, sequence_id, sketch): full windows with a sequence_id, ends with a sketch; written down."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "text")
    fields = "uid bigint, start bigint, doc_tokens bigint, ids binary, sequence_id bigint, sketch int"
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tokens = _known(model.value), byte_tokens(model.value, special=True)
        size = max(len(tokens.bytes), end_id + 1)
        narrow = np.uint16 if size <= 1 << 16 else np.uint32
        uid = TaskContext.get().partitionId() << 36
        for batch in small(batches):
            if not batch.num_rows:
                continue
            if len(known) > KNOWN_WORDS:
                known.clear()
            words, starts = cut(batch.column("text"), fine=True, whole=tokens.stays_whole(batch.column("text")))
            ids, counts = known.take(0, known.find(words)) if len(words) else (np.zeros(0, np.int32),) * 2
            totals = sums(counts, starts) + 1
            ends = np.cumsum(totals)
            flat = np.full(ends[-1], end_id, np.int64)
            inner = np.ones(len(flat), bool)
            inner[ends - 1] = False
            flat[inner] = ids
            # a piece is a full window, or what is left of a document
            pieces = -(-totals // window)
            doc = np.repeat(np.arange(len(totals)), pieces)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = (ends - totals)[doc] + number * window
            length = np.minimum(window, ends[doc] - begin)
            open_ = length < window
            own = np.arange(uid, uid + len(doc))
            uid += len(doc)
            code = np.zeros(len(doc), np.int64)
            stops = np.append(begin, ends[-1])  # the pieces lie end to end
            code[open_] = sketches(flat, stops, size)[open_]
            data = flat.astype(narrow)
            offsets = pa.py_buffer((stops * data.itemsize).astype(np.int32).tobytes())
            ids_column = pa.Array.from_buffers(pa.binary(), len(doc), [None, offsets, pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(doc)),
                    pa.array(own),
                    pa.array(number * window),
                    pa.array(totals[doc]),
                    ids_column,
                    pa.array(2 * own + 1, mask=open_),
                    pa.array(code.astype(np.int32), mask=~open_),
                ],
                names=schema.names,
            )

    return settle(rows.mapInArrow(run, schema))


class Index:
    """An inverted BM25 index of a shard's documents; terms are token ids."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        count = len(lengths)
        keys = np.sort(np.repeat(np.arange(count), lengths) << 32 | ids)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        often = np.diff(first, append=len(keys))
        doc, term = keys[first] >> 32, keys[first] & 0xFFFFFFFF
        held = np.bincount(term)
        rare = np.maximum(np.log((count - held + 0.5) / (held + 0.5)), 0)  # no weight for what half of the documents hold
        use = rare[term] > 0
        doc, term, often = doc[use], term[use], often[use]
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        weight = rare[term] * often * (K1 + 1) / (often + norm[doc])
        self.terms, self.first = term, np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bincount(doc, minlength=count))))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.size = np.bincount(term, minlength=len(held))
        self.start = np.cumsum(self.size) - self.size
        self.count = count

    def scores(self, seed: int) -> np.ndarray:
        """BM25 scores of all documents for the terms of ``seed``."""
        terms = self.terms[self.first[seed] : self.first[seed + 1]]
        size = self.size[terms]
        ends = np.cumsum(size)
        at = np.repeat(self.start[terms] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.count)


def fill(lengths: np.ndarray, index: Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents shorter than ``window``."""
    out: list[tuple[int, int, int, int, int]] = []
    unused = np.ones(len(lengths), bool)
    following = sequence = 0
    rest: tuple[int, int] | None = None
    while True:
        if rest is None:
            while following < len(lengths) and not unused[following]:
                following += 1
            if following == len(lengths):
                return out
            seed, start = following, 0
            unused[seed] = False
        else:
            seed, start = rest
            rest = None
        own = [(seed, start, int(lengths[seed]) - start)]
        room = window - own[0][2]
        if room:
            scores = np.where(unused, index.scores(seed), -1)
        while room and (best := int(scores.argmax())) >= 0 and scores[best] >= 0:
            taken = min(room, int(lengths[best]))
            own.append((best, 0, taken))
            if taken < lengths[best]:
                rest = best, taken
            room -= taken
            unused[best], scores[best] = False, -1
        for part in [own] if not room else powers(own):
            offset = 0
            for doc, start, length in part:
                out.append((doc, start, length, sequence, offset))
                offset += length
            sequence += 1


def powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of one sequence cut into sequences whose lengths are its powers of two, largest first."""
    total = sum(length for _, _, length in pieces)
    pieces = pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        room = total & 1 << bit
        part = []
        while room:
            doc, start, length = pieces.pop()
            taken = min(room, length)
            part.append((doc, start, taken))
            if taken < length:
                pieces.append((doc, start + taken, length - taken))
            room -= taken
        if part:
            yield part


def deal(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(sketch, first shard, number of shards) from (sketch, tokens): small sketches share a shard with the next, large ones get several."""
    out, shard, filled = [], 0, 0
    for sketch, size in sorted(sizes):
        if filled and filled + size > most:
            shard, filled = shard + 1, 0
        count = max(1, -(-size // most))
        out.append((sketch, shard, count))
        if count > 1:
            shard += count
        else:
            filled += size
    return out


def pack(
    docs: DataFrame, model: Broadcast, window: int = 2048, end_id: int = 1, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """The pieces of all documents: ``docs`` without ``text``, and where each stretch of token ids lies.

    ``model`` is a byte-level file of ``tokenizers``. A document is its ids without added special ones,
    then ``end_id``; null counts as an empty text, so every row has at least one piece, also when it
    is repeated. New columns: ``start`` (ids of the document before it), ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (ids of the sequence before it).
    Sequences hold ``window`` ids, or fewer if that is a power of two: the last ones of a shard.
    No rows give no pieces. Input columns of these names are replaced, others kept.
    """
    if not 0 < window < 1 << 16:
        raise ValueError("window must be from 1 to 65,535")
    spark = docs.sparkSession
    bound_batches(spark)
    new = {"start", "length", "ids", "doc_tokens", "sequence_id", "offset", "text"}
    kept = [c for c in docs.columns if c.lower() not in new]
    pieces = _encoded(docs, model, kept, window, end_id)
    wide = (T.StructType.fromDDL("start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"))
    schema = T.StructType([pieces.schema["row"], *wide])

    def unsigned(data: np.ndarray) -> bytes:
        return data.astype("<u4").tobytes()

    def kind() -> type:
        tokens = byte_tokens(model.value, special=True)
        return np.uint16 if max(len(tokens.bytes), end_id + 1) <= 1 << 16 else np.uint32

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = kind()
        for batch in batches:
            ids = [unsigned(np.frombuffer(x, narrow)) for x in batch.column("ids").to_pylist()]
            zeros = np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("start"), pa.array(zeros + window), pa.array(ids, pa.binary()),
                    batch.column("doc_tokens"), batch.column("sequence_id"), pa.array(zeros),
                ],
                names=schema.names,
            )

    def pack_shard(key: tuple, shard: pa.Table) -> pa.Table:
        narrow = kind()
        shard = shard.sort_by("uid").combine_chunks()
        ids = [np.frombuffer(x, narrow) for x in shard.column("ids").to_pylist()]
        lengths = np.array([len(x) for x in ids], np.int64)
        found = fill(lengths, Index(np.concatenate(ids).astype(np.int64), lengths), window)
        doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*found))
        cuts = [unsigned(ids[d][s : s + n]) for d, s, n, _, _ in found]
        taken = shard.take(pa.array(doc))
        return pa.table(
            [
                taken.column("row"), pa.array(taken.column("start").to_numpy() + start), pa.array(length),
                pa.array(cuts, pa.binary()), taken.column("doc_tokens"),
                pa.array(2 * ((key[0].as_py() << 21) + sequence)), pa.array(offset),
            ],
            names=schema.names,
        )

    ends = pieces.filter("sequence_id IS NULL")
    width = F.when(F.col("start") + window > F.col("doc_tokens"), F.col("doc_tokens") - F.col("start"))
    sizes = ends.groupBy("sketch").agg(F.sum(width).alias("tokens")).collect()  # at most 2**SKETCH_BITS rows
    plan = spark.createDataFrame(deal([tuple(r) for r in sizes], shard_tokens), "sketch int, first bigint, shards bigint")
    dealt = ends.join(F.broadcast(plan), "sketch").select(
        "row", "uid", "start", "doc_tokens", "ids", (F.col("first") + F.pmod(F.xxhash64("uid"), "shards")).alias("shard")
    )
    packed = dealt.groupBy("shard").applyInArrow(pack_shard, schema)
    full = pieces.filter("sequence_id IS NOT NULL").mapInArrow(widen, schema)
    return full.unionByName(packed).select("row.*", *wide.names)
