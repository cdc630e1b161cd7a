"""Text search by blocks: a block of rows, as bits by term, against a part of the queries.

No row is made for a candidate, however many rows hold the terms of a query. A task holds one part of the queries with
their best rows so far, and the row blocks of one part pass through it; what it gives back is at most ``depth``
rows a query. Blocks are sent once for each query part, packed, and queries once for each row part.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75  # usual BM25 parameters of text indexes
BLOCK_ROWS = 8192
BLOCK_POSTINGS = 2_000_000
#: Parts of the rows and of the queries: at least so many, and at most so much in each.
PARTS = (8, 4)
PART_ROWS = (250_000, 250_000)
_WIDE = 256  # queries whose bits are held at a time
_PACKED = "part int, kind int, data binary"
_SLACK = 1e-9


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _short(counts: np.ndarray) -> np.ndarray:
    small = counts.astype(np.uint16)
    return small if (small == counts).all() else counts


def _row(part: int, kind: int, data: bytes) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int32()), pa.array([kind], pa.int32()), pa.array([data], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "kind", "data"])


def _lists(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """Values of all lists, and how many each has."""
    ends = column.offsets.to_numpy()
    return column.values.slice(ends[0], ends[-1] - ends[0]), np.diff(ends)


def _places(terms: pa.Array, known: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False)


def _row_blocks(docs: DataFrame, known, parts: int) -> DataFrame:
    """(ord, words, terms) rows in blocks: the known terms held, and by term the rows that hold it, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                flat, counts = _lists(part.column("terms"))
                place, times = _places(flat.field("term"), known.value), flat.field("n").to_numpy()
                row = np.repeat(np.arange(len(counts)), counts)
                held = place >= 0
                row, place, times = row[held], place[held], times[held]
                ords, words = part.column("ord").to_numpy(), part.column("words").to_numpy()
                step = -(-len(ords) // max(1, -(-len(row) // BLOCK_POSTINGS)))
                for first in range(0, len(ords), step):
                    low, high = np.searchsorted(row, (first, first + step))
                    own = row[low:high] - first
                    order = np.lexsort((own, place[low:high]))
                    ids, at = np.unique(place[low:high][order], return_index=True)
                    yield _row(number % parts, 1, _pack(
                        ords[first : first + step], words[first : first + step], ids.astype(np.int32),
                        np.append(at, len(order)), np.diff(own[order].astype(np.uint16), prepend=np.uint16(0)),
                        _short(times[low:high][order]),
                    ))
                    number += 1

    return docs.mapInArrow(run, _PACKED)


def _query_blocks(queries: DataFrame, known, parts: int) -> DataFrame:
    """(query, terms) rows in blocks: places of their terms, -1 beyond the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS // 4):
                part = batch.slice(start, BLOCK_ROWS // 4)
                flat, counts = _lists(part.column("terms"))
                places = np.full((len(counts), int(counts.max())), -1, np.int32)
                places[np.arange(places.shape[1]) < counts[:, None]] = _places(flat, known.value)
                yield _row(number % parts, 0, _pack(part.column("query").to_numpy(), places))
                number += 1

    return queries.mapInArrow(run, _PACKED)


class _Best:
    """Queries of a task and the best rows of each so far."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, avg_words: float, depth: int):
        wide = max(places.shape[1] for _, places in blocks)
        self.query = np.concatenate([query for query, _ in blocks])
        self.places = np.concatenate(
            [np.pad(places, ((0, 0), (0, wide - places.shape[1])), constant_values=-1) for _, places in blocks]
        )
        self.idf, self.avg_words, self.depth = idf, avg_words, depth
        self.here = np.full(len(idf) + 1, -1, np.int32)
        self.score = np.full((len(self.query), depth), -np.inf)
        self.ord = np.zeros((len(self.query), depth), np.int64)

    def meet(self, ords, words, ids, at, row, times) -> None:
        terms, width = len(ids), (len(ords) + 7) // 8
        if not terms:
            return
        row, of = np.cumsum(row, dtype=np.uint16).astype(np.int64), np.repeat(np.arange(terms), np.diff(at))
        length = K1 * (1 - B + B * words / self.avg_words)
        weight = self.idf[ids][of] * times * (K1 + 1) / (times + length[row])
        most = np.append(np.maximum.reduceat(weight, at[:-1]), 0.0)
        weight = np.append(weight, 0.0)  # that of no term
        bits = np.zeros((terms + 1) * width, np.uint8)
        np.add.at(bits, of * width + (row >> 3), (128 >> (row & 7)).astype(np.uint8))
        bits = bits.reshape(terms + 1, width)
        count = np.bitwise_count(bits)
        before = (np.cumsum(count, axis=1, dtype=np.uint16) - count).ravel()  # rows of the term in earlier bytes
        bits[terms] = 255  # no term leaves no row out
        flat_bits = bits.ravel()

        self.here[ids] = np.arange(terms)
        self.here[-1] = terms
        local = self.here[self.places]
        self.here[ids] = -1
        open_ = np.flatnonzero((local >= 0).all(axis=1))
        bound = most[local[open_]].sum(axis=1)
        open_ = open_[bound >= self.score[open_, -1] - _SLACK]
        for start in range(0, len(open_), _WIDE):
            who = open_[start : start + _WIDE]
            asked = local[who]
            both = bits[asked[:, 0]]
            for j in range(1, asked.shape[1]):
                both &= bits[asked[:, j]]
            byte = np.flatnonzero(both != 0)
            if not len(byte):
                continue
            i, bit = np.nonzero(np.unpackbits(both.ravel()[byte][:, None], axis=1))
            q, byte = np.divmod(byte[i], width)
            least = self.score[who, -1] - _SLACK
            rest = np.cumsum(most[asked][:, ::-1], axis=1)[:, ::-1]
            total = np.zeros(len(q))
            for j in range(asked.shape[1]):
                term = asked[q, j]
                spot = term * np.int64(width) + byte
                place = at[term] + before[spot] + np.bitwise_count(flat_bits[spot].astype(np.uint16) >> (8 - bit))
                total += weight[np.where(term < terms, place, len(weight) - 1)]
                ahead = rest[:, j + 1][q] if j + 1 < asked.shape[1] else 0.0
                keep = total + ahead >= least[q]
                if not keep.all():
                    q, byte, bit, total = q[keep], byte[keep], bit[keep], total[keep]
            if len(q):
                self._take(who[q], ords[byte * 8 + bit], np.round(total, 10))

    def _take(self, q: np.ndarray, ords: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(q)
        old, slot = np.nonzero(self.score[touched] > -np.inf)
        old = touched[old]
        q, ords, score = np.append(q, old), np.append(ords, self.ord[old, slot]), np.append(score, self.score[old, slot])
        order = np.lexsort((ords, -score, q))
        q, ords, score = q[order], ords[order], score[order]
        first = np.searchsorted(q, q)
        place = np.arange(len(q)) - first
        keep = place < self.depth
        self.score[q[keep], place[keep]] = score[keep]
        self.ord[q[keep], place[keep]] = ords[keep]

    def found(self) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.query), BLOCK_ROWS):
            score = self.score[start : start + BLOCK_ROWS]
            q, slot = np.nonzero(score > -np.inf)
            columns = [self.query[start + q], self.ord[start + q, slot], score[q, slot]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "ord", "score"])


def best_rows(docs: DataFrame, queries: DataFrame, vocabulary: pa.Table, docs_total: int, avg_words: float, depth: int) -> DataFrame:
    """(query, ord, score): of every query the best rows of each row part, those that hold all its terms.

    ``docs`` has (ord, words, terms: array of (term, n)), one row per ``ord``; ``queries`` has (query, terms), rarest
    first; ``vocabulary`` (term, df) holds the terms of all queries, and is sent to every task.
    """
    context = docs.sparkSession.sparkContext
    df = vocabulary.column("df").to_numpy()
    known = context.broadcast(vocabulary.column("term").combine_chunks())
    idf = context.broadcast(np.log(1 + (docs_total - df + 0.5) / (df + 0.5)))
    row_parts, query_parts = (
        max(least, math.ceil(rows / most)) for rows, least, most in zip((docs_total, queries.count()), PARTS, PART_ROWS)
    )
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    blocks = _row_blocks(docs, known, row_parts).withColumn("other", every(query_parts))
    asked = _query_blocks(queries, known, query_parts).withColumn("other", every(row_parts))
    group = lambda row, query: (F.col(row) * query_parts + F.col(query)).alias("group")
    sent = blocks.select(group("part", "other"), "kind", "data").unionByName(
        asked.select(group("other", "part"), "kind", "data")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, best = [], None
        for batch in batches:  # queries come first
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data")):
                if kind == 0:
                    waiting.append(_unpack(data.as_py()))
                elif waiting:
                    best = best or _Best(waiting, idf.value, avg_words, depth)
                    best.meet(*_unpack(data.as_py()))
        if best is not None:
            yield from best.found()

    met = sent.repartitionById(row_parts * query_parts, F.col("group")).sortWithinPartitions("kind")
    return met.select("kind", "data").mapInArrow(run, "query bigint, ord bigint, score double")
