"""Alignment of two tokenizations of the same bytes by galloping intersection of their end offsets.

Of the two sorted lists of token ends, the shorter drives: each of its ends is looked for in the longer
list by exponential, then binary search. Ends in both cut the text into groups; the ranks of successive
ends in the longer list bound the tokens that a token overlaps. Words are aligned once per block of
documents, all new ones of a batch together.

How many documents of the corpus link a pair of ids is counted per block first. A block shuffles one
row per distinct pair, gets the corpus counts back, and settles its documents by them, so that no row
per token or per document and pair is ever shuffled, however frequent a pair is.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.session import settle

from .batches import add_columns, bound_batches, lists, small
from .sentencepiece import BYTE, MARK, _model, _reference
from .words import Known, byte_tokens, cut, ranges, sums

#: A block ends with the batch that brings it to so many different words, or words in all.
BLOCK_WORDS = 300_000
BLOCK_LENGTH = 4_000_000
#: New columns of :func:`align` and of :func:`link_scores`.
GROUPS = "a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>, links array<struct<a:int,b:int>>"
FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def gallop(short: np.ndarray, longer: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each value, the first index in ``longer[first:last]`` whose value is not below it (``last`` if none).

    The step doubles until it reaches such a value, then the stretch it jumped over is halved again and
    again; all searches take their steps together.
    """
    below, above = first - 1, first.copy()  # what is at or before `below` is known to be smaller
    step = np.ones(len(short), np.int64)
    open_ = np.arange(len(short))
    while len(open_):
        at = above[open_]
        go = (at < last[open_]) & (longer[np.minimum(at, len(longer) - 1)] < short[open_])
        open_ = open_[go]
        below[open_] = above[open_]
        above[open_] = np.minimum(above[open_] + step[open_], last[open_])
        step[open_] *= 2
    while (wide := np.flatnonzero(above - below > 1)).size:
        middle = (above[wide] + below[wide]) // 2
        less = longer[middle] < short[wide]
        below[wide[less]] = middle[less]
        above[wide[~less]] = middle[~less]
    return above


def overlaps(
    short: np.ndarray, n_short: np.ndarray, longer: np.ndarray, n_longer: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token of the shorter lists: the first token of the longer list it overlaps, how many, and whether both end there.

    The lists of all words lie end to end; indices count within ``longer`` as a whole.
    """
    stops = np.cumsum(n_longer)
    first, last = np.repeat(stops - n_longer, n_short), np.repeat(stops, n_short)
    rank = gallop(short, longer, first, last)
    shared = longer[rank] == short
    begins = (np.cumsum(n_short) - n_short)[n_short > 0]
    start = np.concatenate((np.zeros(1, np.int64), (rank + shared)[:-1]))[: len(rank)]
    start[begins] = first[begins]
    return start, rank - start + 1, shared


def _ends(lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Running sums within stretches of ``counts`` lengths each, as the end offsets of a word's tokens."""
    total = np.cumsum(lengths)
    before = np.concatenate((np.zeros(1, np.int64), total))[np.cumsum(counts) - counts]
    return total - np.repeat(before, counts)


class Aligner:
    """Both tokenizers, and what they make of words."""

    def __init__(self, a: bytes, b: bytes):
        self.a = byte_tokens(a, special=False)
        self.b = _reference(b)
        pieces = _model(b).pieces
        shown = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in pieces
        ]
        self.b_bytes = pa.array(shown, pa.binary())
        self.b_lengths = pc.binary_length(self.b_bytes).to_numpy().astype(np.int64)
        # decimal ids with what follows them in the text of the groups
        names = [str(i) for i in range(max(len(self.a.bytes), len(pieces)))]
        self.decimal = pa.array([n + end for end in ",|;" for n in names], pa.binary())
        self.ids = len(names)

    def words(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For :class:`~chunkwright.llm.words.Known`: ids of both, links, the groups as text and as their numbers of tokens, validity."""
        a, n_a = self.a.ids(words)
        found = self.b.encode([w[1:] for w in words], num_threads=1)  # it puts a blank before each
        n_b = np.fromiter(map(len, found), np.int64, len(words))
        b = np.fromiter((i for ids in found for i in ids), np.int32, int(n_b.sum()))
        whole = self._spell(words, a, n_a, self.a.bytes, self.a.lengths) & self._spell(words, b, n_b, self.b_bytes, self.b_lengths)
        keep_a, keep_b = np.repeat(whole, n_a), np.repeat(whole, n_b)
        a, b, n_a, n_b = a[keep_a], b[keep_b], np.where(whole, n_a, 0), np.where(whole, n_b, 0)
        links, n_links, group_a, group_b, n_groups = self._links(a, n_a, b, n_b)
        groups = int(n_groups.sum())
        return [
            (a, n_a),
            (b, n_b),
            (links, n_links),
            self._text(a, n_a, group_a, b, n_b, group_b),
            (np.bincount(group_a, minlength=groups), n_groups),
            (np.bincount(group_b, minlength=groups), n_groups),
            (whole, np.ones(len(words), np.int64)),
        ]

    def _spell(self, words: list[str], ids: np.ndarray, counts: np.ndarray, table: pa.Array, lengths: np.ndarray) -> np.ndarray:
        """Whether the tokens of each word are its bytes."""
        want = [w.encode() for w in words]
        sizes = np.fromiter(map(len, want), np.int64, len(want))
        got = sums(lengths[ids], np.concatenate((np.zeros(1, np.int64), np.cumsum(counts))))
        same = got == sizes
        if not same.any():
            return same
        left = np.frombuffer(b"".join(w for w, s in zip(want, same) if s), np.uint8)
        taken = table.take(pa.array(ids[np.repeat(same, counts)]))
        right = np.frombuffer(taken.buffers()[2], np.uint8)[: len(left)]
        wrong = sums(left != right, np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes[same]))))
        same[np.flatnonzero(same)[wrong > 0]] = False
        return same

    def _links(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        """Linked pairs (a * 2**32 + b) word by word in text order, and the group of each token counted over all words."""
        ends_a, ends_b = _ends(self.a.lengths[a], n_a), _ends(self.b_lengths[b], n_b)
        word_a, word_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        parts = []
        n_groups = np.zeros(len(n_a), np.int64)
        cut_a, cut_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        for a_drives in (True, False):
            drive = n_a <= n_b if a_drives else n_a > n_b
            at_a, at_b = np.flatnonzero(drive[word_a]), np.flatnonzero(drive[word_b])
            at_short, at_long = (at_a, at_b) if a_drives else (at_b, at_a)
            if not len(at_short):
                continue
            n_short, n_long = (n_a[drive], n_b[drive]) if a_drives else (n_b[drive], n_a[drive])
            short, longer = (ends_a, ends_b) if a_drives else (ends_b, ends_a)
            start, count, shared = overlaps(short[at_short], n_short, longer[at_long], n_long)
            own, other = np.repeat(at_short, count), at_long[ranges(start, count)]
            parts.append((own, other) if a_drives else (other, own))
            hits = at_short[shared], at_long[(start + count - 1)[shared]]
            (cut_a if a_drives else cut_b)[hits[0]] = True
            (cut_b if a_drives else cut_a)[hits[1]] = True
            n_groups += np.bincount((word_a if a_drives else word_b)[hits[0]], minlength=len(n_a))
        link_a = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        link_b = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        order = np.lexsort((link_b, link_a))
        link_a, link_b = link_a[order], link_b[order]
        links = a[link_a].astype(np.int64) << 32 | b[link_b]
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        return links, np.bincount(word_a[link_a], minlength=len(n_a)), group_a, group_b, n_groups

    def _text(self, a, n_a, group_a, b, n_b, group_b) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;`` for every group of a word, as bytes."""
        last_a = np.append(group_a[1:] != group_a[:-1], True) if len(a) else np.zeros(0, bool)
        last_b = np.append(group_b[1:] != group_b[:-1], True) if len(b) else np.zeros(0, bool)
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        shown = np.concatenate((a + self.ids * last_a, b + 2 * self.ids * last_b))[order]
        taken = self.decimal.take(pa.array(shown))
        sizes = pc.binary_length(taken).to_numpy().astype(np.int64)
        tokens = n_a + n_b
        n_text = sums(sizes, np.concatenate((np.zeros(1, np.int64), np.cumsum(tokens))))
        buffer = taken.buffers()[2]
        text = np.frombuffer(buffer, np.uint8)[: n_text.sum()].copy() if buffer else np.zeros(0, np.uint8)
        return text, n_text


A_IDS, B_IDS, LINKS, TEXT, GROUP_A, GROUP_B, WHOLE = range(7)


@lru_cache(maxsize=2)
def _aligner(a: bytes, b: bytes) -> Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(a, b)


def _rows(known: Known, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of all rows that both tokenizers spell whole, and where each row starts, then the end."""
    words, starts = cut(column, lead=" ")
    empty = pc.equal(pc.binary_length(pc.fill_null(column, "")), 0).to_numpy(zero_copy_only=False)
    places = known.find(words)
    bad = (sums(~known.values(WHOLE)[places], starts) > 0 if len(places) else np.zeros(len(column), bool)) | empty
    keep = np.repeat(~bad, np.diff(starts))
    return places[keep], np.concatenate((np.zeros(1, np.int64), np.cumsum(np.where(bad, 0, np.diff(starts)))))


def align(docs: DataFrame, a: Broadcast, b: Broadcast) -> DataFrame:
    """``docs`` with the tokens of both tokenizers and how they lie.

    ``a`` is a byte-level file of ``tokenizers``, ``b`` a SentencePiece model that puts a blank before a
    text. A blank and the text are encoded, names of special tokens as plain text. ``a_ids`` and
    ``b_ids``: the tokens; ``a_ends`` and ``b_ends``: how many of them the groups up to each group's end
    hold, a group ending wherever tokens of both end; ``links``: all pairs of ids whose bytes overlap, in
    text order. A text that is null, empty, or not spelled by the tokens of both has no tokens. Input
    columns of these names are replaced, others kept; repeated rows count each.
    """
    known = Known(lambda words: _aligner(a.value, b.value).words(words))

    def compute(batch: pa.RecordBatch) -> list:
        if len(known) > BLOCK_WORDS:
            known.clear()
        places, starts = _rows(known, batch.column("text"))
        out = []
        for output, kind in ((A_IDS, pa.int32()), (B_IDS, pa.int32())):
            values, counts = known.take(output, places)
            out.append(lists(values, sums(counts, starts), kind))
        for output in (GROUP_A, GROUP_B):
            sizes, counts = known.take(output, places)
            rows = sums(counts, starts)
            out.append(lists(_ends(sizes, rows), rows, pa.int32()))
        links, counts = known.take(LINKS, places)
        pairs = pa.StructArray.from_arrays(
            [pa.array(links >> 32, pa.int32()), pa.array(links & 0xFFFFFFFF, pa.int32())], names=["a", "b"]
        )
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sums(counts, starts))))
        return [*out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)]

    return add_columns(docs, GROUPS, compute)


#: What a block writes: a row for each document, then one with its distinct links (pair numbers of all words end to end,
#: where each word's end, the pairs, and how many of its documents hold them).
_DOCUMENT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, words array<int>"
_BLOCK = "links array<int>, ends array<int>, pairs array<bigint>, n_docs array<int>"


def _block_row(known: Known, documents: list[np.ndarray]) -> list[pa.Array]:
    """The arrays of a block: see ``_BLOCK``."""
    pairs, links = np.unique(known.values(LINKS), return_inverse=True)
    counts = known.counts(LINKS)
    starts = np.cumsum(counts) - counts
    n_docs = np.zeros(len(pairs), np.int32)
    for places in documents:
        used = np.unique(places)
        n_docs[np.unique(links[ranges(starts[used], counts[used])])] += 1
    values = ((links, pa.int32()), (np.cumsum(counts), pa.int32()), (pairs, pa.int64()), (n_docs, pa.int32()))
    return [lists(v, np.array([len(v)]), kind) for v, kind in values]


def _settled_blocks(docs: DataFrame, a: Broadcast, b: Broadcast, kept: list[str]) -> DataFrame:
    """(block, row, document columns, block columns), written down."""
    new = T.StructType.fromDDL(f"{_DOCUMENT}, {_BLOCK}")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "text")
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("row", rows.schema["row"].dataType), *new])
    n_document = len(T.StructType.fromDDL(_DOCUMENT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(_aligner(a.value, b.value).words)
        block, length = TaskContext.get().partitionId() << 32, 0
        documents: list[np.ndarray] = []
        arrow = None

        def close() -> pa.RecordBatch:
            none = [pa.nulls(1, t) for t in arrow.types[1 : 2 + n_document]]
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *none, *_block_row(known, documents)], schema=arrow)

        for batch in small(batches):
            if not batch.num_rows:
                continue
            places, starts = _rows(known, batch.column("text"))
            figures = [sums(known.counts(o)[places], starts) if len(places) else np.zeros(batch.num_rows, np.int64) for o in (A_IDS, B_IDS, GROUP_A, LINKS)]
            text, sizes = known.take(TEXT, places)
            ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sums(sizes, starts))))
            digests = [
                hashlib.sha256(text[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends[:-1], ends[1:])
            ]
            row = batch.column("row")
            columns = [pa.array(np.full(batch.num_rows, block)), row, *map(pa.array, figures), pa.array(digests, pa.string())]
            columns.append(lists(places, np.diff(starts), pa.int32()))
            if arrow is None:
                blocks = [pa.field(f.name, t) for f, t in zip(new[n_document:], (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())))]
                arrow = pa.schema([*(pa.field(f.name, c.type) for f, c in zip(schema, columns)), *blocks])
            columns += [pa.nulls(batch.num_rows, t) for t in arrow.types[len(columns) :]]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            documents += [places[i:j].astype(np.int32) for i, j in zip(starts[:-1], starts[1:])]
            length += len(places)
            if len(known) >= BLOCK_WORDS or length >= BLOCK_LENGTH:
                yield close()
                known.clear()
                block, length, documents = block + 1, 0, []
        if documents:
            yield close()

    return settle(rows.mapInArrow(run, schema))


def link_scores(docs: DataFrame, a: Broadcast, b: Broadcast) -> DataFrame:
    """``docs`` without ``text``, with figures of how the two tokenizations lie; arguments as of :func:`align`.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links``: tokens, groups and links. A pair's count is how many
    documents hold it linked. ``n_best``: links whose count is the highest of any pair with their ``a``;
    ``count_sum``: the counts of all links added up. ``groups_sha256``: digest of the groups, as
    ``a1,a2|b1;a3|b2``. Texts without tokens have zeros and an empty digest. Repeated rows count as documents
    each; input columns named like a new one are replaced, others kept. No rows give no rows.
    """
    bound_batches(docs.sparkSession)
    new = {*FIGURES, "groups_sha256", "n_best", "count_sum", "text"}
    kept = [c for c in docs.columns if c.lower() not in new]
    blocks = _settled_blocks(docs, a, b, kept)

    pairs = blocks.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("at", "p"))
    pairs = pairs.select("block", "at", F.col("p.pairs").alias("pair"), F.col("p.n_docs").alias("n"))
    counts = settle(pairs.groupBy("pair").agg(F.sum("n").alias("count")))
    a_id = F.shiftright("pair", 32).alias("a")
    best = counts.groupBy(a_id).agg(F.max("count").alias("best"))  # as many rows as the vocabulary has ids, at most
    judged = counts.select("*", a_id).join(F.broadcast(best), "a").select("pair", "count", (F.col("count") == F.col("best")).alias("is_best"))
    known = pairs.drop("n").join(judged, "pair").select(F.col("block").alias("of"), "at", "count", "is_best")

    held = blocks.drop("pairs", "n_docs")
    schema = T.StructType(
        [f for f in held.schema if f.name not in ("block", "words", "links", "ends")]
        + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        is_block = pc.is_valid(left.column("links"))
        block, rows = left.filter(is_block), left.filter(pc.invert(is_block))
        rows, block, found = (t.combine_chunks() for t in (rows, block, right))
        at = found.column("at").to_numpy()
        values = np.zeros((2, len(at)), np.int64)
        values[0][at], values[1][at] = found.column("is_best").to_numpy(), found.column("count").to_numpy()
        links = block.column("links").combine_chunks().flatten().to_numpy()
        ends = np.concatenate((np.zeros(1, np.int64), block.column("ends").combine_chunks().flatten().to_numpy()))
        words = rows.column("words").combine_chunks()
        starts = words.offsets.to_numpy().astype(np.int64)
        used = words.values.to_numpy()[starts[0] : starts[-1]]
        for field, value in zip(schema[-2:], values):
            rows = rows.append_column(field.name, pa.array(sums(sums(value[links], ends)[used], starts - starts[0])))
        return rows.select(schema.names)

    scored = held.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(score, schema)
    return scored.select("row.*", *schema.names[1:])
