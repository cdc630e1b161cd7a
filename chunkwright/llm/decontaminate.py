"""Benchmark decontamination with a generalised suffix automaton over the test items.

The items' words feed one automaton whose states stand for the word sequences that occur in
them. A document's words are streamed through it; after each word the state and length say how
long a suffix of the words read so far occurs in some item. A span is contaminated when that
length reaches ``window`` (length limit), or when it covers the whole of an item that has fewer
words than that (coverage limit).

The items are a stated query set and read in blocks of bounded size: every block is broadcast as
one automaton, and documents pass all of them in one scan, without any shuffle.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import NORMAL, add_columns, as_bytes

#: UTF-8 bytes of item text in one automaton; the only thing that is broadcast.
BLOCK_BYTES = 2 << 20
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; none for null."""
    return text.translate(NORMAL).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, with the items behind each window."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        shortest = window
        for _, text in items:
            word_ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            if not word_ids:
                continue
            state = 0
            for word in word_ids:
                state = self._extend(state, word)
            shortest = min(shortest, len(word_ids))
        self.shortest = shortest
        # States are split while items are added, so marks are set in a second walk.
        owners: dict[int, set] = {}
        whole: dict[int, set] = {}
        for name, text in items:
            state, n = 0, 0
            for word in words_of(text):
                state, n = self.next[state][self.vocab[word]], n + 1
                owners.setdefault(state, set()).add(name)
            if 0 < n < window:
                whole.setdefault(state, set()).add(name)
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for state in reversed(by_length):
            up = self.link[state]
            if self.length[up] >= window:
                owners.setdefault(up, set()).update(owners.get(state, ()))
        #: Per state: the suffix state that holds its last ``window`` words, and the nearest whole short item.
        self.at_window, self.at_whole = [0] * len(self.link), [0] * len(self.link)
        for state in by_length:
            up = self.link[state]
            if self.length[state] >= window:
                self.at_window[state] = self.at_window[up] if self.length[up] >= window else state
            self.at_whole[state] = state if state in whole else self.at_whole[up]
        self.owners = {s: frozenset(owners[s]) for s in set(self.at_window) - {0}}
        self.whole = {s: frozenset(v) for s, v in whole.items()}

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._split(last, word, q)
        new = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        """The shorter sequences of ``q`` move to a state of their own."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(link)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = copy
            p = link[p]
        return copy

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Contaminated spans [start, end) in words, merged and in order, and the items they come from.

        An unknown word sets the matching length to 0, so only stretches of known words are walked.
        """
        found: list[tuple[int, int]] = []
        names: set = set()
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, len(words))
        known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
        edges = np.flatnonzero(np.diff(known))
        starts, ends = edges[::2], edges[1::2]
        long_enough = ends - starts >= self.shortest
        for first, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist()):
            self._walk(ids[first:end].tolist(), first, found, names)
        merged: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged, names

    def _walk(self, ids: list[int], at: int, found: list, names: set) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for word in ids:
            at += 1
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word not in nxt[state]:
                continue
            state = nxt[state][word]
            matched += 1
            if matched >= window:
                found.append((at - window, at))
                names |= self.owners[self.at_window[state]]
            if self.whole:
                # The state's own sequence counts only if all of it has been matched.
                hit = self.at_whole[state if matched == length[state] else link[state]]
                if hit:
                    found.append((at - length[hit], at))
                while hit:
                    names |= self.whole[hit]
                    hit = self.at_whole[link[hit]]


def _blocks(items: DataFrame, block_bytes: int):
    """The items, block by block; the driver holds one block at a time."""
    rows = items.select(
        F.col("item_id").cast("string").alias("name"), F.col("text").cast("binary").alias("text")
    ).filter("length(text) > 0")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = math.ceil(total / block_bytes)
    for k in range(count):
        part = rows if count == 1 else rows.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == k)
        yield [(r.name, bytes(r.text)) for r in part.toLocalIterator()]


FOUND = "n_words bigint, spans array<int>, item_ids array<string>"


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Every row of ``docs`` (``text``) with ``n_words``, ``spans`` and ``item_ids``.

    ``spans`` is a flat array of word positions (start, end, start, end, ...), merged and in order;
    ``item_ids`` the items whose window or whole text occurs, as sorted strings. Null and empty
    texts have no words and no spans. Items without words match nothing; an item without an id
    marks words but is not listed. Repeated rows each get their own result. Input columns named
    like the new ones are replaced, others kept.
    """
    return _through_blocks(docs, items, window, block_bytes, FOUND, lambda batch, found: found)


def _through_blocks(docs: DataFrame, items: DataFrame, window: int, block_bytes: int, fields: str, finish) -> DataFrame:
    """``docs`` past one block of items after the other; ``finish`` turns the last one's findings into ``fields``."""
    context = docs.sparkSession.sparkContext
    blocks = _blocks(items, block_bytes)
    block, first, out = next(blocks, []), True, docs
    while block is not None:
        following = next(blocks, None)
        shared = context.broadcast(Automaton(block, window))

        def compute(batch: pa.RecordBatch, shared=shared, first=first, last=following is None) -> list:
            found = _search(batch, shared.value, first)
            return finish(batch, found) if last else found

        out = add_columns(out, fields if following is None else FOUND, compute)
        block, first = following, False
    return out


def _search(batch: pa.RecordBatch, automaton: Automaton, first: bool) -> list:
    counts, spans, names = [], [], []
    before = repeat(([], ()))
    if not first:
        before = zip(batch.column("spans").to_pylist(), batch.column("item_ids").to_pylist())
    for text, (old, known) in zip(as_bytes(batch.column("text")), before):
        words = words_of(text)
        found, hits = automaton.spans(words)
        counts.append(len(words))
        spans.append(_merged(old, found))
        names.append(sorted({*known, *(h for h in hits if h is not None)}))
    return [
        pa.array(counts, pa.int64()),
        pa.array(spans, pa.list_(pa.int32())),
        pa.array(names, pa.list_(pa.string())),
    ]


def _merged(old: list[int], found: list[tuple[int, int]]) -> list[int]:
    spans = sorted([*zip(old[::2], old[1::2]), *found]) if old else found
    out: list[int] = []
    for a, b in spans:
        if out and a <= out[-1]:
            out[-1] = max(b, out[-1])
        else:
            out += (a, b)
    return out


def remove_contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.8
) -> DataFrame:
    """``docs`` without the contaminated words.

    A document with more than ``max_coverage`` of its words in contaminated spans goes as a whole;
    from others the spans are cut, from the first letter of a span to its last, so that what stood
    around them stays. Documents without a span, null and empty ones included, stay as they are.
    """

    def cleaned(batch: pa.RecordBatch, found: list) -> list:
        texts, covered = [], []
        for text, spans in zip(as_bytes(batch.column("text")), found[1].to_pylist()):
            covered.append(sum(spans[1::2]) - sum(spans[::2]))
            if spans:
                at = [m.span() for m in _WORD.finditer(text.translate(NORMAL))]
                keep, done = [], 0
                for a, b in zip(spans[::2], spans[1::2]):
                    keep.append(text[done : at[a][0]])
                    done = at[b - 1][1]
                text = b"".join([*keep, text[done:]])
            texts.append(text)
        return [*found, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(covered, pa.int64())]

    fields = f"{FOUND}, text string, _n_hit bigint"
    # Columns of the input with the names of findings step aside meanwhile.
    aside = {c: f"_own_{c}" for c in docs.columns if c.lower() in ("n_words", "spans", "item_ids", "_n_hit")}
    out = _through_blocks(docs.withColumnsRenamed(aside), items, window, BLOCK_BYTES, fields, cleaned)
    kept = out.filter(F.col("_n_hit") <= max_coverage * F.col("n_words"))
    return kept.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))
