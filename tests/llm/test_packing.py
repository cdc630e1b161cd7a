import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from chunkwright.llm import packing
from chunkwright.llm.packing import Index, deal, fill, pack, powers, sketches
from chunkwright.llm.queries import BYTE_MODEL
from chunkwright.llm.sentencepiece import share_model


@pytest.fixture(scope="module")
def model(spark):
    return share_model(spark.range(1), BYTE_MODEL)


def encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_MODEL).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, window):
    """All ids of all documents once, sequences without gaps, full or powers of two; ``texts`` by doc_id, repeated rows allowed."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for key, copies in texts.items():
        wanted = Counter(tuple(encoded(t)) for t in copies)
        got = Counter()
        at = defaultdict(list)
        for start, ids, total in by_doc[key]:
            for i, token in enumerate(ids):
                at[total].append((start + i, token))
        for total, pairs in at.items():
            copies = len(pairs) // total
            assert sorted(p for p, _ in pairs) == sorted(list(range(total)) * copies)
            if copies == 1:
                got[tuple(t for _, t in sorted(pairs))] += 1
            else:
                got += Counter({tuple(t for _, t in sorted(set(pairs))): copies})
        assert got == wanted
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == window or end & (end - 1) == 0 and end < window


def test_odd_rows_and_empty(spark, odd, empty, model):
    docs = odd.withColumnsRenamed({"lang": "Start", "source": "sketch"}).selectExpr("*", "1 AS uid", "2 AS shard", "3 AS first")
    out = pack(docs.repartition(3), model, window=256, shard_tokens=2000)
    assert out.columns == ["doc_id", "sketch", "n_chars", "uid", "shard", "first", *"start length ids doc_tokens sequence_id offset".split()]
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r.doc_id].append(r.text)
    check(out.collect(), texts, 256)
    assert pack(empty, model).count() == 0


@pytest.mark.parametrize("shard", [500, 1 << 20])
def test_all_ids_once(spark, model, shard):
    rng = random.Random(4)
    topics = [[f"{t}{rng.randint(0, 999)}" for _ in range(30)] for t in "abcdef"]
    texts = [" ".join(rng.choices(rng.choice(topics), k=rng.choice([3, 20, 60, 900]))) for _ in range(120)] + ["same text"] * 80
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    rows = pack(docs, model, window=128, shard_tokens=shard).collect()
    check(rows, {i: [t] for i, t in enumerate(texts)}, 128)
    total = sum(r.length for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    full = sum(n for n in sizes.values() if n == 128)
    assert shard == 500 or full > 0.98 * total
    again = pack(docs, model, window=128, shard_tokens=shard).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_scores_are_bm25():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 40, rng.integers(1, 30)) for _ in range(25)]
    lengths = np.array([len(d) for d in docs])
    index = Index(np.concatenate(docs).astype(np.int64), lengths)
    held = Counter(t for d in docs for t in set(d.tolist()))
    for seed in (0, 7):
        for i, d in enumerate(docs):
            want = 0.0
            for t in set(docs[seed].tolist()):
                tf = int((d == t).sum())
                rare = max(0.0, math.log((25 - held[t] + 0.5) / (held[t] + 0.5)))
                want += rare * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / lengths.mean()))
            assert index.scores(seed)[i] == pytest.approx(want)


def test_a_window_takes_the_best_unused_neighbours():
    one, two = np.arange(10), np.arange(100, 110)
    docs = [one, two, np.append(one[:6], 50), np.append(two[:6], 150), one[:2], two[:2]]
    docs += [np.arange(200 + 10 * i, 203 + 10 * i) for i in range(8)]
    lengths = np.array([len(d) for d in docs])
    found = fill(lengths, Index(np.concatenate(docs), lengths), 19)
    first = [d for d, _, _, s, _ in found if s == 0]
    second = [d for d, _, _, s, _ in found if s == 1]
    assert first == [0, 2, 4] and second == [1, 3, 5]


def test_powers_deal_and_sketches():
    parts = list(powers([(0, 5, 7), (1, 0, 4)]))
    assert [sum(n for _, _, n in p) for p in parts] == [8, 2, 1]
    assert [x for p in parts for x in p] == [(0, 5, 7), (1, 0, 1), (1, 1, 2), (1, 3, 1)]
    assert deal([(3, 10), (1, 40), (2, 70), (9, 350), (12, 5)], 100) == [(1, 0, 1), (2, 1, 1), (3, 1, 1), (9, 2, 4), (12, 6, 1)]
    ids = np.array([5, 6, 7, 5, 6, 7, 8])
    got = sketches(ids, np.array([0, 3, 6, 7]), 100)
    assert got[0] == got[1] and 0 <= got.min() and got.max() < 1 << packing.SKETCH_BITS
