import random

import numpy as np
import pyarrow as pa
import pytest

from chunkwright.llm import recompression, repeats 
from chunkwright.llm.recompression import remove_repeated_words, word_scheme
from chunkwright.llm.suffix_dedup import byte_scheme, refined, remove_repeated_bytes

SCHEMA = "doc_id bigint, text string"


def brute(docs, size, same_text):
    """{doc_id: covered mask}; docs: {doc_id: list of tokens}."""
    first = {}
    for doc, tokens in docs.items():
        for k in range(len(tokens) - size + 1):
            place = (doc, k) if same_text else (doc,)
            window = tuple(tokens[k : k + size])
            first[window] = min(first.get(window, place), place)
    out = {}
    for doc, tokens in docs.items():
        gone = np.zeros(len(tokens), bool)
        for k in range(len(tokens) - size + 1):
            if first[tuple(tokens[k : k + size])] < ((doc, k) if same_text else (doc,)):
                gone[k : k + size] = True
        out[doc] = gone
    return out


def corpus(seed):
    """Few words, copied stretches, long runs: repeats of every kind."""
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(rng.choice([2, 5, 40]))]
    docs = []
    for k in range(40):
        words = rng.choices(pool, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            if docs:
                source = rng.choice(docs).split()
                a = rng.randint(0, max(len(source) - 1, 0))
                at = rng.randint(0, len(words))
                words[at:at] = source[a : a + rng.randint(0, 40)]
        if rng.random() < 0.3:
            words += [rng.choice(pool)] * rng.randint(1, 30)
        docs.append(rng.choice([" ", "\n", "  "]).join(words))
    ids = list(range(40))
    rng.shuffle(ids)
    return list(zip(ids, docs))


@pytest.mark.parametrize("seed, size", [(1, 13), (2, 13), (3, 5), (4, 30), (5, 1)])
def test_words(spark, seed, size):
    rows = corpus(seed)
    wanted = brute({k: t.split() for k, t in rows}, size, False)
    for r in remove_repeated_words(spark.createDataFrame(rows, SCHEMA).repartition(3), size).collect():
        words = dict(rows)[r.doc_id].split()
        assert r.n_words == len(words) and r.n_removed == wanted[r.doc_id].sum()
        assert r.kept == " ".join(w for w, g in zip(words, wanted[r.doc_id]) if not g)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = corpus(seed)
    wanted = brute({k: list(t.encode()) for k, t in rows}, 40, True)
    for r in remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA).repartition(3), 40, 12).collect():
        gone, text = wanted[r.doc_id], dict(rows)[r.doc_id].encode()
        assert r.n_bytes == len(text) and r.n_removed == gone.sum()
        assert r.n_spans == (np.diff(gone.astype(int), prepend=0) == 1).sum()
        assert bytes(r.kept) == bytes(b for b, g in zip(text, gone) if not g)


@pytest.mark.parametrize("operator", [remove_repeated_words, remove_repeated_bytes])
def test_frequent_anchors_change_nothing(spark, operator, monkeypatch):
    rows = [(k, f"a{k} b{k} c{k} " + "the one passage all share and more of it again so it is long enough to count "
             * 2 + f" d{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    usual = sorted(map(str, operator(docs).collect()))
    monkeypatch.setattr(repeats, "LOOK", 1)
    monkeypatch.setattr(repeats, "_frequent", lambda docs, scheme: np.sort(np.unique(np.concatenate(
        [scheme.runs(pa.array([t])).key.view(np.int64) for _, t in rows]))))
    assert sorted(map(str, operator(docs).collect())) == usual


def test_equal_stretches_pick_equal_symbols():
    rng = random.Random(5)
    for _ in range(200):
        shared = [rng.choice("abcd") for _ in range(13)]
        keys = []
        for _ in range(2):
            text = " ".join([*rng.choices("abcd", k=rng.randint(0, 9)), *shared, *rng.choices("abcd", k=rng.randint(0, 9))])
            runs = recompression._runs(pa.array([text]), 13)
            at = next(k for k in range(99) if text.split()[k : k + 13] == shared)
            found = [k for s, n, k in zip(runs.start, runs.n, runs.key) if s <= at < s + n]
            keys += found
        assert len(keys) == 2 and keys[0] == keys[1]


def test_refinement_names_equal_bytes_alike():
    data = np.frombuffer(b"abcabcabcabd" * 3, np.uint8).astype(np.uint64)
    for want in (1, 2, 3, 5, 7):
        names = refined(data, 1, want)
        for a in range(len(names)):
            for b in range(len(names)):
                same = bytes(data[a : a + want].astype(np.uint8)) == bytes(data[b : b + want].astype(np.uint8))
                assert (names[a] == names[b]) == same


def test_odd_rows(spark, odd, empty):
    words = {str(r.doc_id): r for r in remove_repeated_words(odd).collect()}
    texts = {r.doc_id: (r.text or "").split() for r in odd.collect() if r.doc_id is not None}
    wanted = brute(texts, 13, False)
    assert all(words[str(k)].n_removed == wanted[k].sum() for k in texts)
    assert words["1"].n_removed == 359  # what document -3 has as well
    assert words["2"].kept == "" and words["3"].kept == "tail"
    assert words["None"].n_removed == 0 and words["4"].n_words == 0 and words["4"].kept == ""
    assert words["8"].n_removed == 0 and words["9"].n_removed == 0
    found = {str(r.doc_id): r for r in remove_repeated_bytes(odd).collect()}
    assert found["2"].n_removed == found["2"].n_bytes and found["2"].n_spans == 1
    assert found["9"].n_removed == found["9"].n_bytes - 11  # the first round of the two words stays
    assert found["5"].n_bytes == 0 and bytes(found["4"].kept) == b""
    assert remove_repeated_words(empty).count() == remove_repeated_bytes(empty).count() == 0
    assert remove_repeated_words(odd).count() == odd.count()


def test_schemes_cut_what_they_count():
    text = b"a  b\tc d e f"
    assert word_scheme(2).cut(text, [(1, 2)]) == [b"b c d"]
    assert word_scheme(2).windows(b"b c d", 2) == [b"b c", b"c d"]
    assert byte_scheme(3, 2).windows(byte_scheme(3, 2).cut(text, [(0, 2)])[0], 2) == [b"a  ", b"  b"]
