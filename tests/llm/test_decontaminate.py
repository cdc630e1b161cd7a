import random

import pytest

from chunkwright.llm.decontaminate import Automaton, find_contamination, remove_contamination, words_of

ITEM = "item_id bigint, text string"


def brute(words, items, window):
    hit, names = set(), set()
    for name, text in items:
        item = words_of(text)
        n = min(window, len(item))
        wanted = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if item else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in wanted:
                hit |= set(range(k, k + n))
                names.add(name)
    return hit, names


@pytest.mark.parametrize("seed", range(6))
def test_automaton_against_brute_force(seed):
    rng = random.Random(seed)
    letters = [c.encode() for c in "abc"]
    items = [(str(k), b" ".join(rng.choices(letters, k=rng.randint(0, 9)))) for k in range(8)]
    automaton = Automaton(items, 4)
    for _ in range(60):
        words = rng.choices([*letters, b"z"], k=rng.randint(0, 40))
        spans, names = automaton.spans(words)
        hit, wanted = brute(words, items, 4)
        assert {p for a, b in spans for p in range(a, b)} == hit
        assert names == wanted
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_words_are_lowered_in_ascii_only():
    assert words_of("Ünder-SCORE_9 É".encode()) == ["Ünder".encode(), b"score", b"9", "É".encode()]


def test_blocks_and_odd_rows(spark, odd):
    rows = [(1, "w1 w4 w9 w16 w25 w36 w49 w64 w81 w100 w121"), (2, None), (3, "..."), (None, "X"), (5, "same same")]
    items = spark.createDataFrame(rows, ITEM)
    docs = odd.withColumnRenamed("lang", "Spans")
    one = find_contamination(docs, items, 10).drop("Spans").collect()
    many = find_contamination(docs, items, 10, block_bytes=16).drop("Spans").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))
    found = {r.doc_id: r for r in find_contamination(odd, items, 10).collect() if r.doc_id}
    assert found[1].spans == [1, 12] and found[1].item_ids == ["1"]
    assert found[4].spans == [] and found[4].n_words == 0
    assert found[7].spans == [0, 1] and found[7].item_ids == []
    assert found[8].spans == [0, 60] and found[8].item_ids == ["5"]


def test_removal(spark, odd, empty):
    items = spark.createDataFrame([(1, "w1 w4 w9 w16 w25 w36 w49 w64 w81 w100"), (2, "same same")], ITEM)
    out = remove_contamination(odd.withColumnRenamed("source", "spans"), items)
    assert out.columns == ["doc_id", "text", "lang", "spans", "n_chars"] and out.filter("spans = 'd'").count() == 1
    kept = {r.doc_id: r.text for r in out.collect()}
    assert 8 not in kept and kept[4] is None and kept[5] == "" and kept[6] == " \n\t "
    assert kept[1].startswith("w0  w121 ")
    assert remove_contamination(empty, items).count() == 0
    assert remove_contamination(odd, items.limit(0)).count() == odd.count()
