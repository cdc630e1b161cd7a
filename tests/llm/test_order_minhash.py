import random

import numpy as np
import pytest

from chunkwright.llm import order_minhash as om
from chunkwright.llm.decontaminate import words_of

SCHEMA = "doc_id bigint, text string"


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[at] = f"e{rng.randrange(10**6)}"
        elif kind < 0.7:
            del words[at]
        else:
            words.insert(at, f"i{rng.randrange(10**6)}")
    return words


def family(seed, bases, copies, most):
    rng = random.Random(seed)
    rows = []
    for base in range(bases):
        words = [f"b{base}x{rng.randrange(400)}" for _ in range(rng.randint(30, 300))]
        rows.append(words)
        rows += [edited(rng, words, rng.randint(0, most)) for _ in range(copies)]
    rng.shuffle(rows)
    return [(k, " ".join(w)) for k, w in enumerate(rows)]


def labelled(text):
    words = words_of(text.encode())
    size = min(5, len(words))
    seen, out = {}, []
    for k in range(len(words) - size + 1):
        g = tuple(words[k : k + size])
        seen[g] = seen.get(g, 0) + 1
        out.append((g, seen[g]))
    return out


def aligned(a, b):
    """Longest common subsequence of labelled k-mers over all of them, by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
    return row[-1] / (len(a) + len(b) - row[-1]) if a and b else 0.0


def brute(rows, least):
    parent = {k: k for k, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    grams = {k: labelled(t) for k, t in rows}
    texts = {}
    for k, t in rows:
        words = tuple(words_of(t.encode()))
        if words:
            first = texts.setdefault(words, k)
            parent[max(root(k), root(first))] = min(root(k), root(first))
    ids = [k for k, _ in rows]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(set(grams[a]) & set(grams[b]))
            if common and common / (len(grams[a]) + len(grams[b]) - common) >= least:
                if aligned(grams[a], grams[b]) >= least - 1e-9:
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in ids}


@pytest.mark.parametrize("seed, bases, copies, most", [(1, 20, 3, 6), (2, 2, 60, 8), (3, 1, 80, 25)])
def test_classes_against_brute_force(spark, seed, bases, copies, most):
    rows = family(seed, bases, copies, most)
    found = {r.doc_id: r.class_id for r in om.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == brute(rows, 0.8)


def test_alignment_needs_order():
    words = np.arange(1, 401, dtype=np.uint64)
    a = om.kmers(words, 5)
    moved = om.kmers(np.concatenate((words[200:], words[:200])), 5)
    assert om.aligned(a, a, 0.8) == 1 and om.aligned(a, moved, 0.8) == 0
    shorter = om.kmers(words[:-30], 5)
    assert om.aligned(a, shorter, 0.8) == pytest.approx(366 / 396)
    assert om.aligned(a, shorter, 0.93) == 0


def test_repeated_kmers_are_told_apart():
    found = om.kmers(np.full(50, 7, np.uint64), 5)
    assert len(set(found.tolist())) == 46 and len(om.kmers(np.zeros(0, np.uint64), 5)) == 0
    assert len(om.kmers(np.ones(3, np.uint64), 5)) == 1


def test_odd_rows(spark, odd, empty):
    rows = om.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert found[1] == found[2] == found[3] == found[-3] == -3  # which holds nine tenths of them
    assert [found[k] for k in (4, 5, 6, 7, 8, 9, 10)] == [4, 5, 6, 7, 8, 9, 10]
    assert sorted(str(r.class_id) for r in rows if r.doc_id is None) == ["-3", "None"]
    assert om.near_duplicates(empty).count() == 0
    kept = om.keep_one(odd)
    assert kept.columns == odd.columns
    left = sorted(str(r.doc_id) for r in kept.collect())
    assert left == sorted(map(str, [None, None, -3, 4, 5, 6, 7, 7, 8, 9, 10]))


def test_connected_parts(spark):
    chain = [(k, k + 1) for k in range(1, 30)] + [(100, 103), (102, 103)]
    links = spark.createDataFrame([((a, 0), (b, 0)) for a, b in chain],
                                  "left struct<a bigint, b bigint>, right struct<a bigint, b bigint>")
    found = {r.node.a: r.label.a for r in om.connected(links).collect()}
    assert found == {**{k: 1 for k in range(1, 31)}, 100: 100, 102: 100, 103: 100}


def unique(name, count):
    return [f"{name}{k}" for k in range(count)]


def links_of(spark, texts, buckets):
    """Links between texts (number: words) that share the given buckets (lists of numbers)."""
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], SCHEMA)
    posts = [((k, 0), k, [b for b, members in enumerate(buckets) if k in members]) for k in texts]
    nodes = spark.createDataFrame(posts, "node struct<a bigint, b bigint>, doc_id bigint, sketches array<bigint>")
    return {tuple(sorted((r.left.a, r.right.a))) for r in om.find_links(docs, nodes, om.OrderSettings()).collect()}


def test_pair_of_a_small_bucket_still_gets_its_differences(spark):
    """1 and 3 share a small bucket at first; later 3 is the centre of the bucket where 1 has to meet 2."""
    body = unique("p", 200)
    texts = {1: body + unique("a", 3), 2: body + unique("b", 3), 3: body + unique("r3x", 60), 4: unique("z", 200)}
    texts |= {k: body + unique(f"o{k}x", 56) for k in range(5, 205)}
    buckets = [list(texts), [1, 3], [3, 4, *range(5, 15)], [4, *range(20, 25)]]
    assert links_of(spark, texts, buckets) == {(1, 2)}


def test_pair_that_lacks_a_passage_of_the_centre(spark):
    """1 and 2 have own headers and both lack 80 words of the centre 3, which is unlike either."""
    body = unique("p", 420)
    texts = {1: unique("a", 40) + body, 2: unique("b", 40) + body, 3: body + unique("r", 80)}
    texts |= {k: unique(f"o{k}x", 200) for k in range(5, 35)}
    buckets = [list(texts), [3, *range(5, 15)]]
    assert links_of(spark, texts, buckets) == {(1, 2)}


@pytest.mark.parametrize("seed", [1, 2])
def test_families_that_lack_a_passage_against_brute_force(spark, seed):
    rng, rows = random.Random(seed), []
    body, passage = unique("p", 105), unique("r", 20)
    rows += [edited(rng, body + passage, rng.randint(0, 1)) for _ in range(14)]
    rows += [unique(f"h{k}x", rng.randint(7, 11)) + body for k in range(16)]
    rng.shuffle(rows)
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    found = {r.doc_id: r.class_id for r in om.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == brute(rows, 0.8)


@pytest.mark.parametrize("seed, copies, most, block", [(4, 80, 25, 20), (5, 120, 12, 7)])
def test_buckets_of_several_blocks_against_brute_force(spark, monkeypatch, seed, copies, most, block):
    monkeypatch.setattr(om, "BLOCK", block)
    monkeypatch.setattr(om, "SMALL_BUCKET", 5)
    rows = family(seed, 1, copies, most)
    found = {r.doc_id: r.class_id for r in om.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == brute(rows, 0.8)


def test_links_of_a_block_connect_what_all_pairs_connect():
    rng, nprng = random.Random(9), np.random.default_rng(9)
    names = nprng.integers(1, 2**63, 2000).astype(np.uint64)
    base = [rng.randrange(1000) for _ in range(120)]
    found = []
    for _ in range(60):
        words = [w if rng.random() > rng.choice([0.005, 0.02, 0.04]) else rng.randrange(1000, 2000) for w in base]
        found.append(om.kmers(names[words], 5))
    left = np.array([k % 3 > 0 for k in range(60)])
    links = om.links_of_block(found, np.arange(60), left, 0.8)
    assert all(om.aligned(found[a], found[b], 0.8) for a, b in links) and len(links) < 60

    def parts(pairs):
        label = list(range(60))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return {frozenset(k for k in range(60) if label[k] == x) for x in label}

    pairs = [(a, b) for a in range(60) for b in range(a) if (left[a] or left[b]) and om.aligned(found[a], found[b], 0.8)]
    assert parts(links) == parts(pairs) and 1 < len(parts(pairs)) < 60


def test_copies_of_a_centre_are_settled_by_it(spark, monkeypatch):
    """A crowd in many buckets is linked to its centre and sent to no block; what is unlike the centre still meets all."""
    body, sent = unique("p", 200), []
    texts = {k: body + unique(f"o{k}x", 3) for k in range(40)} | {40: unique("q", 200), 41: unique("q", 199) + ["last"]}
    blocks = om._links_of_blocks
    monkeypatch.setattr(om, "_links_of_blocks", lambda rows, *rest: sent.append(rows.count()) or blocks(rows, *rest))
    assert len(links_of(spark, texts, [list(range(40))] * 20)) == 39 and sent == [0]
    assert len(links_of(spark, texts, [list(texts), *[list(range(40))] * 19])) == 40 and sent[1:] == [42]


def test_a_link_found_twice_is_followed_once(spark, monkeypatch):
    links = spark.createDataFrame([((a, 0), (a + 1, 0)) for a in (1, 2) for _ in range(50)],
                                  "left struct<a bigint, b bigint>, right struct<a bigint, b bigint>")
    written, settle = [], om.settle
    monkeypatch.setattr(om, "settle", lambda df: written.append(settle(df)) or written[-1])
    assert {r.label.a for r in om.connected(links).collect()} == {1} and written[0].count() == 4


def test_words_are_looked_up_once_for_all_buckets_of_a_node(spark):
    node = "node struct<a bigint, b bigint>"
    texts = spark.createDataFrame([((k, 0), bytes([k] * 4)) for k in range(3)], f"{node}, words binary")
    rows = [((k, 0), bucket, 0, column, k == 1, (k, 1)) for k in range(3) for bucket in range(40) for column in range(2)]
    schema = f"{node}, bucket bigint, row int, column int, wanted boolean, label struct<a bigint, b bigint>"
    members = spark.createDataFrame(rows, schema)
    found = om._with_words(members, texts)
    names = ["node", "bucket", "row", "column", "wanted", "label", "words"]
    same = members.join(texts, "node").select(*names).exceptAll(found.select(*names))
    assert found.count() == len(rows) and same.isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")  # rows are multiplied after the join only
