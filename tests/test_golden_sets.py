"""Sets of golden chunks: who is in them, what stands next to them, and that ``comparison`` is asked."""

from dataclasses import replace

import numpy as np
import pytest

from chunkwright.operators import golden_sets as gs
from chunkwright.operators.neighbors import search_strategy
from chunkwright.options import Options
from chunkwright.plans.testset import build_testset
from test_vectors import sims_of

SCHEMA = "ord bigint, doc_id string, chunk_id string, chunk_text string, embedding array<double>"


def chunks(spark, seed=1):
    rng = np.random.default_rng(seed)
    sizes = [1, 2, 3, 4, 7, 40]
    docs = [f"d{i}" for i, n in enumerate(sizes) for _ in range(n)]
    vectors = rng.normal(size=(len(docs), 6))
    own = ["".join("abcdefgh"[int(c)] for c in f"{i:03o}") for i in range(len(docs))]
    words = [f"apple{o} apple{o} quince{o} plum{o[::-1]} common text" for o in own]
    rows = [(i, d, f"c{i}", words[i], [float(x) for x in vectors[i]]) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), docs, vectors


@pytest.mark.parametrize("at_once", [10_000, 8])
def test_sets_hold_every_chunk_once(spark, monkeypatch, at_once):
    monkeypatch.setattr(gs, "_ROWS_AT_ONCE", at_once)  # a long document in parts
    df, docs, _ = chunks(spark)
    sets = {}
    for r in gs.golden_sets(df, Options(golden_chunks=3)).collect():
        sets.setdefault(r.bundle_id, []).append(r.ord)
    assert sorted(o for s in sets.values() for o in s) == list(range(len(docs)))
    for first, members in sets.items():
        assert first in members and len({docs[o] for o in members}) == 1 and len(members) <= 5
        assert len(members) >= 3 or docs.count(docs[first]) < 3 or at_once == 8
    some = gs.golden_sets(df, Options(golden_chunks=3, sample_rate=0.5)).select("bundle_id").distinct().count()
    assert some == max(1, int(len(sets) * 0.5))


def test_neighbors_of_a_set_against_all_rows(spark):
    df, docs, vectors = chunks(spark)
    options = Options(golden_chunks=2, sample_rate=0.5)
    sets = gs.golden_sets(df, options)
    members = {}
    for r in sets.collect():
        members.setdefault(r.bundle_id, []).append(r.ord)
    got = {}
    for r in gs.set_neighbors(sets, df, df, 4, options, search_strategy("exact")).collect():
        got.setdefault(r.golden_ord, []).append((r.rank, r.ord))
    sims = sims_of(vectors)
    for bundle, inside in members.items():
        order = sorted((-max(sims[m, o] for m in inside), o) for o in range(len(docs)) if o not in inside)
        assert [o for _, o in sorted(got[bundle])] == [o for _, o in order[:4]]


def test_a_run_asks_for_comparisons(spark):
    df, docs, _ = chunks(spark)
    options = Options(golden_chunks=2, min_tokens=1, query_types=("factual", "comparison"), num_distractors=2)
    result = build_testset(df, options, mode="none")
    requests = result.requests.collect()
    sizes = {r.bundle_id: len(r.golden) for r in requests}
    asked = {r.bundle_id for r in requests if r.query_type == "comparison"}
    assert asked == {b for b, n in sizes.items() if n > 1} and len(asked) < len(sizes)
    for r in requests:
        ids = [g.chunk_id for g in r.golden]
        assert [int(i[1:]) for i in ids] == sorted(int(i[1:]) for i in ids)
        assert not set(ids) & {d.chunk_id for d in r.distractors}
    truth = result.ground_truth.collect()
    assert truth and all(len(t.expected_doc_ids) == 1 for t in truth)
    assert max(len(t.context_chunks) for t in truth) >= 2


def test_one_golden_chunk_is_as_before_and_none_is_refused(spark):
    with pytest.raises(ValueError):
        Options(golden_chunks=0)
    df, _, _ = chunks(spark)
    plain = build_testset(df, replace(Options(min_tokens=1), sample_rate=0.2))
    assert all(len(r.golden) == 1 for r in plain.requests.collect())
