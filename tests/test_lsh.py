"""Approximate pairs against all pairs."""

import numpy as np
import pytest

from chunkwright.operators import lsh
from chunkwright.operators.cells import unit_rows
from chunkwright.operators.lsh import bands_for, bits_for, pairs_lsh
from chunkwright.options import Options
from test_vectors import crowd, frame, sims_of


def later(vectors, limit):
    sims = sims_of(vectors)
    return {j for j in range(len(vectors)) if any(sims[i, j] >= limit for i in range(j))}


@pytest.mark.parametrize("bits, group", [(None, 4096), (2, 16), (10, 16)])
def test_finds_what_the_miss_chance_says(spark, monkeypatch, bits, group):
    monkeypatch.setattr(lsh, "GROUP_ROWS", group)  # large buckets in many blocks
    vectors = np.concatenate([crowd(1), crowd(2), np.zeros((2, 8))])
    sims = sims_of(vectors)
    got = pairs_lsh(frame(spark, vectors), Options(duplicate_cosine=0.97, block_rows=16), bits, miss=1e-6).collect()
    for r in got:
        assert r.left_ord < r.right_ord and sims[r.left_ord, r.right_ord] >= 0.97 - 1e-9
        assert r.sim == pytest.approx(sims[r.left_ord, r.right_ord], abs=1e-9)
    found = [r.right_ord for r in got]
    assert len(found) == len(set(found)) and set(found) == later(vectors, 0.97)


def test_recall_follows_the_miss_chance(spark):
    rng = np.random.default_rng(3)
    base = unit_rows(rng.normal(size=(400, 32)))
    side = unit_rows(rng.normal(size=(400, 32)))
    side = unit_rows(side - (side * base).sum(axis=1)[:, None] * base)
    vectors = np.concatenate([base, 0.9001 * base + np.sqrt(1 - 0.9001**2) * side])  # pairs just at the limit
    options = Options(duplicate_cosine=0.9)
    recall = {}
    for miss in (0.5, 0.02):
        found = {r.right_ord for r in pairs_lsh(frame(spark, vectors), options, 8, miss).collect()}
        recall[miss] = len(found) / 400
    assert 0.35 < recall[0.5] < 0.7 and recall[0.02] >= 0.95


def test_a_crowd_is_settled_by_its_representatives(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=8) + 0.001 * rng.normal(size=(3000, 8))
    sent = []
    plain = lsh._compared
    monkeypatch.setattr(lsh, "_compared", lambda k, b, o, t: sent.append(o.count()) or plain(k, b, o, t))
    found = pairs_lsh(frame(spark, vectors), Options(duplicate_cosine=0.98), 12, 1e-3)
    assert found.count() == 2999 and sent[0] < 10  # rows that still have to be compared


def test_empty_and_parameters(spark):
    none = spark.createDataFrame([(1, None), (2, [])], "ord bigint, embedding array<double>")
    assert pairs_lsh(none, Options()).count() == 0
    assert bands_for(1.0, 10, 1e-3) == 1 and bands_for(0.98, 16, 1e-3) > bands_for(0.98, 16, 1e-1)
    assert bits_for(1) == 4 and bits_for(1 << 30) == 26
