import math

import numpy as np
import pytest

from chunkwright.llm import sharding
from chunkwright.llm.sharding import communication_matrix, shard_sizes, shuffle_to_shards


def check(rows, shards, total):
    sizes = {}
    for r in rows:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, sizes.values())) == total
    assert all(sorted(v) == list(range(len(v))) for v in sizes.values())
    assert [len(sizes.get(s, [])) for s in range(shards)] == shard_sizes(total, shards).tolist()


@pytest.mark.parametrize("rows, shards", [(0, 3), (1, 3), (7, 3), (1000, 16)])
def test_exact_sizes(spark, rows, shards):
    out = shuffle_to_shards(spark.range(rows).withColumnRenamed("id", "Slot").selectExpr("*", "1 AS x"), shards, 1, 50)
    check(out.collect(), shards, rows)


def test_odd_rows(spark, odd):
    first = shuffle_to_shards(odd, 4, 3).collect()
    check(first, 4, odd.count())
    assert sorted(map(str, first)) == sorted(map(str, shuffle_to_shards(odd.repartition(5), 4, 3).collect()))
    assert sorted(str(r.doc_id) for r in first) == sorted(str(r.doc_id) for r in odd.collect())


def test_matrix_has_both_sums_and_the_right_mean():
    total = np.zeros((3, 2))
    for seed in range(400):
        matrix = communication_matrix([10, 0, 30], np.array([15, 25]), seed)
        assert matrix.sum(axis=1).tolist() == [10, 0, 30] and matrix.sum(axis=0).tolist() == [15, 25]
        total += matrix
    assert abs(total[0, 0] / 400 - 10 * 15 / 40) < 0.3


def test_every_row_reaches_every_shard(spark):
    hits = np.zeros((20, 4))
    for seed in range(30):
        for r in shuffle_to_shards(spark.range(20).coalesce(1), 4, seed, 7).collect():
            hits[r.id, r.shard] += 1
    assert hits.min() > 0


@pytest.mark.parametrize("good, bad, taken", [(5, 7, 4), (30, 3, 20), (1, 1, 1), (40, 60, 50)])
def test_inverted_draw_has_the_exact_law(good, bad, taken):
    """Every chance is mapped to a count; the share of chances per count is its probability."""
    chances = (np.arange(4000) + 0.5) / 4000
    found = np.bincount([sharding._inverted(c, good, bad, taken) for c in chances], minlength=taken + 1) / 4000
    ways = [math.comb(good, k) * math.comb(bad, taken - k) / math.comb(good + bad, taken) for k in range(taken + 1)]
    assert np.abs(found - ways).max() < 1e-3


def test_draws_beyond_what_the_generator_takes(monkeypatch):
    monkeypatch.setattr(sharding, "LARGE", 1)
    for seed in range(50):
        matrix = communication_matrix([10, 0, 30], np.array([15, 25]), seed)
        assert matrix.sum(axis=1).tolist() == [10, 0, 30] and matrix.sum(axis=0).tolist() == [15, 25]
    rng = np.random.default_rng(1)
    many = [sharding._draw(rng, 10**11, 15 * 10**11, 2000) for _ in range(2000)]
    assert abs(np.mean(many) - 125) < 1.5 and abs(np.std(many) - 10.8) < 0.8
