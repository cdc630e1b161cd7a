import hashlib
import random

import numpy as np
import pytest

from chunkwright.llm import pivot_clusters as pc
from chunkwright.llm.pivot_clusters import choose_pivots, cluster, nearest


def brute(rows, width, scale, clusters, rounds):
    """Plain Python over (key, vector): (labels, distances, centroids) of the usable rows, in order."""
    from fractions import Fraction

    used = [
        (k, [int(Fraction(float(x)) * scale // 1) for x in v])
        for k, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"2:{k}".encode()).hexdigest(), q) for k, q in used if k is not None]
    centres = [q for _, q in sorted(named)][:clusters]

    def assign():
        out = []
        for _, q in used:
            best = min((sum((a - b) ** 2 for a, b in zip(q, c)), i) for i, c in enumerate(centres))
            out.append(best)
        return out

    for _ in range(rounds):
        got = assign()
        for i in range(len(centres)):
            mine = [q for (_, q), (_, j) in zip(used, got) if j == i]
            if mine:
                centres[i] = [sum(x) // len(mine) for x in zip(*mine)]
    return [k for k, _ in used], assign(), centres


def rows_of(kind, seed=3):
    rng = random.Random(seed)
    if kind == "crowds":
        middle = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(5)]
        return [(i, [x + rng.gauss(0, 0.05) for x in middle[i % 5]]) for i in range(200)]
    if kind == "ties":
        return [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(150)]
    if kind == "large":
        return [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randint(3, 9) for _ in range(3)]) for i in range(60)]
    return [(i, [0.5, 0.25, -0.125]) for i in range(50)]


@pytest.mark.parametrize("kind", ["crowds", "ties", "large", "same"])
def test_against_brute_force(spark, kind):
    rows = rows_of(kind)
    rows += [(900, None), (901, [1.0, 2.0]), (902, [1.0, None, 2.0]), (903, [float("nan"), 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    assigned, centres = cluster(df, width=3, clusters=7, rounds=3)
    keys, want, middle = brute(rows, 3, 256, 7, 3)
    got = {r.vec_id: (r.distance, r.cluster) for r in assigned.collect()}
    assert got == {k: (d if d <= pc.LONGEST else None, c) for k, (d, c) in zip(keys, want)}
    assert {r.cluster: r.centroid for r in centres.collect()} == dict(enumerate(middle))


def test_fewer_rows_than_clusters_empty_and_clashing_names(spark):
    names = "vec_id bigint, embedding array<float>, cluster string, ints int, away int, row int, n int, hash string, s0 int"
    df = spark.createDataFrame([(1, [1.0, 0.0], "x", 1, 2, 3, 4, "h", 5), (None, [0.0, 1.0], "y", 1, 2, 3, 4, "h", 5)] * 2, names)
    assigned, centres = cluster(df, width=2, clusters=9, rounds=2)
    assert assigned.columns == ["vec_id", "embedding", "ints", "away", "row", "n", "hash", "s0", "cluster", "distance"]
    found = assigned.collect()
    assert len(found) == 4 and {r.distance for r in found} == {0} and {(r.ints, r.away, r.row, r.s0) for r in found} == {(1, 2, 3, 5)}
    assert centres.count() == 4
    assigned, centres = cluster(df.limit(0), width=2)
    assert assigned.count() == 0 and centres.count() == 0


def test_pivots_spare_most_distances():
    rng = np.random.default_rng(5)
    middle = rng.integers(-500, 500, (30, 16))
    x = (middle[rng.integers(0, 30, 4000)] + rng.integers(-20, 20, (4000, 16))).astype(np.int64)
    pivots = choose_pivots(middle, 8)
    away = pc._distances(x, pivots)
    label, best, taken = nearest(x, away, middle, pivots)
    full = ((x[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (label == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert taken < 0.2 * 30 * 4000
