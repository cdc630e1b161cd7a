"""Vector operators against plain numpy on hand-made and random rows."""

from dataclasses import replace

import numpy as np
import pytest

from chunkwright.operators import cells, duplicates, neighbors, vector_index
from chunkwright.operators.cells import unit_rows
from chunkwright.options import Options
from chunkwright.session import fresh_dir, settle

SCHEMA = "ord bigint, embedding array<double>"


def frame(spark, vectors, parts=3):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def ords(df):
    return sorted(r["ord"] for r in df.collect())


def sims_of(vectors):
    unit = unit_rows(np.asarray(vectors, dtype=float))
    return np.round(unit @ unit.T, 10)


def serial(vectors, limit, greedy):
    sims, kept = sims_of(vectors), []
    for j in range(len(vectors)):
        earlier = kept if greedy else range(j)
        if not any(sims[i, j] >= limit for i in earlier):
            kept.append(j)
    return kept


def crowd(seed, rows=300, dim=8):
    """A third of the rows in one dense crowd, a third copies of one vector, the rest anywhere."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    near = centre + 0.12 * rng.normal(size=(rows // 3, dim))
    same = np.tile(rng.normal(size=dim), (rows // 3, 1)) * rng.choice([1, 2, 4], size=(rows // 3, 1))
    far = rng.normal(size=(rows // 3, dim))
    vectors = np.concatenate([near, same, far])
    rng.shuffle(vectors)
    return vectors


SMALL = Options(block_rows=16, max_pivots=12)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("policy", ["any_earlier", "greedy"])
def test_dedup_equals_serial_scan(spark, seed, policy):
    vectors = crowd(seed)
    options = replace(SMALL, duplicate_policy=policy, duplicate_cosine=0.98)
    kept = (duplicates.dedup_greedy if policy == "greedy" else duplicates.dedup_any_earlier)(
        frame(spark, vectors), options
    )
    assert ords(kept) == serial(vectors, 0.98, policy == "greedy")


def test_chain_differs_by_policy(spark):
    angles = np.radians([0, 10, 20])
    chain = np.column_stack([np.cos(angles), np.sin(angles)])
    assert ords(duplicates.dedup_any_earlier(frame(spark, chain), Options())) == [0]
    assert ords(duplicates.dedup_greedy(frame(spark, chain), Options())) == [0, 2]


def test_rows_without_direction_are_kept(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, 0.0])], SCHEMA)
    assert ords(duplicates.dedup_any_earlier(df, Options())) == [0, 1, 2, 3]


@pytest.mark.parametrize("options", [Options(), SMALL])
def test_pairs_name_the_earliest_match(spark, options):
    vectors = crowd(3, rows=150)
    sims = sims_of(vectors)
    options = replace(options, duplicate_cosine=0.9)
    found = {(r["left_ord"], r["right_ord"]) for r in duplicates.near_duplicate_pairs(frame(spark, vectors), options).collect()}
    earlier = {j: [i for i in range(j) if sims[i, j] >= 0.9] for j in range(len(vectors))}
    assert found == {(i[0], j) for j, i in earlier.items() if i}


@pytest.mark.parametrize("scale", [1.0, 2.0, 3.0])
def test_copies_of_any_scale_are_pairs_with_the_first(spark, scale):
    vector = np.array([0.1, 0.7, 0.3])
    pairs = duplicates.near_duplicate_pairs(frame(spark, np.array([vector, vector * scale, vector, vector * scale])), Options())
    assert sorted((r["left_ord"], r["right_ord"]) for r in pairs.collect()) == [(0, 1), (0, 2), (0, 3)]


@pytest.mark.parametrize("options", [Options(), SMALL])
@pytest.mark.parametrize("limit", [0.3, 0.98, 1.0, -0.2])
def test_every_pair_is_found(spark, options, limit):
    vectors = np.concatenate([crowd(3, rows=150), np.zeros((3, 8))])
    sims = sims_of(vectors)
    found = duplicates.near_duplicate_pairs(frame(spark, vectors), replace(options, duplicate_cosine=limit), every=True).collect()
    pairs = {(r["left_ord"], r["right_ord"]): r["sim"] for r in found}
    left, right = np.nonzero(np.triu(sims >= limit, 1))
    assert len(found) == len(pairs) and set(pairs) == set(zip(left.tolist(), right.tolist()))
    assert all(sim == pytest.approx(sims[pair], abs=1e-9) for pair, sim in pairs.items())


def test_registered_pairs_are_all_pairs(spark, tmp_path):
    from registry.queries import QUERIES

    vectors = np.ones((4, 3)).tolist()
    spark.createDataFrame([(i, "a text", "de") for i in range(4)], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["cosine_matrix_join"](spark, str(tmp_path)).count() == 6
    assert QUERIES["near_duplicate_pairs"](spark, str(tmp_path)).count() == 28  # each once more, twice as long


@pytest.mark.parametrize("options", [Options(), replace(SMALL, broadcast_rows=1)])
def test_knn_is_exact_on_both_routes(spark, options):
    vectors = crowd(4, rows=150)
    sims = sims_of(vectors)
    df = frame(spark, vectors)
    golden = df.filter("ord < 90")
    got = {}
    for r in neighbors.knn_join(golden, df, 4, options).collect():
        got.setdefault(r["golden_ord"], {})[r["rank"]] = r["ord"]
    for g in range(90):
        order = sorted((j for j in range(len(vectors)) if j != g), key=lambda j: (-sims[g, j], j))
        assert [got[g][rank] for rank in (1, 2, 3, 4)] == order[:4]


def test_knn_with_fewer_rows_than_asked(spark):
    df = frame(spark, [[1, 0], [0, 1]])
    rows = neighbors.knn_join(df, df, 3, Options()).collect()
    assert {(r["golden_ord"], r["ord"], r["rank"]) for r in rows} == {(0, 1, 1), (1, 0, 1)}
    assert neighbors.knn_join(df.filter("ord > 9"), df, 3, Options()).count() == 0


def test_ivf_recall_and_exactness(spark):
    vectors = np.random.default_rng(5).normal(size=(400, 6))
    df = frame(spark, vectors)
    exact = {(r["golden_ord"], r["ord"]) for r in neighbors.knn_join(df, df, 3, Options()).collect()}

    def found(nprobe):
        options = Options(ivf_nlist=12, ivf_nprobe=nprobe)
        return {(r["golden_ord"], r["ord"]) for r in neighbors.knn_ivf(df, df, 3, options).collect()}

    assert found(12) == exact
    assert len(found(4) & exact) / len(exact) > 0.6  # as many cells as named, whatever they yield


def test_saved_index_reaches_the_recall_asked_for(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(20, 8))
    vectors = centre[rng.integers(0, 20, 900)] + 0.4 * rng.normal(size=(900, 8))
    df = frame(spark, vectors)
    exact = {(r["golden_ord"], r["ord"]) for r in neighbors.knn_join(df, df, 5, Options()).collect()}
    path = fresh_dir(spark, "index")
    options = Options(ivf_nlist=24, block_rows=64)
    vector_index.build_index(df, path, options)
    monkeypatch.setattr(vector_index, "_fit", None)  # nothing is fitted from here on
    index = vector_index.open_index(spark, path)
    assert (np.diff(index.curve) >= 0).all() and index.curve[-1] == 1
    assert index.info() == {"backend": "ivf", "rows": 900, "width": 8, "cells": len(index.centres)}
    probes = {}
    for recall in (0.9, 0.99):
        found = {(r["golden_ord"], r["ord"]) for r in index.search(df, 5, options, recall).collect()}
        probes[recall] = index.probes_for(recall)
        assert len(found & exact) / len(exact) >= recall
    assert probes[0.9] < probes[0.99] <= len(index.centres) or probes[0.9] < len(index.centres)
    by_name = neighbors.search_strategy("ivf", index=path)(df, df, 5, replace(options, ivf_nprobe=24)).collect()
    assert {(r["golden_ord"], r["ord"]) for r in by_name} == exact


def test_index_of_no_row_and_of_one(spark):
    for rows in (0, 1):
        df = frame(spark, np.ones((1, 3))).limit(rows)
        index = vector_index.build_index(df, fresh_dir(spark, "index"), Options())
        assert index.info()["rows"] == rows and index.search(df, 2, Options(), 0.9).count() == 0


def test_capped_pairs(spark):
    vectors = np.tile([[1.0, 0.0]], (6, 1))
    pairs = duplicates.near_duplicate_pairs(frame(spark, vectors), Options(), max_neighbors=2)
    assert {(r["left_ord"], r["right_ord"]) for r in pairs.collect()} == {(0, 1), (0, 2), (1, 2)}


def test_unknown_strategy():
    with pytest.raises(ValueError):
        neighbors.search_strategy("nearest")
    with pytest.raises(ValueError):
        Options(duplicate_policy="some")


def test_partitions_do_not_matter(spark):
    vectors = crowd(6)
    kept = [ords(duplicates.dedup_any_earlier(frame(spark, vectors, n), SMALL)) for n in (1, 7)]
    assert kept[0] == kept[1]


@pytest.mark.parametrize("rows", [500, 4000])
def test_a_row_is_sent_to_few_bins_however_many_rows_there_are(spark, rows):
    df = frame(spark, np.random.default_rng(7).normal(size=(rows, 24)))
    options = Options(block_rows=16)
    pivots = cells.choose_pivots(df, options)
    homes = settle(cells.assign_homes(df, pivots))
    figures = cells.Cells.measure(homes, pivots, options)
    visits = cells.with_visits(homes, figures, 2.0)  # everything is near
    assert rows <= visits.count() <= 24 * rows
    assert sum(figures.rows.values()) == rows and len(figures.rows) <= 24


def test_pairs_and_neighbours_over_several_bins_and_divided_ones(spark):
    rng = np.random.default_rng(8)
    dense = rng.normal(size=16) + 0.01 * rng.normal(size=(1500, 16))
    vectors = np.concatenate([dense, rng.normal(size=(500, 16))])
    rng.shuffle(vectors)
    sims, df = sims_of(vectors), frame(spark, vectors)
    options = Options(block_rows=16, max_pivots=40, broadcast_rows=1, duplicate_cosine=0.99995)
    pairs = {(r["left_ord"], r["right_ord"]) for r in duplicates.near_duplicate_pairs(df, options).collect()}
    earlier = {j: np.flatnonzero(sims[:j, j] >= 0.99995) for j in range(len(vectors))}
    assert pairs == {(int(i[0]), j) for j, i in earlier.items() if len(i)}
    found = {}
    for r in neighbors.knn_join(df, df, 3, options).collect():
        found.setdefault(r["golden_ord"], {})[r["rank"]] = r["ord"]
    np.fill_diagonal(sims, -2)
    for g in range(len(vectors)):
        assert [found[g][rank] for rank in (1, 2, 3)] == np.lexsort((np.arange(len(sims)), -sims[g]))[:3].tolist()


@pytest.mark.parametrize("limit", [0.5, 0.95, -0.3])
@pytest.mark.parametrize("options", [Options(), replace(SMALL, broadcast_rows=1), Options(block_rows=40, broadcast_rows=1)])
def test_neighbours_above_a_floor(spark, options, limit):
    vectors = crowd(9, rows=240)
    sims, df = sims_of(vectors), frame(spark, vectors)
    found = {(r["golden_ord"], r["ord"], r["rank"]) for r in neighbors.knn_join(df, df, 5, options, floor=limit).collect()}
    wanted = set()
    for g in range(len(vectors)):
        order = sorted((j for j in range(len(vectors)) if j != g), key=lambda j: (-sims[g, j], j))[:5]
        wanted |= {(g, j, rank) for rank, j in enumerate(order, 1) if sims[g, j] >= limit}
    assert found == wanted
