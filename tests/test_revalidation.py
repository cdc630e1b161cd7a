"""Arrivals validated against what came before: the same verdicts as one run over everything."""

from dataclasses import replace

import numpy as np
import pytest

from chunkwright.operators import revalidation, validation
from chunkwright.operators.revalidation import incremental_validate, validated_until
from chunkwright.options import Options
from chunkwright.session import fresh_dir

SCHEMA = "ord bigint, doc_id string, chunk_id string, chunk_text string, embedding array<double>"
SMALL = Options(block_rows=16, max_pivots=12, min_tokens=2, max_tokens=6, duplicate_cosine=0.97)


def rows(seed, count):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(3, 6))
    out = []
    for i in range(count):
        v = centre[i % 3] + 0.15 * rng.normal(size=6) if i % 4 else rng.normal(size=6)
        if i % 7 == 0 and i:
            v = np.array(out[i // 2][4] or np.ones(6)) * 2
        vector = None if i % 23 == 5 else [0.0] * 6 if i % 23 == 6 else [float(x) for x in v]
        out.append((i, f"d{i // 3}", f"c{i}", None if i % 29 == 3 else "w " * (1 + i % 8), vector))
    return out


def told(df):
    return sorted((r.ord, r.n_tokens, r.status, r.reject_reason) for r in df.collect())


@pytest.mark.parametrize("policy", ["any_earlier", "greedy"])
@pytest.mark.parametrize("cuts", [(0, 10, 60, 240), (100, 101, 240), (240,)])
def test_parts_give_the_verdicts_of_one_run(spark, policy, cuts):
    options = replace(SMALL, duplicate_policy=policy)
    whole = spark.createDataFrame(rows(1, 240), SCHEMA).repartition(4)
    state, start = fresh_dir(spark, "state"), 0
    for version, end in enumerate(cuts):
        part = whole.filter(f"ord >= {start} AND ord < {end}")
        live = incremental_validate(part, state, version, options)
        start = end
    assert told(live) == told(validation.annotate(whole, options))


def test_a_version_run_again_replaces_itself(spark):
    whole = spark.createDataFrame(rows(2, 90), SCHEMA)
    state = fresh_dir(spark, "state")
    incremental_validate(whole.filter("ord < 40"), state, 0, SMALL)
    broken = whole.filter("ord >= 40 AND ord < 55")
    incremental_validate(broken, state, 1, SMALL)
    again = incremental_validate(whole.filter("ord >= 40"), state, 1, SMALL)
    assert told(again) == told(validation.annotate(whole, SMALL))
    assert {r.version for r in again.collect()} == {0, 1}


def test_replaced_and_repeated_chunks(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    first = [(1, "d", "x", "old text", a), (2, "d", "y", "other text", b)]
    second = [(11, "d", "x", "new text", a), (12, "d", "y", "other text", b), (13, "d", "z", "third text", b), (14, "d", "z", "late text", a)]
    state = fresh_dir(spark, "state")
    incremental_validate(spark.createDataFrame(first, SCHEMA), state, 0, SMALL)
    live = incremental_validate(spark.createDataFrame(second, SCHEMA), state, 1, SMALL)
    got = {(r.chunk_id, r.ord): r.status for r in live.collect()}
    # x has a new text, which its old one does not drop; y keeps its row; z is near y, and its second text does not count
    assert got == {("x", 11): "Validated", ("y", 2): "Validated", ("z", 13): None}
    back = incremental_validate(spark.createDataFrame([(21, "d", "x", "old text", a)], SCHEMA), state, 2, SMALL)
    assert {(r.chunk_id, r.ord): r.status for r in back.collect()} == {("x", 21): "Validated", ("y", 2): "Validated", ("z", 13): None}
    assert validated_until(spark, state, 0, SMALL).count() == 2
    strict = replace(SMALL, duplicate_cosine=0.5)  # other settings do not see this state
    assert incremental_validate(spark.createDataFrame(first, SCHEMA), state, 0, strict).count() == 2


def test_pivots_are_drawn_anew_as_the_state_grows(spark):
    rng = np.random.default_rng(7)
    data = [(i, "d", f"c{i}", "two words", [float(x) for x in rng.normal(size=4)]) for i in range(400)]
    whole = spark.createDataFrame(data, SCHEMA)
    state = fresh_dir(spark, "state")
    for version, (low, high) in enumerate(((0, 20), (20, 60), (60, 100), (100, 400))):
        live = incremental_validate(whole.filter(f"ord >= {low} AND ord < {high}"), state, version, SMALL)
    past = revalidation.State.of(spark, state, SMALL)
    assert [past.step(v)[0] for v in range(4)] == [1, 1, 2, 3]
    assert len(past.pivots(3)) > len(past.pivots(1))
    assert told(live) == told(validation.annotate(whole, SMALL))


def test_old_texts_are_not_read_again(spark):
    whole = spark.createDataFrame(rows(3, 60), SCHEMA)
    state = fresh_dir(spark, "state")
    incremental_validate(whole.filter("ord < 50"), state, 0, SMALL)
    past = revalidation.State.of(spark, state, SMALL)
    for table, schema in (("verdicts", revalidation._VERDICT), ("points/generation=1", revalidation._POINT)):
        stored = spark.read.parquet(f"{past.root}/{table}/version=0")
        assert "chunk_text" not in stored.columns and set(stored.columns) == {c.split()[0] for c in schema.split(", ")}
