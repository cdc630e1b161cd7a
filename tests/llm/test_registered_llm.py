"""Registered queries of the subpackage: against their SQL where there is one, else by what they promise."""

import os

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from chunkwright.llm.oracles import ORACLES
from chunkwright.llm.queries import QUERIES, table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
WITHOUT_SQL = {
    "op2_sentencepiece", "op3_sharding", "op5_surrogates", "op7_language", "op8_near_duplicates", "op10_toxicity",
    "op12_alignment", "op13_packing",
}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_every_document_is_answered(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    ids = sorted(r.doc_id for r in table(spark, FOLDER, "documents").collect())
    if name == "op13_packing":  # a row for each piece
        assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
        assert sorted({r.doc_id for r in rows}) == ids
        return
    assert sorted(r.doc_id for r in rows) == ids
    if name == "op2_sentencepiece":
        assert all(r.same_ids and r.round_trip for r in rows)
    if name == "op3_sharding":
        assert len({(r.shard, r.slot) for r in rows}) == len(ids) and {r.shard for r in rows} == set(range(16))
    if name == "op7_language":
        truth = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").collect()}
        held = [r for r in rows if r.held_out]
        assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.95 * len(held)
    if name == "op10_toxicity":
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
