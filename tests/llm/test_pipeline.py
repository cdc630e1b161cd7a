import os

import pytest

import corpus_pipeline
from chunkwright.llm.queries import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_stages_keep_the_columns(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == odd.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
    texts = [r.text for r in docs.collect()]
    assert texts.count(None) == 2 and "" in texts
    assert set(out.columns) == {"doc_id", "source", "text", "ids", "n_tokens"}


def test_stages_on_an_empty_table(spark, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    given = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    assert 0.5 * len(given) < len(out) < len(given)
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert len({r.doc_id for r in out}) == len(out)
    assert not [r for r in out if "555-" in r.text and r.text == given[r.doc_id] and "+1 (" in r.text]
