"""Sampling, bundles and whole runs on a few hand-made chunks."""

import json
import math

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import bundles, neighbors, sampling, validation
from chunkwright.options import Options
from chunkwright.plans import testset

def at(degrees):
    return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees))]


# Directions in a plane: the sixth row copies the first, the fourth is five degrees from the third.
SAMPLE = [
    ("doc-001", "c-001", "Ferries cross the northern strait twice every winter morning.", at(0)),
    ("doc-001", "c-002", "Lighthouse keepers record fog and tides in paper journals.", at(25)),
    ("doc-002", "c-001", "Beekeepers move their wooden hives before summer.", at(90)),
    ("doc-002", "c-002", "Beekeepers carry their wooden hives away before summer.", at(95)),
    ("doc-003", "c-001", "Granite quarries ship polished slabs across the continent by rail.", at(50)),
    ("doc-004", "c-001", "Once more: ferries cross the northern strait twice every winter morning.", at(0)),
    ("doc-004", "c-002", "Potters glaze large bowls slowly, then fire them in brick kilns overnight.", at(140)),
]
NEAREST = {
    ("doc-001", "c-001"): {("doc-001", "c-002"), ("doc-003", "c-001"), ("doc-002", "c-001")},
    ("doc-001", "c-002"): {("doc-001", "c-001"), ("doc-003", "c-001"), ("doc-002", "c-001")},
    ("doc-002", "c-001"): {("doc-003", "c-001"), ("doc-004", "c-002"), ("doc-001", "c-002")},
    ("doc-003", "c-001"): {("doc-001", "c-002"), ("doc-002", "c-001"), ("doc-001", "c-001")},
    ("doc-004", "c-002"): {("doc-002", "c-001"), ("doc-003", "c-001"), ("doc-001", "c-002")},
}


@pytest.fixture
def sample(spark):
    rows = [(*row, i) for i, row in enumerate(SAMPLE)]
    return spark.createDataFrame(
        rows, "doc_id string, chunk_id string, chunk_text string, embedding array<double>, ord bigint"
    )


def test_validation_of_the_sample(sample):
    done = validation.validate(sample, Options())
    assert sorted((r["doc_id"], r["chunk_id"]) for r in done.rejected.collect()) == [
        ("doc-002", "c-002"), ("doc-004", "c-001"),
    ]
    assert done.valid.count() == 5 and done.length_ok.count() == 7
    assert {r["reject_reason"] for r in done.rejected.collect()} == {"Near-duplicate chunk (via exact)"}
    short = validation.validate(sample, Options(min_tokens=8, duplicate_policy="greedy"))
    reasons = {(r["doc_id"], r["chunk_id"]): r["reject_reason"] for r in short.rejected.collect()}
    assert reasons[("doc-002", "c-001")] == "Token length (7) out of bounds."
    assert reasons[("doc-004", "c-001")] == "Near-duplicate chunk."


def test_distractors_of_the_sample(sample):
    done = validation.validate(sample, Options())
    for row in testset.select_bundles(done, Options()).collect():
        key = (row["golden"][0]["doc_id"], row["golden"][0]["chunk_id"])
        found = {(d["doc_id"], d["chunk_id"]) for d in row["distractors"]}
        assert len(found) == 3 and NEAREST[key] == found
        assert [d["rank"] for d in row["distractors"]] == [1, 2, 3]
    wide = testset.select_bundles(done, Options(distractor_pool="pre_dedup"))
    first = wide.filter("bundle_id = 0").first()
    assert first["distractors"][0]["doc_id"] == "doc-004"  # the removed copy comes back


def test_run_writes_both_files(spark, sample, tmp_path):
    out, rejected = str(tmp_path / "truth"), str(tmp_path / "rejected")
    result = testset.run(sample, Options(), out, rejected)
    truth = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert len(truth) == result.ground_truth.count() > 0
    assert all(t["validation"]["ragas_context_relevance"] is None for t in truth)
    assert spark.read.text(rejected).count() == 2
    report = {r["stage"]: r["rows"] for r in testset.run_report(result, Options()).collect()}
    assert report["load"] == 7 and report["validate"] == 5 and report["select"] == 10
    with pytest.raises(validation.EmptyStage, match="load"):
        testset.run(sample.limit(0), Options(), out)
    with pytest.raises(validation.EmptyStage, match="validate"):
        testset.run(sample, Options(min_tokens=300), out)


def test_first_run_with_a_model_ends_with_its_requests(spark, sample, tmp_path):
    requests = testset.build_testset(sample, Options()).requests
    none = bundles.extractive_queries(requests, Options()).limit(0)
    out = str(tmp_path / "truth")
    result = testset.run(sample, Options(), out, completions=none)
    written = spark.read.parquet(f"{out}_pending")
    assert written.count() == result.pending.count() == requests.select("request_key").distinct().count()
    assert result.ground_truth.count() == 0


def test_second_run_has_nothing_pending(sample):
    options = Options()
    requests = testset.build_testset(sample, options).requests
    answers = bundles.extractive_queries(requests, options)
    none = answers.limit(0)
    assert bundles.pending_requests(requests, none).count() == requests.select("request_key").distinct().count()
    stored = bundles.completion_merge(none, answers)
    answered = stored.select("request_key")
    assert bundles.pending_requests(requests, stored).join(answered, "request_key", "left_semi").count() == 0
    again = testset.build_testset(sample, options, completions=stored)
    assert again.pending.join(answered, "request_key", "left_semi").count() == 0
    assert again.evaluated.count() == requests.join(answered, "request_key", "left_semi").count()


def test_short_lists_and_comparison(spark, sample):
    one = sample.limit(1)
    none = neighbors.knn_join(one, one, 3, Options())
    built = bundles.build_bundles(one, none, one)
    assert built.first()["distractors"] == []
    types = Options(query_types=("factual", "comparison"))
    assert [r["query_type"] for r in bundles.expand_query_types(built, types).collect()] == ["factual"]
    two = built.withColumn("golden", F.concat("golden", "golden"))
    assert bundles.expand_query_types(two, types).count() == 2


def test_external_results(spark, sample):
    results = spark.createDataFrame(
        [(0, 0, 1, 0.99), (0, 77, 2, 0.9), (0, 6, 3, 0.8), (0, 1, 4, 0.7), (0, 2, 5, 0.6), (0, 4, 6, 0.5), (0, 3, 99, 0.1)],
        "golden_ord bigint, ord bigint, rank int, score double",
    )
    found = neighbors.search_strategy("external", results)(sample.filter("ord = 0"), sample, 3, Options())
    assert [(r["ord"], r["rank"], r["sim"]) for r in found.orderBy("rank").collect()] == [
        (6, 1, 0.8), (1, 2, 0.7), (2, 3, 0.6),
    ]
    with pytest.raises(ValueError):
        neighbors.search_strategy("external")(sample, sample, 3, Options())


def test_sample_sizes():
    assert sampling.target_bundles(Options()) is None
    assert sampling.target_bundles(Options(target_queries=2)) == 1
    assert sampling.target_bundles(Options(target_queries=5)) == 3
    assert sampling.sample_size(100, Options(sample_rate=0.001)) == 1
    assert sampling.sample_size(100, Options(sample_rate=0.257)) == 25
    assert sampling.sample_size(3, Options(target_queries=40)) == 3


@pytest.mark.parametrize("size", [1, 10, 977, 5000])
def test_sample_is_exact_and_independent_of_partitions(spark, size):
    import hashlib

    def picked(parts):
        df = spark.range(3000).withColumnRenamed("id", "ord").repartition(parts)
        return sorted(r["ord"] for r in sampling.sample_exact(df, "ord", 42, size).collect())

    order = sorted(range(3000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert picked(1) == picked(5) == sorted(order[:size])


def test_one_chunk_per_sampled_document(spark):
    df = spark.range(1000).select(
        F.col("id").alias("ord"), F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("d"), F.expr("id div 3"))).alias("doc_id")
    )
    got = sampling.sample_documents(df, 42, size=50).collect()
    assert len(got) == 50 == len({r["doc_id"] for r in got})


def test_escalation_rate(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    share = df.filter(sampling.escalation_sample(F.col("k"), Options())).count() / 4000
    assert 0.08 < share < 0.12
