"""Text rules, BM25 and the gates on hand-made rows."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chunkwright.functions import keys, text
from chunkwright.operators import evaluation
from chunkwright.options import Options

GOLDEN = "Solar panels convert sunlight into electricity"
DISTRACTORS = [
    "Wind turbines convert moving air into electricity",
    "Coal plants burn fuel to make steam",
    "Batteries store electricity for later use",
]


@pytest.mark.parametrize(
    "value", ["a b c\x1cd e\x85f  ", "", "  ", "one", "x y z　", "a\x1f\x1eb\tc\n"]
)
def test_token_count_is_whitespace_split(spark, value):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(text.whitespace_token_count("t")).first()[0] == len(value.split())


def test_key_terms_follow_the_rule(spark):
    values = [
        "The cat and the dog. Dog v1 cat bird_x dog!",
        "one two three four five six seven",
        "Élan vital straße",
        "",
        "is are was",
        "zeta alpha zeta alpha beta",
        "fgh " * 3 + "ab " * 9 + "abc " * 5 + "bcd " * 4 + "cde fgh def " * 2 + "ghi",
    ]
    terms = ["dog cat", "one two three four five", "vital", "", "", "zeta alpha beta", "fgh abc bcd cde def"]

    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = {r["t"]: r["k"] for r in df.select("t", F.expr(text.key_terms("t")).alias("k")).collect()}
    assert got == dict(zip(values, terms))


def test_stop_words_with_quotes(spark):
    df = spark.createDataFrame([("Don t stop",)], "t string")
    found = df.select(F.expr(text.tokens("t", ["don", "it's"]))).first()[0]
    assert found == ["t", "stop"]


def queries(spark, rows):
    data = [
        (i, "factual", f"key{i}", q, [("d", "c", g)], [(n + 1, "d", f"x{n}", t, 0.5) for n, t in enumerate(ds)])
        for i, (q, g, ds) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        "bundle_id bigint, query_type string, request_key string, query string, "
        "golden array<struct<doc_id:string,chunk_id:string,chunk_text:string>>, "
        "distractors array<struct<rank:int,doc_id:string,chunk_id:string,chunk_text:string,sim:double>>",
    )


def okapi(query, docs):
    docs = [re.findall("[a-zA-Z0-9]+", d.lower()) for d in docs]
    total, average = len(docs), sum(map(len, docs)) / len(docs)
    holding = Counter(w for d in docs for w in set(d))
    if not holding:
        return [0.0] * total
    idf = {w: math.log(total - n + 0.5) - math.log(n + 0.5) for w, n in holding.items()}
    low = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: low if x < 0 else x for w, x in idf.items()}
    return [
        sum(
            idf.get(w, 0) * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / average))
            for w in re.findall("[a-zA-Z0-9]+", query.lower())
        )
        for d in docs
    ]


def test_bm25_examples(spark):
    rows = [
        ("solar panels sunlight", GOLDEN, DISTRACTORS),
        ("solar solar panels", GOLDEN, DISTRACTORS),
        ("convert electricity", GOLDEN, DISTRACTORS),
        ("quantum flux", GOLDEN, DISTRACTORS),
        ("solar panels", GOLDEN, []),
        ("", GOLDEN, DISTRACTORS),
        ("solar", "", ["", "!!"]),
    ]
    got = evaluation.evaluate_queries(queries(spark, rows), Options()).orderBy("bundle_id").collect()
    for row, (query, golden, others) in zip(got, rows):
        assert row["scores"] == pytest.approx(okapi(query, [golden, *others]), abs=1e-9)
    figures = [
        (r["golden_rank"], round(r["margin"], 4), r["golden_coverage"], r["best_distractor_coverage"], r["accepted"])
        for r in got
    ]
    assert figures[0] == (1, 2.633, 1.0, 0.0, True)
    assert figures[1] == (1, 2.633, 1.0, 0.0, True)
    assert figures[2] == (1, 0.0, 1.0, 0.5, False)
    assert figures[3] == (1, 0.0, 0.0, 0.0, False)
    assert figures[4] == (1, -0.5493, 1.0, 0.0, False)
    assert not figures[5][4] and not figures[6][4]


def test_bm25_on_random_texts(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]

    def sentence(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = [
        (sentence(rng.randint(1, 6)), sentence(40), [sentence(rng.randint(0, 60)) for _ in range(rng.randint(0, 5))])
        for _ in range(60)
    ]
    got = evaluation.score_queries(queries(spark, rows), Options()).orderBy("bundle_id").collect()
    for row, (query, golden, others) in zip(got, rows):
        assert row["scores"] == pytest.approx(okapi(query, [golden, *others]), abs=1e-9)


def test_overlap_scorer(spark):
    row = evaluation.score_queries(queries(spark, [("convert electricity convert", GOLDEN, DISTRACTORS)]), Options(), "overlap")
    assert row.first()["scores"] == [2.0, 2.0, 0.0, 1.0]


def test_judge_modes(spark):
    df = queries(spark, [("quantum flux", GOLDEN, DISTRACTORS)] * 3 + [("solar panels", GOLDEN, DISTRACTORS)])
    scores = spark.createDataFrame(
        [("key0", 0.85), ("key1", 0.5), ("key1", 0.9), ("key2", None)], "query_key string, score double"
    )

    def accepted(mode, **settings):
        given = settings.pop("scores", scores)
        done = evaluation.evaluate_queries(df, Options(model="m", **settings), mode, given)
        return {r["bundle_id"]: r["evaluation"] for r in done.filter("accepted").collect()}

    assert accepted("none") == {i: "none" for i in range(4)}
    assert accepted("nonllm") == {3: "nonllm"}
    assert accepted("llm") == {0: "llm", 2: "llm", 3: "llm"}
    assert accepted("llm", on_missing_score="reject") == {0: "llm"}
    assert accepted("llm", scores=None) == {}
    assert accepted("hybrid", escalation_rate=1.0) == {0: "hybrid_llm", 2: "hybrid_llm", 3: "nonllm"}
    assert accepted("hybrid", escalation_rate=0.0) == {3: "nonllm"}
    assert accepted("unknown") == {}


def test_ground_truth_shape(spark):
    df = queries(spark, [("solar panels", GOLDEN, DISTRACTORS)])
    scores = spark.createDataFrame([("key0", 0.87654)], "query_key string, score double")
    done = evaluation.evaluate_queries(df, Options(model="m"), "llm", scores)
    row = evaluation.ground_truth_rows(done, Options(model="m")).first().asDict(recursive=True)
    assert row["expected_doc_ids"] == ["d"]
    assert row["context_chunks"] == [{"doc_id": "d", "chunk_id": "c", "chunk": GOLDEN}]
    assert row["validation"] == {
        "query_type": "factual",
        "evaluation": "llm",
        "nonllm_metrics": None,
        "ragas_context_relevance": 0.877,
        "generator_model": "m",
    }


def test_request_key_ignores_distractor_order_only(spark):
    df = spark.createDataFrame(
        [(0, ["g"], ["a", "b"]), (1, ["g"], ["b", "a"]), (2, ["g"], ["ab", ""]), (3, ["ga"], ["b"]), (4, ["g"], ["a"])],
        "i int, g array<string>, d array<string>",
    )
    key = keys.request_key(F.col("g"), F.col("d"), F.lit("factual"), 0.5, 32, Options().config_hash())
    got = [r["k"] for r in df.select("i", key.alias("k")).orderBy("i").collect()]
    assert got[0] == got[1] and len(set(got)) == 4
    assert Options().config_hash() != Options(temperature=0.4).config_hash()
