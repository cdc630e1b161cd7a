"""Text search by blocks against a search of every row."""

import math
import random
from collections import Counter

import pytest

from chunkwright.functions.text import key_terms
from chunkwright.operators import postings
from chunkwright.operators.hybrid import text_search
from pyspark.sql import functions as F

SCHEMA = "ord bigint, chunk_text string"


def searched(rows, key_terms_of, k):
    """(golden_ord, ord, rank) of all rows that hold all terms, and the scores."""
    words = {o: (t or "").split() for o, t in rows}
    average = sum(map(len, words.values())) / len(words)
    df = Counter(w for ws in words.values() for w in set(ws))
    found, scores = set(), {}
    for golden, terms in key_terms_of.items():
        if not terms:
            continue
        hits = []
        for o, ws in words.items():
            if o != golden and all(t in ws for t in terms):
                length = 1.2 * (0.25 + 0.75 * len(ws) / average)
                score = sum(
                    math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * ws.count(t) * 2.2 / (ws.count(t) + length)
                    for t in terms
                )
                hits.append((-round(score, 10), o))
        for rank, (score, o) in enumerate(sorted(hits)[:k], 1):
            found.add((golden, o, rank))
            scores[golden, o] = -score
    return found, scores


def texts(rows, seed):
    rng = random.Random(seed)
    common = [f"{a}{b}x" for a in "abcdef" for b in "ghij"]
    return [
        (i, " ".join(rng.choices(common, weights=range(1, 25), k=rng.randrange(1, 30))) if i % 17 else None) for i in range(rows)
    ]


@pytest.mark.parametrize("block, parts", [(8192, (8, 4)), (20, (3, 2)), (7, (1, 1))])
def test_finds_the_best_of_all_rows_that_hold_the_terms(spark, monkeypatch, block, parts):
    monkeypatch.setattr(postings, "BLOCK_ROWS", block)
    monkeypatch.setattr(postings, "PARTS", parts)
    rows = texts(300, block)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    asked = {r.ord: r.k.split() for r in df.select("ord", F.expr(key_terms("chunk_text")).alias("k")).collect()}
    want, scores = searched(rows, asked, 4)
    got = text_search(df, df, 4).collect()
    assert len(want) > 500 and {(r.golden_ord, r.ord, r["rank"]) for r in got} == want
    assert all(r.score == pytest.approx(scores[r.golden_ord, r.ord], abs=1e-9) for r in got)


def test_a_query_gets_few_rows_back_however_many_hold_its_terms(spark, monkeypatch):
    handed = []
    plain = postings.best_rows

    def counted(*args):
        found = plain(*args)
        handed.append(found.count())
        return found

    monkeypatch.setattr("chunkwright.operators.hybrid.best_rows", counted)
    rows = [(i, "alpha beta gamma delta epsilon " + "omega " * (i % 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert text_search(df, df, 3).count() == 6000
    assert handed[0] <= 5 * 4 * postings.PARTS[0]  # of at most five different queries, four rows from each part


def test_rows_of_one_ord_and_no_rows(spark):
    rows = [(1, "alpha beta"), (2, "alpha beta"), (2, "alpha beta"), (3, "alpha beta gamma"), (4, "alpha"), (4, "beta"), (None, "alpha beta")]
    df = spark.createDataFrame(rows, SCHEMA)
    golden = df.filter("ord = 1")
    assert [(r.golden_ord, r.ord) for r in text_search(golden, df, 9).orderBy("rank").collect()] == [(1, 4), (1, 3)]
    assert text_search(golden, df.limit(0), 3).count() == 0
    assert text_search(df.limit(0), df, 3).count() == 0


def test_hybrid_adds_up_both_lists(spark):
    from chunkwright.operators.hybrid import hybrid_search
    from chunkwright.options import Options

    rows = [(i, f"alpha beta gamma {'omega ' * i}", [1.0, i / 10]) for i in range(12)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, embedding array<double>").repartition(4)
    options = Options(hybrid_vector_extra=9, hybrid_text_extra=9)
    by_text = {r.ord: r["rank"] for r in text_search(df.filter("ord = 0"), df, 11).collect()}
    got = hybrid_search(df.filter("ord = 0"), df, 2, options).collect()
    fused = {o: round(1 / (60 + o) + (1 / (60 + by_text[o]) if o in by_text else 0), 10) for o in range(1, 12)}
    assert {(r.ord, r["rank"]) for r in got} == {(o, i) for i, o in enumerate(sorted(fused, key=lambda o: (-fused[o], o))[:2], 1)}
