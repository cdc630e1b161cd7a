import numpy as np
from pyspark.sql import functions as F

from chunkwright.llm import toxicity
from chunkwright.llm.toxicity import PuSettings, features, fit_from_labels, held_out, score, train

DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, quality int, toxic int"


def corpus(count, seed=0):
    rng = np.random.default_rng(seed)
    plain = [f"word{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(count):
        words = list(rng.choice(plain, 30))
        toxic = k % 7 == 0
        if toxic:
            words[5:5] = rng.choice(["nasty", "vile"], 2).tolist()
        docs.append((k, " ".join(words)))
        if k % 2 == 0:
            labels.append((k, 1, int(toxic)))
    return docs, labels


def test_separates_what_it_has_not_seen(spark):
    docs, labels = corpus(2000)
    table = spark.createDataFrame(docs, DOCS)
    model = fit_from_labels(table, spark.createDataFrame(labels, LABELS))
    found = score(table, model).withColumn("held", held_out()).filter("held").collect()
    assert len(found) > 500
    assert all((r.score >= 0.7) == (r.doc_id % 7 == 0) for r in found)


def test_risk_is_corrected_for_toxic_rows_among_the_unlabelled():
    """Half the unlabelled rows are toxic; calling all of them clean would hide the word."""
    bad, good = features(b"bad"), features(b"good")
    model = train([bad] * 50, [bad] * 50 + [good] * 50, 0.5, PuSettings(min_deviation=0))
    assert model.score(b"bad") > 0.7 > model.score(b"good")


def test_without_a_telling_word_nothing_is_toxic():
    rows = [features(f"word{k}".encode()) for k in range(40)]
    model = train(rows[:10], rows, 0.2, PuSettings())
    assert model.score(b"word1") < 0.7 and model.score(b"") < 0.7


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(400)
    table = spark.createDataFrame(docs, DOCS)
    known = spark.createDataFrame(labels, LABELS)
    turned = known.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (fit_from_labels(table, t) for t in (known, turned))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_samples_are_bounded(spark):
    assert toxicity._sampled(spark.range(5000).withColumnRenamed("id", "doc_id"), 300).count() <= 300


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (8, 1, 0), (None, 1, 1), (9, None, None)], LABELS)
    model = fit_from_labels(odd, labels)
    found = score(odd.withColumnRenamed("lang", "SCORE"), model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not (r.text or "").strip()}) == 1
    for docs, known in ((empty, labels), (odd, labels.limit(0)), (empty, labels.limit(0))):
        assert score(docs, fit_from_labels(docs, known)).count() == docs.count()
