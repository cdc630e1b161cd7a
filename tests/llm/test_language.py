import numpy as np

from chunkwright.llm import language

SCHEMA = "doc_id bigint, text string, lang string"
WORDS = {
    "aa": "aram bolen catra dilon erat folan".split(),
    "bb": "zuzx qyv wexu xyzu vyqq uxew".split(),
    "cc": "слово дело мысль река город".split(),
}


def rows(count, start=0):
    rng = np.random.default_rng(start)
    names = sorted(WORDS)
    return [(start + k, " ".join(rng.choice(WORDS[names[k % 3]], 12)), names[k % 3]) for k in range(count)]


def test_learns_and_answers(spark):
    model = language.fit(spark.createDataFrame(rows(90), SCHEMA))
    assert model.names == ["aa", "bb", "cc"] and (model.weights == 0).mean() > 0.9
    held = spark.createDataFrame(rows(60, 1000), SCHEMA)
    found = language.identify(held, model).collect()
    assert all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in found)


def test_temperature_and_unit_vectors():
    outs, labels = np.array([[3.0, 0], [3.0, 0], [0, 3.0], [3.0, 0]]), np.array([0, 0, 1, 1])
    assert language._temperature(outs, labels) > 1
    values = language.weighted(np.array([1, 4]), np.array([1.0, 2.0]))
    assert abs((values**2).sum() - 1) < 1e-12


def test_ngrams_see_letters_only():
    assert len(language.ngrams("12 34 !!")) == 0
    assert sorted(language.ngrams("Ab, 7 c")) == sorted(language.ngrams("ab c"))


def test_document_frequency_counts_all_rows(spark):
    docs = spark.createDataFrame(rows(30) + [(99, None, "aa"), (98, "!", "aa")], SCHEMA)
    seen, total = language.document_frequency(docs.repartition(4))
    wanted = np.zeros(len(seen), np.int64)
    for _, text, _ in rows(30):
        wanted[np.unique(language.ngrams(text))] += 1
    assert total == 30 and np.array_equal(seen, wanted)


def test_odd_rows(spark, odd, empty):
    model = language.fit(odd)
    out = {r.doc_id: r for r in language.identify(odd.withColumnRenamed("source", "Score"), model).collect()}
    assert [out[k].lang_pred for k in (4, 5, 6)] == ["und"] * 3 and out[5].score == 0
    assert out[1].lang_pred in model.names and not hasattr(out[1], "Score")
    nothing = language.fit(empty)
    assert language.identify(odd, nothing).filter("lang_pred != 'und'").count() == 0
