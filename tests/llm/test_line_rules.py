from chunkwright.llm.line_rules import LineLimits, apply_line_rules, text_figures, without_lines

SCHEMA = "doc_id bigint, text string, source string"


def brute_repeats(words, size=8):
    places = {}
    for k in range(len(words) - size + 1):
        places.setdefault(tuple(words[k : k + size]), []).append(k)
    return len({p + j for v in places.values() if len(v) > 1 for p in v for j in range(size)})


def test_figures(spark):
    texts = ["a b\n\na b\n #x <y>|", "a b c d e f g h i a b c d e f g h z", "x " * 40, "é ü z", " ".join(map(str, range(50)))]
    out = {r.doc_id: r for r in text_figures(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    for k, t in enumerate(texts):
        words = t.encode().split()
        assert out[k].n_words == len(words)
        assert out[k].word_chars == sum(len(w.decode()) for w in words)
        assert out[k].n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert out[k].n_repeat_words == brute_repeats(words)
    assert out[0].n_dup_lines == 1


def test_frequent_lines_go_and_depleted_documents_fail(spark):
    own = lambda k, n: " ".join(f"t{k}x{j}" for j in range(n))
    rows = [(k, f"{own(k, 30)}\nAll Rights Reserved  to us", "a") for k in range(30)]
    rows += [(100 + k, f"{own(100 + k, 5)}\n  all rights reserved  to us ", "a") for k in range(3)]
    rows += [(200 + k, f"{own(200 + k, 30)}\nall rights reserved  to us", "b") for k in range(5)]
    rows += [(300 + k, "the same text each time " * 6, "c") for k in range(40)]
    rows += [(400, own(400, 30) + "\nall rights reserved  to us", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    judged = apply_line_rules(docs, limits=LineLimits(max_docs=20)).cache()
    out = {r.doc_id: r for r in judged.collect()}
    assert out[0].gone_lines == [1] and out[0].n_left == 30 and not out[0].depleted
    assert out[101].n_left == 5 and out[101].depleted
    assert out[200].gone_lines == [] and out[400].gone_lines == []
    assert out[300].gone_lines == [] and not out[300].depleted  # copies count once
    assert {r.doc_id: r.text for r in without_lines(judged).collect()}[0] == own(0, 30)


def test_odd_rows(spark, odd, empty):
    out = apply_line_rules(odd.withColumnRenamed("lang", "Depleted"))
    assert "Depleted" not in out.columns
    found = {r.doc_id: r for r in out.collect()}
    assert out.count() == odd.count() and found[4].n_words == 0 and found[4].depleted and found[5].depleted
    assert not found[1].depleted and found[9].n_words == 60_000
    assert apply_line_rules(empty).count() == 0
