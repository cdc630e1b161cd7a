"""Text rank and vector rank fused into one neighbour list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_terms, let, letter_words, term_counts
from ..options import Options
from ..session import settle
from .postings import B, best_rows
from .sampling import top_k

_RRF = 60  # a fixed value: the usual constant of reciprocal rank fusion


def text_search(golden: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(golden_ord, ord, score, rank): corpus rows that hold all key terms of the golden row.

    Golden rows with the same key terms are searched once. Blocks of rows meet parts of the queries, and only the
    best rows of a query in each part come back (:mod:`.postings`). Rows with the same ``ord`` are one row, which
    holds the terms that one of them holds; terms of several are not looked for.
    """
    asked = F.expr(key_terms("chunk_text")).alias("key_terms")
    counted = let("c", term_counts("w"), "transform(c, t -> named_struct('n', t.n, 'term', t.term))")
    counted = let("w", letter_words("chunk_text"), f"named_struct('words', size(w), 'terms', {counted})")
    counted = F.expr(f"inline(array({counted}))")
    if golden.sameSemantics(corpus):  # one pass over the texts, which may come out of a join
        terms_of = docs = settle(corpus.select("ord", asked, counted))
    else:
        terms_of, docs = settle(golden.select("ord", asked)), settle(corpus.select("ord", counted))
    with_terms = terms_of.filter(F.col("key_terms") != "").select("ord", "key_terms")
    query_terms = with_terms.select("key_terms").distinct().select(
        "key_terms", F.explode(F.split("key_terms", " ")).alias("term")
    )
    docs_total, avg_words = docs.agg(F.count("*"), F.avg("words")).first()
    avg_words = avg_words or 1.0  # no word at all
    frequency = settle(
        docs.select(F.explode("terms.term").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))  # in the map tasks first, so ahead of the join
        .join(query_terms.select("term").distinct(), "term", "left_semi")
    )
    queries = settle(
        query_terms.join(frequency, "term")
        .groupBy("key_terms")
        .agg(F.sort_array(F.collect_list(F.struct("df", "term")))["term"].alias("terms"))  # five at most
        .filter(F.size("terms") == F.size(F.split("key_terms", " ")))
        .withColumn("query", F.monotonically_increasing_id())
    )
    found = best_rows(
        _one_row_per_ord(docs, avg_words), queries.select("query", "terms"), frequency.toArrow(), docs_total, avg_words, k + 1
    )
    lists = (
        top_k(found, ["query"], [F.desc("score"), F.asc("ord")], k + 1)
        .groupBy("query")
        .agg(F.collect_list(F.struct("ord", "score")).alias("list"))  # k + 1 at most
    )
    found = (
        with_terms.select(F.col("ord").alias("golden_ord"), "key_terms")
        .join(lists.join(queries.select("query", "key_terms"), "query"), "key_terms")
        .select("golden_ord", F.inline("list"))
        .filter(F.col("ord") != F.col("golden_ord"))
    )
    return top_k(found, ["golden_ord"], [F.desc("score"), F.asc("ord")], k)


def _one_row_per_ord(docs: DataFrame, avg_words: float) -> DataFrame:
    """(ord, words, terms) with rows of the same ``ord`` put together, and the terms that only one of them holds."""
    single = F.transform("terms", lambda t: F.struct(t["term"].alias("term"), t["n"].cast("double").alias("n")))
    docs = docs.filter("ord IS NOT NULL").select("ord", F.col("words").cast("double").alias("words"), single.alias("terms"))
    repeated = settle(docs.groupBy("ord").agg(F.count("*").alias("rows"), F.min("words").alias("least")).filter("rows > 1"))
    if repeated.isEmpty():
        return docs
    length = lambda words: 1 - B + B * F.col(words) / avg_words
    # A count that weighs as much in a text of the least length as the term's own count in its own text.
    terms = docs.join(repeated, "ord").select("ord", "least", "words", F.inline("terms"))
    terms = terms.groupBy("ord", "least", "term").agg(
        F.count("*").alias("rows"), F.min(F.col("n") * length("least") / length("words")).alias("n")
    )
    merged = terms.filter("rows = 1").groupBy("ord", F.col("least").alias("words")).agg(
        F.collect_list(F.struct("term", "n")).alias("terms")
    )
    return docs.join(repeated, "ord", "left_anti").unionByName(merged)


def hybrid_search(golden: DataFrame, corpus: DataFrame, k: int, options: Options) -> DataFrame:
    """(golden_ord, ord, sim, rank): reciprocal rank fusion of both searches.

    ``sim`` is the sum of 1 / (60 + rank) over the vector list of
    ``k + options.hybrid_vector_extra`` rows and the text list of
    ``k + options.hybrid_text_extra``. A row below the end of a list gets nothing
    from it, so longer lists can change which rows are the best k.
    """
    from .neighbors import knn_join

    by_vector = knn_join(golden, corpus, k + options.hybrid_vector_extra, options).select("golden_ord", "ord", "rank")
    by_text = text_search(golden, corpus, k + options.hybrid_text_extra).select("golden_ord", "ord", "rank")
    fused = (
        by_vector.unionByName(by_text)
        .groupBy("golden_ord", "ord")
        .agg(F.round(F.sum(1 / (_RRF + F.col("rank"))), 10).alias("sim"))
    )
    return top_k(fused, ["golden_ord"], [F.desc("sim"), F.asc("ord")], k)
