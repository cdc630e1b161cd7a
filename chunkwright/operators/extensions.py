"""Jobs around the test set: splitting documents, a share limit for stop words, ranking figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import KEY_TERM_STOP_WORDS, letter_words, let


def chunk_documents(documents: DataFrame, size: int = 350, overlap: int = 50) -> DataFrame:
    """(doc_id, chunk_id, chunk_text): windows of ``size`` white space tokens, ``overlap`` shared with the next.

    The last window holds what is left; a document without tokens has no chunk. ``chunk_id`` is
    ``doc_id#position``. One row-local expression, no shuffle.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    starts = f"sequence(0, greatest(size(toks) - {overlap} - 1, 0) div {step})"
    windows = f"transform({starts}, k -> array_join(slice(toks, int(k * {step} + 1), {size}), ' '))"
    tokens = r"regexp_extract_all(coalesce(text, ''), r'(?U)[^\s\x1c-\x1f]+', 0)"
    found = documents.select("doc_id", F.posexplode(F.expr(let("toks", tokens, windows))).alias("pos", "chunk_text"))
    return found.filter("chunk_text != ''").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.col("doc_id").cast("string"), F.lit("#"), "pos").alias("chunk_id"),
        "chunk_text",
    )


def with_stopword_ratio(chunks: DataFrame) -> DataFrame:
    """Add ``stopword_ratio``, the share of stop words among the words of letters; 0 without words."""
    stop = ", ".join(f"'{w}'" for w in KEY_TERM_STOP_WORDS)
    share = f"size(filter(words, w -> w IN ({stop}))) / greatest(size(words), 1)"
    return chunks.withColumn("stopword_ratio", F.expr(let("words", letter_words("chunk_text"), share)))


def stopword_ratio_filter(chunks: DataFrame, limit: float = 0.5) -> DataFrame:
    """Chunks with at most ``limit`` stop words among their words."""
    return with_stopword_ratio(chunks).filter(F.col("stopword_ratio") <= limit).drop("stopword_ratio")


def ranking_metrics(expected: DataFrame, results: DataFrame, k: int = 10) -> DataFrame:
    """(query_key, ndcg, mrr) of ranked ``results`` (query_key, doc_id, rank) for ``expected`` (query_key, doc_id).

    A document named again further down counts at its first rank only. Queries without any hit in
    the first ``k`` have zeros; results for unknown queries are left aside.
    """
    wanted = expected.select("query_key", "doc_id").distinct()
    ranked = results.filter(F.col("rank") <= k).groupBy("query_key", "doc_id").agg(F.min("rank").alias("rank"))
    per_query = (
        wanted.join(ranked, ["query_key", "doc_id"], "left")
        .groupBy("query_key")
        .agg(
            F.coalesce(F.sum(1 / F.log2(F.col("rank") + 1)), F.lit(0.0)).alias("gain"),
            F.coalesce(F.max(1 / F.col("rank")), F.lit(0.0)).alias("mrr"),
            F.count("*").alias("n"),
        )
    )
    ideal = F.expr(f"aggregate(sequence(1, least(n, {k})), 0D, (total, r) -> total + 1 / log2(r + 1))")
    return per_query.select("query_key", (F.col("gain") / ideal).alias("ndcg"), "mrr")
