"""Golden chunks with their distractors, and the requests made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.text import distinctive_terms
from ..options import Options

_SEPARATOR = "\n---\n"


def build_bundles(golden: DataFrame, neighbors: DataFrame, corpus: DataFrame) -> DataFrame:
    """(bundle_id, golden, distractors); ``bundle_id`` is the golden chunk's ``ord``.

    Only keys and scores come out of the neighbour join; texts are fetched here
    for the few rows chosen. A bundle with fewer distractors than asked for stays.
    """
    single = golden.select(
        F.col("ord").alias("bundle_id"),
        F.array(F.struct("doc_id", "chunk_id", "chunk_text")).alias("golden"),
    )
    return with_distractors(single, neighbors, corpus.select("ord", "doc_id", "chunk_id", "chunk_text"))


def with_distractors(bundles: DataFrame, neighbors: DataFrame, texts: DataFrame) -> DataFrame:
    """Add the chunks of each bundle's neighbour list, in its order; an empty list where there are none."""
    lists = (
        neighbors.select("golden_ord", "ord", "rank", "sim")
        .join(texts, "ord")
        .groupBy("golden_ord")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("rank", "doc_id", "chunk_id", "chunk_text", "sim"))
            ).alias("distractors")
        )
    )
    none = F.expr(
        "cast(array() as array<struct<rank:int,doc_id:string,chunk_id:string,chunk_text:string,sim:double>>)"
    )
    return bundles.join(lists.withColumnRenamed("golden_ord", "bundle_id"), "bundle_id", "left").withColumn(
        "distractors", F.coalesce("distractors", none)
    )


def expand_query_types(bundles: DataFrame, options: Options) -> DataFrame:
    """One row per bundle and query type; ``comparison`` needs two golden chunks."""
    types = F.array(*[F.lit(t) for t in options.query_types])
    return bundles.withColumn("query_type", F.explode(types)).filter(
        (F.col("query_type") != "comparison") | (F.size("golden") >= 2)
    )


def prompt(golden: Column, distractors: Column, query_type: Column) -> Column:
    return F.concat(
        F.lit("Write one short "),
        query_type,
        F.lit(
            " search query. The wanted text below must be enough to answer it; "
            "the look-alike text must not answer it.\n\nWanted text:\n"
        ),
        F.array_join(golden["chunk_text"], _SEPARATOR),
        F.lit("\n\nLook-alike text:\n"),
        F.array_join(distractors["chunk_text"], _SEPARATOR),
        F.lit("\n\nQuery:"),
    )


def with_prompt(requests: DataFrame) -> DataFrame:
    return requests.withColumn(
        "prompt", prompt(F.col("golden"), F.col("distractors"), F.col("query_type"))
    )


def with_request_key(requests: DataFrame, options: Options) -> DataFrame:
    return requests.withColumn(
        "request_key",
        keys.request_key(
            F.col("golden.chunk_text"),
            F.col("distractors.chunk_text"),
            F.col("query_type"),
            options.temperature,
            options.answer_tokens,
            options.config_hash(),
        ),
    )


def build_requests(bundles: DataFrame, options: Options) -> DataFrame:
    return with_request_key(expand_query_types(bundles, options), options)


def latest_completions(completions: DataFrame) -> DataFrame:
    """One row per key: the newest non-empty answer. Reduced map-side, so a key with many answers is no hot spot."""
    newest = F.max(F.struct("created", "query", "model")).alias("newest")
    return (
        completions.withColumn("query", F.trim("query"))
        .filter(F.length("query") > 0)
        .groupBy("request_key")
        .agg(newest)
        .select("request_key", "newest.query", "newest.model", "newest.created")
    )


def completion_lookup(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """Requests with the stored answer in ``query``, NULL where there is none, and ``status``."""
    stored = latest_completions(completions).select("request_key", "query")
    return requests.join(stored, "request_key", "left").withColumn(
        "status", F.when(F.col("query").isNull(), "pending").otherwise("answered")
    )


def pending_requests(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """(request_key, prompt) still to be answered, each key once."""
    answered = latest_completions(completions).select("request_key")
    return (
        with_prompt(requests)
        .select("request_key", "prompt")
        .join(answered, "request_key", "left_anti")
        .dropDuplicates(["request_key"])
    )


def completion_merge(completions: DataFrame, answers: DataFrame) -> DataFrame:
    """The next version of the completions table."""
    columns = ["request_key", "query", "model", "created"]
    return latest_completions(completions.select(*columns).unionByName(answers.select(*columns)))


def assemble_queries(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """Answered requests as query rows."""
    return requests.join(
        latest_completions(completions).select("request_key", "query"), "request_key"
    )


def extractive_queries(requests: DataFrame, options: Options, max_terms: int = 5) -> DataFrame:
    """(request_key, query, model, created): answers without a model, for offline runs.

    The most frequent key words of the golden text that no distractor holds. Row
    by row inside the JVM; a request without such a word gets no answer.
    """
    query = distinctive_terms(
        "array_join(golden.chunk_text, ' ')", "array_join(distractors.chunk_text, ' ')", max_terms
    )
    # Empty results leave through explode: a filter on the query would be pushed
    # below the projection and compute it twice.
    return (
        requests.select(
            "request_key", F.expr(f"explode(filter(array({query}), q -> q <> ''))").alias("query")
        )
        .groupBy("request_key")
        .agg(F.min("query").alias("query"))
        .select(
            "request_key",
            "query",
            F.lit(options.model or "extractive").alias("model"),
            F.lit(0).cast("bigint").alias("created"),
        )
    )


def cache_stats(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """(status, requests, bytes): hits and misses of the lookup."""
    return (
        completion_lookup(requests, completions)
        .groupBy("status")
        .agg(
            F.count("*").alias("requests"),
            F.coalesce(F.sum(F.octet_length("query")), F.lit(0)).alias("bytes"),
        )
    )
