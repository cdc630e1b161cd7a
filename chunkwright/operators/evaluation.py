"""Scoring queries against their golden text and distractors, and the gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bm25 import query_figures
from ..options import Options
from .sampling import escalation_sample

MODES = ("none", "nonllm", "llm", "hybrid")
_ANSWER_CHARS = 256  # fixed value: length of the stand-in answer


def score_queries(queries: DataFrame, options: Options, scorer: str = "bm25") -> DataFrame:
    """Add scores, golden_rank, margin and both coverages. Row-local, no shuffle.

    ``scores`` holds the golden document first, then the distractors in order.
    The figures leave through ``inline``, which later filters on them cannot be
    pushed below, so they are computed once.
    """
    row = query_figures(
        "query", "golden.chunk_text", "distractors.chunk_text", scorer, options.stop_words
    )
    return queries.select("*", F.inline(F.array(row)))


def nonllm_accept(options: Options) -> Column:
    """Gate on the unrounded figures."""
    return (
        (F.col("golden_rank") == 1)
        & (F.col("margin") >= options.min_margin)
        & (F.col("golden_coverage") >= options.min_golden_coverage)
        & (F.col("golden_coverage") - F.col("best_distractor_coverage") >= options.min_coverage_gap)
    )


def nonllm_metrics() -> Column:
    rounded = {
        "bm25_margin": "margin",
        "golden_score": "golden_score",
        "best_distractor_score": "best_distractor_score",
        "golden_coverage": "golden_coverage",
        "best_distractor_coverage": "best_distractor_coverage",
    }
    return F.struct(
        F.col("golden_rank").alias("bm25_rank"),
        *[F.round(F.col(source), 4).alias(name) for name, source in rounded.items()],
    )


def answer_join(queries: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Add ``answer``: the judge's answer, else the start of the golden text."""
    stand_in = F.substring(F.array_join("golden.chunk_text", " "), 1, _ANSWER_CHARS)
    if answers is None:
        return queries.withColumn("answer", stand_in)
    given = answers.groupBy(F.col("query_key").alias("request_key")).agg(
        F.min("answer").alias("__given")
    )
    return (
        queries.join(given, "request_key", "left")
        .withColumn("answer", F.coalesce("__given", stand_in))
        .drop("__given")
    )


def judge_join(queries: DataFrame, judge_scores: DataFrame | None) -> DataFrame:
    """Add ``judge_score``; one score per query key, the lowest if there are several."""
    if judge_scores is None:
        return queries.withColumn("judge_score", F.lit(None).cast("double"))
    one = judge_scores.groupBy(F.col("query_key").alias("request_key")).agg(
        F.min("score").alias("judge_score")
    )
    return queries.join(one, "request_key", "left")


def judge_requests(
    queries: DataFrame,
    options: Options,
    mode: str = "llm",
    answers: DataFrame | None = None,
    judge_scores: DataFrame | None = None,
) -> DataFrame:
    """(query_key, query, answer, contexts): what ``mode`` sends to the judge and has no line in ``judge_scores``.

    A line without a score is a judge that gave none; it is not asked again. In ``hybrid`` mode only the
    escalated part of what the scores reject is sent.
    """
    asked = queries
    if mode == "hybrid":
        escalated = escalation_sample(F.col("request_key"), options)
        asked = score_queries(queries, options).filter(~nonllm_accept(options) & escalated)
    elif mode != "llm":
        asked = queries.limit(0)
    if judge_scores is not None:
        asked = asked.join(judge_scores.select(F.col("query_key").alias("request_key")), "request_key", "left_anti")
    return answer_join(asked.dropDuplicates(["request_key"]), answers).select(
        F.col("request_key").alias("query_key"), "query", "answer", F.col("golden.chunk_text").alias("contexts")
    )


def judge_accept(options: Options) -> Column:
    good = F.col("judge_score") >= options.judge_threshold
    return F.coalesce(good, F.lit(options.on_missing_score == "accept"))


def evaluate_queries(
    queries: DataFrame,
    options: Options,
    mode: str = "nonllm",
    judge_scores: DataFrame | None = None,
    scorer: str = "bm25",
) -> DataFrame:
    """Every query with its figures, ``accepted`` and how it was accepted (``evaluation``).

    Without a table of judge scores the judge accepts nothing. A mode that is
    not known accepts nothing either.
    """
    mode = mode.lower()
    no, yes = F.lit(False), F.lit(True)
    by_score = judged = no
    metrics = F.lit(None)
    evaluated = queries
    if mode in ("nonllm", "hybrid"):
        evaluated = score_queries(evaluated, options, scorer)
        by_score, metrics = nonllm_accept(options), nonllm_metrics()
    evaluated = judge_join(evaluated, judge_scores if mode in ("llm", "hybrid") else None)
    if judge_scores is not None and mode == "llm":
        judged = yes
    if judge_scores is not None and mode == "hybrid":
        judged = ~by_score & escalation_sample(F.col("request_key"), options)
    evaluated = (
        evaluated.withColumn("nonllm_accepted", by_score)
        .withColumn("nonllm_metrics", metrics.cast(_METRICS))
        .withColumn("judged", judged)
        .withColumn("judge_accepted", F.col("judged") & judge_accept(options))
    )
    how = (
        F.lit("none")
        if mode == "none"
        else F.when(F.col("nonllm_accepted"), "nonllm").when(
            F.col("judge_accepted"), "llm" if mode == "llm" else "hybrid_llm"
        )
    )
    return evaluated.withColumn("evaluation", how).withColumn(
        "accepted", F.col("evaluation").isNotNull()
    )


_METRICS = (
    "struct<bm25_rank:int,bm25_margin:double,golden_score:double,best_distractor_score:double,"
    "golden_coverage:double,best_distractor_coverage:double>"
)


def expected_doc_ids() -> Column:
    return F.array_sort(F.array_distinct("golden.doc_id"))


def context_chunks() -> Column:
    return F.transform(
        "golden",
        lambda g: F.struct(
            g["doc_id"].alias("doc_id"), g["chunk_id"].alias("chunk_id"), g["chunk_text"].alias("chunk")
        ),
    )


def ground_truth_rows(evaluated: DataFrame, options: Options) -> DataFrame:
    """The accepted queries in their output shape."""
    return evaluated.filter("accepted").select(
        "query",
        expected_doc_ids().alias("expected_doc_ids"),
        context_chunks().alias("context_chunks"),
        F.struct(
            "query_type",
            "evaluation",
            "nonllm_metrics",
            F.when(F.col("judged"), F.round("judge_score", 3)).alias("ragas_context_relevance"),
            F.when(F.col("judged"), F.lit(options.model)).alias("generator_model"),
        ).alias("validation"),
    )
