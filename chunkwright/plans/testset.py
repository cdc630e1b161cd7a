"""A whole run: chunks in, scored queries out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bundles import (
    assemble_queries,
    build_bundles,
    build_requests,
    extractive_queries,
    pending_requests,
)
from ..operators.evaluation import evaluate_queries, ground_truth_rows
from ..operators.golden_sets import build_set_bundles, golden_sets, set_neighbors
from ..operators.neighbors import search_strategy
from ..operators.sampling import sample_golden
from ..operators.validation import Validated, annotate, drop_vectors, stage_guard
from ..options import Options
from ..session import settle, spread
from ..sources.chunks import check_dims
from ..sources.sinks import write_ground_truth, write_rejected
from .reuse import Stages


@dataclass(frozen=True)
class TestSet:
    validated: Validated
    bundles: DataFrame
    requests: DataFrame
    pending: DataFrame | None
    evaluated: DataFrame
    ground_truth: DataFrame


def _validating(options: Options) -> tuple:
    """The settings that shape a verdict."""
    return options.min_tokens, options.max_tokens, options.duplicate_cosine, options.duplicate_policy


def select_bundles(
    validated: Validated, options: Options, search_results: DataFrame | None = None
) -> DataFrame:
    """Sample golden chunks and attach distractors with the configured search."""
    pool = validated.length_ok if options.distractor_pool == "pre_dedup" else validated.valid
    search = search_strategy(options.strategy, search_results)
    if options.golden_chunks > 1:
        sets = settle(golden_sets(validated.valid, options))
        neighbors = settle(
            set_neighbors(sets, validated.valid, pool, options.num_distractors, options, search)
        )
        return build_set_bundles(sets, neighbors, drop_vectors(pool))
    golden = sample_golden(validated.valid, options)
    # Written down: a few rows per golden chunk, whose size decides the join with the texts.
    neighbors = settle(search(golden, pool, options.num_distractors, options))
    return build_bundles(drop_vectors(golden), neighbors, drop_vectors(pool))


def build_testset(
    chunks: DataFrame,
    options: Options,
    mode: str = "nonllm",
    completions: DataFrame | None = None,
    judge_scores: DataFrame | None = None,
    search_results: DataFrame | None = None,
    stages: Stages | None = None,
) -> TestSet:
    """All stages on lazy tables; validated chunks and requests are written down once.

    Without ``completions`` the queries are the extractive stand-ins. With ``stages`` the validated chunks, the
    bundles and the requests of an earlier run are read where the settings that shape them are the same.
    Bundles from ``search_results`` are not kept, as these are an input of their own.
    """
    o = options
    if stages is None or not stages.has("validated", _validating(o)):
        check_dims(chunks, o.embed_dim)

    def kept(name: str, settings: tuple, build) -> DataFrame:
        return settle(build()) if stages is None else stages.keep(name, settings, build)

    validated = Validated(kept("validated", _validating(o), lambda: annotate(chunks, o)))
    if search_results is None and stages is not None:
        choosing = (
            o.sample_rate, o.sample_unit, o.target_queries, len(o.query_types), o.num_distractors, o.golden_chunks, o.seed,
            o.strategy, o.distractor_pool, o.ivf_nlist, o.ivf_nprobe, o.hybrid_vector_extra, o.hybrid_text_extra,
        )
        bundles = kept("bundles", choosing, lambda: select_bundles(validated, o))
        requests = kept("requests", (o.query_types, o.temperature, o.answer_tokens, o.config_hash()), lambda: build_requests(bundles, o))
    else:
        bundles = select_bundles(validated, o, search_results)
        requests = settle(build_requests(bundles, o))
    requests = spread(requests)
    pending = None
    if completions is None:
        completions = extractive_queries(requests, options)
    else:
        pending = pending_requests(requests, completions)
    queries = assemble_queries(requests, completions)
    evaluated = settle(evaluate_queries(queries, options, mode, judge_scores))
    return TestSet(
        validated, bundles, requests, pending, evaluated, ground_truth_rows(evaluated, options)
    )


def run(
    chunks: DataFrame, options: Options, out: str, rejected_out: str | None = None, **inputs
) -> TestSet:
    """``build_testset`` with its files written, stopping at an empty stage.

    Requests without an answer yet are written to ``<out>_pending`` and every scored query, accepted
    or not, to ``<out>_evaluated``. While no request has an answer, as in a first run with a model,
    the run ends there.
    """
    stage_guard(chunks, "load")
    result = build_testset(chunks, options, **inputs)
    write_rejected(result.validated.rejected, rejected_out)
    stage_guard(result.validated.valid, "validate")
    stage_guard(result.requests, "select")
    if result.pending is not None:
        result.pending.write.mode("overwrite").parquet(f"{out.rstrip('/')}_pending")
        if result.evaluated.isEmpty() and not result.pending.isEmpty():
            return result
    stage_guard(result.evaluated, "generate")
    result.evaluated.write.mode("overwrite").parquet(f"{out.rstrip('/')}_evaluated")
    stage_guard(result.ground_truth, "evaluate")
    write_ground_truth(result.ground_truth, out)
    return result


def run_report(result: TestSet, options: Options) -> DataFrame:
    """(stage, rows, note), one row per stage."""
    annotated = result.validated.annotated

    def stage(name: str, df: DataFrame, note: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("stage"), F.count("*").alias("rows"), F.lit(note).alias("note")
        )

    parts = [
        stage("load", annotated, f"seed {options.seed}"),
        stage("validate", result.validated.valid, options.duplicate_policy),
        stage("select", result.requests, f"strategy {options.strategy}"),
        stage("generate", result.evaluated, options.model or "extractive"),
        stage("evaluate", result.ground_truth, "accepted"),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
