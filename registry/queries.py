"""One query per operator. Each reads the given tables in full."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.functions import keys, text, vectors
from chunkwright.operators import bundles, duplicates, evaluation, extensions, golden_sets, hybrid, lsh, neighbors, revalidation, sampling, validation, vector_index
from chunkwright.options import Options
from chunkwright.plans import reuse, testset
from chunkwright.session import fresh_dir, settle
from chunkwright.sources import chunks as sources
from chunkwright.sources import incremental, sinks
from chunkwright.streaming import upsert
from chunkwright.streaming.ingest import stream_ingest as stream

from .views import COPY_OFFSET, OPTIONS, PAIRED, Views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Views.of(spark, folder))
    return build


KEY = ["doc_id", "chunk_id"]
ROW = ["bundle_id", "query_type"]
LOOSE = replace(OPTIONS, duplicate_cosine=0.3)  # low enough for chains among unrelated vectors


# --- sources -----------------------------------------------------------------


def _json_lines(documents: DataFrame) -> DataFrame:
    """Documents as raw JSON, using either pair of field names; some lack a vector or are cut off."""
    first = F.to_json(F.struct("doc_id", "chunk_id", "chunk_text", "embedding"))
    second = F.to_json(
        F.struct("doc_id", "chunk_id", F.col("chunk_text").alias("chunk"), F.col("embedding").alias("content_vector"))
    )
    line = F.when(F.col("lang") == "en", first).when(F.col("lang") == "fr", F.concat(second, F.lit("]")))
    return documents.select(line.otherwise(second).alias("value"))


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "chunk_id", "chunk_text", F.size("embedding").alias("width"), F.coalesce("error", F.lit("")).alias("error")
    )


@register
def scan_jsonl(v: Views) -> DataFrame:
    path = fresh_dir(v.spark, "jsonl")
    _json_lines(v.documents).write.text(path)
    return _parsed(sources.scan_jsonl(v.spark, path, glob="*.txt").filter("error IS NULL"))


def _object_files(v: Views, nested: bool) -> str:
    path = fresh_dir(v.spark, "objects")
    writer = v.chunks.withColumn("part", F.length("chunk_id")).write.option("maxRecordsPerFile", 1)
    (writer.partitionBy("part") if nested else writer).json(path)
    return path


@register
def scan_json_file(v: Views) -> DataFrame:
    return _parsed(sources.scan_json_file(v.spark, _object_files(v, nested=False)))


@register
def scan_object_store(v: Views) -> DataFrame:
    return _parsed(sources.scan_object_store(v.spark, _object_files(v, nested=True)))


@register
def scan_object_store_prefixes(v: Views) -> DataFrame:
    """Two prefixes in one load."""
    folder = _object_files(v, nested=True)
    widths = [r[0] for r in v.chunks.select(F.length("chunk_id")).distinct().orderBy(F.col("length(chunk_id)")).collect()]
    loaded, _ = sources.load_chunks(v.spark, [f"{folder}/part={w}" for w in widths], "object_store_chunks", 64)
    return loaded.select(*KEY, "chunk_text", F.size("embedding").alias("width"))


@register
def scan_paths(v: Views) -> DataFrame:
    return _parsed(sources.scan_paths(v.spark, [_object_files(v, nested=False)]))


@register
def input_type_dispatch(v: Views) -> DataFrame:
    loaded, _ = sources.load_chunks(v.spark, [_object_files(v, nested=False)], "chunks", 64)
    return loaded.select("doc_id", "chunk_id", "chunk_text", F.size("embedding").alias("width"))


@register
def load_order(v: Views) -> DataFrame:
    """Chunks of every document in load order (at most a few per document)."""
    ordered = sources.load_order(v.copied.drop("ord"), KEY)
    return ordered.groupBy("doc_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("ord", "chunk_id")))["chunk_id"], ",").alias("chunk_ids")
    )


@register
def number_lines(v: Views) -> DataFrame:
    """Chunks written in their order to several files, and their places when these are read."""
    path = fresh_dir(v.spark, "ordered")
    rows = v.chunks.repartitionByRange(7, "ord").sortWithinPartitions("ord")
    rows.select(F.to_json(F.struct("doc_id", "chunk_id", "chunk_text", "embedding")).alias("value")).write.text(path)
    parsed = sources.scan_jsonl(v.spark, path, glob="*.txt")
    return sources.number_lines(parsed).select("chunk_id", F.col("ord").alias("place"))


def _lines(v: Views, folder: str, english: bool) -> None:
    """Append JSON lines of the English or of the other documents to ``folder``."""
    part = v.documents.filter((F.col("lang") == "en") == english)
    _json_lines(part).write.mode("append").text(folder)


@register
def incremental_load(v: Views) -> DataFrame:
    """English documents first, the others later; the second version parses only new files."""
    folder, state = fresh_dir(v.spark, "incoming"), fresh_dir(v.spark, "state")
    for version, english in enumerate((True, False)):
        _lines(v, folder, english)
        live = incremental.incremental_load(v.spark, folder, state, version, {"txt": False})
    return _parsed(live)


@register
def stream_ingest(v: Views) -> DataFrame:
    """The same arrivals as a stream: each run reads the files it has not seen."""
    folder, out, seen = (fresh_dir(v.spark, name) for name in ("incoming", "stream", "progress"))
    for english in (True, False):
        _lines(v, folder, english)
        stream(v.spark, folder, out, seen, OPTIONS, glob="*.txt").awaitTermination()
    return v.spark.read.parquet(f"{out}/chunks").select(*KEY, "chunk_text")


@register
def stream_upsert(v: Views) -> DataFrame:
    """English documents, then the others, then the English ones again with a longer text: each key once."""
    folder, out, seen = (fresh_dir(v.spark, name) for name in ("incoming", "upserts", "progress"))
    longer = v.documents.filter("lang = 'en'").withColumn("chunk_text", F.concat("chunk_text", F.lit("!")))
    english = F.col("lang") == "en"
    for part in (v.documents.filter(english), v.documents.filter(~english), longer):
        _json_lines(part).write.mode("append").text(folder)
        upsert.stream_upsert(v.spark, folder, out, seen, OPTIONS, glob="*.txt", buckets=8).awaitTermination()
    return upsert.read_upserts(v.spark, out).select(*KEY, "chunk_text")


# --- projections, filters, row checks ----------------------------------------


@register
def resolve_fields(v: Views) -> DataFrame:
    return _parsed(sources.parse_chunks(_json_lines(v.documents)))


@register
def quarantine(v: Views) -> DataFrame:
    bad = sources.quarantine(sources.parse_chunks(_json_lines(v.documents)))
    return bad.select("error", F.regexp_extract("value", '"chunk_id":"([^"]*)"', 1).alias("chunk_id"))


@register
def check_dims(v: Views) -> DataFrame:
    sources.check_dims(v.chunks, 64)
    return sources.dims(v.chunks)


@register
def token_length_filter(v: Views) -> DataFrame:
    return validation.with_token_count(validation.token_length_filter(v.documents, OPTIONS)).select(
        *KEY, "n_tokens"
    )


@register
def reject_reason(v: Views) -> DataFrame:
    return v.validated.annotated.select(*KEY, "n_tokens", "status", "reject_reason")


@register
def split_valid_rejected(v: Views) -> DataFrame:
    valid = v.validated.valid.agg(F.lit("valid").alias("part"), F.count("*").alias("rows"))
    rejected = v.validated.rejected.groupBy(
        F.when(F.col("reject_reason").startswith("Token"), "length").otherwise("duplicate").alias("part")
    ).agg(F.count("*").alias("rows"))
    return valid.unionByName(rejected)


def _arrivals(v: Views) -> list[DataFrame]:
    """All of ``copied`` in three parts, the later in order the later they come."""
    middle = v.chunks.agg(F.avg("ord")).first()[0]
    early, copy = F.col("ord") < middle, F.col("ord") >= COPY_OFFSET
    return [v.copied.filter(early & ~copy), v.copied.filter(~early & ~copy), v.copied.filter(copy)]


def _in_parts(v: Views, options: Options) -> DataFrame:
    """Verdicts after three arrivals; the last one also brings what came with the second, unchanged."""
    state = fresh_dir(v.spark, "validated")
    first, second, third = _arrivals(v)
    for version, part in enumerate((first, second, second.unionByName(third))):
        live = revalidation.incremental_validate(part, state, version, options)
    return live


@register
def incremental_validate(v: Views) -> DataFrame:
    return _in_parts(v, OPTIONS).select(*KEY, "n_tokens", "status", "reject_reason")


@register
def incremental_validate_greedy(v: Views) -> DataFrame:
    """Rows that a first-come scan at a low limit keeps, although they came in three parts."""
    options = replace(LOOSE, duplicate_policy="greedy", min_tokens=0, max_tokens=1_000_000_000)
    return _in_parts(v, options).filter("status IS NOT NULL").select("ord")


@register
def drop_vectors(v: Views) -> DataFrame:
    return validation.drop_vectors(v.chunks).select(*KEY, "chunk_text", "ord")


@register
def stage_guard(v: Views) -> DataFrame:
    return validation.stage_guard(v.chunks, "load").select(*KEY)


# --- vectors -----------------------------------------------------------------


@register
def l2_normalize(v: Views) -> DataFrame:
    unit = vectors.l2_normalize(F.col("embedding"))
    return v.copied.select("ord", F.posexplode(unit).alias("pos", "x")).select(
        "ord", "pos", F.round("x", 6).alias("x")
    )


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("left_ord", "right_ord", F.round("sim", 4).alias("sim"))


@register
def cosine_matrix_join(v: Views) -> DataFrame:
    return _pairs(duplicates.near_duplicate_pairs(v.chunks, LOOSE, every=True))


@register
def near_duplicate_pairs(v: Views) -> DataFrame:
    return _pairs(duplicates.near_duplicate_pairs(v.copied, OPTIONS, every=True))


@register
def near_duplicate_pairs_capped(v: Views) -> DataFrame:
    return _pairs(duplicates.near_duplicate_pairs(v.copied, LOOSE, max_neighbors=20))


@register
def pairs_lsh(v: Views) -> DataFrame:
    """Rows with an earlier match among all vectors and slightly turned ones; -1 if at least nine tenths are found."""
    turned = F.expr("transform(embedding, (x, i) -> x * (1 + 0.1 * sin(i + ord)))")
    again = v.copied.withColumn("embedding", turned).withColumn("ord", F.col("ord") + 2 * COPY_OFFSET)
    rows = settle(v.copied.unionByName(again).select("ord", "embedding"))
    found = settle(lsh.pairs_lsh(rows, OPTIONS, bits=12, miss=1e-6))
    exact = settle(duplicates.near_duplicate_pairs(rows, OPTIONS))
    holds = (F.col("left_ord") < F.col("right_ord")) & (F.col("sim") >= OPTIONS.duplicate_cosine)
    recall = exact.join(found.select("right_ord", F.lit(1).alias("hit")), "right_ord", "left").agg(
        F.lit(-1).cast("bigint").alias("right_ord"), (F.count("hit") >= 0.9 * F.count("*")).alias("holds")
    )
    return found.select("right_ord", holds.alias("holds")).unionByName(recall)


@register
def dedup_any_earlier(v: Views) -> DataFrame:
    return duplicates.dedup_any_earlier(v.chunks, LOOSE)


@register
def dedup_greedy(v: Views) -> DataFrame:
    return duplicates.dedup_greedy(v.chunks, LOOSE)


@register
def dedup_fallback(v: Views) -> DataFrame:
    """Documents without a vector are nobody's duplicate."""
    return duplicates.dedup_any_earlier(v.documents, LOOSE)


@register
def dedup_sampled(v: Views) -> DataFrame:
    return _pairs(duplicates.dedup_sampled(v.copied, OPTIONS, sample_rows=300, neighbors=10))


def _neighbors(df: DataFrame) -> DataFrame:
    return df.select("golden_ord", "ord", "rank", F.round("sim", 4).alias("sim"))


@register
def knn_join(v: Views) -> DataFrame:
    return _neighbors(neighbors.knn_join(v.copied, v.copied, 3, OPTIONS))


@register
def search_strategy(v: Views) -> DataFrame:
    """``exact`` by name, with the golden side treated as too big to broadcast."""
    search = neighbors.search_strategy("exact")
    return _neighbors(search(v.chunks, v.chunks, 3, replace(OPTIONS, broadcast_rows=1)))


def _chunk_index(v: Views) -> vector_index.VectorIndex:
    """An index of all chunks, written by one call and opened by another."""
    path = fresh_dir(v.spark, "index")
    vector_index.build_index(v.chunks, path, replace(OPTIONS, ivf_nlist=16))
    return vector_index.open_index(v.spark, path)


@register
def knn_ivf(v: Views) -> DataFrame:
    """What holds for an approximate search: per row three others, ranked, none nearer than the true ones.

    The row with ``golden_ord`` -1 says whether at least nine tenths of all true neighbours were found.
    """
    found = settle(_chunk_index(v).search(v.chunks, 3, OPTIONS, recall=0.9))
    exact = settle(neighbors.knn_join(v.chunks, v.chunks, 3, OPTIONS))
    best = exact.select("golden_ord", "rank", F.col("sim").alias("best"))
    per_row = found.join(best, ["golden_ord", "rank"]).groupBy("golden_ord").agg(
        F.count("*").alias("rows"),
        F.bool_and((F.col("ord") != F.col("golden_ord")) & (F.col("sim") <= F.col("best") + 1e-9)).alias("holds"),
    )
    hits = exact.join(found.select("golden_ord", "ord", F.lit(1).alias("hit")), ["golden_ord", "ord"], "left")
    recall = hits.agg(
        F.lit(-1).cast("bigint").alias("golden_ord"), F.count("*").alias("rows"), (F.count("hit") >= 0.9 * F.count("*")).alias("holds")
    )
    return per_row.unionByName(recall)


@register
def backend_info(v: Views) -> DataFrame:
    """Rows, width and cells of a saved index."""
    info = _chunk_index(v).info()
    return v.spark.createDataFrame([(info["backend"], info["rows"], info["width"])], "backend string, rows bigint, width int")


@register
def knn_ivf_all_cells(v: Views) -> DataFrame:
    """With every cell probed the approximate search is exact."""
    options = replace(OPTIONS, ivf_nlist=8, ivf_nprobe=8)
    return _neighbors(neighbors.knn_ivf(v.chunks, v.chunks, 3, options))


@register
def vector_search(v: Views) -> DataFrame:
    valid = v.validated.valid
    return _neighbors(neighbors.vector_search(valid, valid, v.search_results, 3))


@register
def key_terms(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", F.expr(text.key_terms("text")).alias("terms"))


@register
def text_search(v: Views) -> DataFrame:
    found = hybrid.text_search(v.documents, v.documents, 13)
    return found.select("golden_ord", "ord", "rank", F.round("score", 4).alias("score"))


@register
def hybrid_search(v: Views) -> DataFrame:
    """All documents; those without a vector are found by their text alone."""
    found = hybrid.hybrid_search(v.documents, v.documents, 3, OPTIONS)
    return found.select("golden_ord", "ord", "rank", F.round("sim", 6).alias("sim"))


# --- sampling ----------------------------------------------------------------


@register
def sample_exact(v: Views) -> DataFrame:
    return sampling.sample_golden(v.chunks, Options(sample_rate=0.1)).select(*KEY)


@register
def sample_documents(v: Views) -> DataFrame:
    return sampling.sample_golden(v.chunks, Options(sample_rate=0.5, sample_unit="documents")).select(*KEY)


@register
def escalation_sample(v: Views) -> DataFrame:
    chosen = sampling.escalation_sample(F.col("chunk_id"), OPTIONS)
    return v.documents.select(*KEY, chosen.alias("escalated"))


@register
def top_k_cut(v: Views) -> DataFrame:
    ranked = sampling.top_k(v.documents, ["doc_id"], [F.desc(F.length("chunk_text")), F.asc("ord")], 2)
    return ranked.select(*KEY, "rank")


# --- bundles and requests ----------------------------------------------------


@register
def build_bundles(v: Views) -> DataFrame:
    return v.bundles.select("bundle_id", F.inline_outer("distractors")).select(
        "bundle_id", "rank", "doc_id", "chunk_id", "chunk_text", F.round("sim", 4).alias("sim")
    )


@register
def expand_query_types(v: Views) -> DataFrame:
    options = replace(OPTIONS, query_types=("factual", "keyword", "comparison"))
    return bundles.expand_query_types(v.bundles, options).select("bundle_id", "query_type")


def _set_bundles(v: Views) -> DataFrame:
    return testset.select_bundles(v.validated, PAIRED)


def _set_requests(v: Views) -> DataFrame:
    return settle(bundles.build_requests(_set_bundles(v), PAIRED))


@register
def multi_golden_bundles(v: Views) -> DataFrame:
    """Sets of two or three golden chunks of a document, and what is most similar to any of them."""
    rows = _set_bundles(v).withColumn("golden_ids", F.array_join("golden.chunk_id", ","))
    return rows.select("bundle_id", "golden_ids", F.inline_outer("distractors")).select(
        "bundle_id", "golden_ids", "rank", "doc_id", "chunk_id", F.round("sim", 4).alias("sim")
    )


@register
def multi_golden_requests(v: Views) -> DataFrame:
    """Requests of sets: ``comparison`` wherever a set has two chunks."""
    return _set_requests(v).select("bundle_id", "query_type", "request_key")


@register
def multi_golden_scores(v: Views) -> DataFrame:
    """Queries of sets scored: slot 0 is all golden texts of a set together."""
    requests = _set_requests(v)
    queries = bundles.assemble_queries(requests, bundles.extractive_queries(requests, PAIRED))
    scored = evaluation.score_queries(queries, PAIRED)
    return scored.select(*ROW, F.posexplode("scores").alias("slot", "score")).select(
        *ROW, "slot", F.round("score", 4).alias("score")
    )


@register
def build_prompt(v: Views) -> DataFrame:
    return bundles.with_prompt(v.requests).select("bundle_id", "query_type", "prompt")


@register
def request_key(v: Views) -> DataFrame:
    return bundles.build_requests(v.bundles, OPTIONS).select("bundle_id", "query_type", "request_key")


@register
def chunk_key(v: Views) -> DataFrame:
    key = keys.chunk_key(F.col("chunk_text"), OPTIONS.config_hash())
    return v.documents.select("ord", key.alias("key"))


@register
def completion_lookup(v: Views) -> DataFrame:
    return bundles.completion_lookup(v.requests, v.stored_completions).select(
        "bundle_id", "query_type", "query", "status"
    )


@register
def pending_requests(v: Views) -> DataFrame:
    return bundles.pending_requests(v.requests, v.stored_completions)


@register
def completion_merge(v: Views) -> DataFrame:
    """A later answer in capitals replaces the stored one; blank answers are ignored."""
    later = v.completions.withColumn("query", F.concat(F.lit("  "), F.upper("query"))).withColumn(
        "created", F.lit(1).cast("bigint")
    )
    blank = v.completions.withColumn("query", F.lit("  ")).withColumn("created", F.lit(2).cast("bigint"))
    merged = bundles.completion_merge(v.stored_completions, later.unionByName(blank))
    return merged.select("request_key", "query", "created")


@register
def assemble_queries(v: Views) -> DataFrame:
    return bundles.assemble_queries(v.requests, v.stored_completions).select(
        "bundle_id", "query_type", "query"
    )


@register
def extractive_queries(v: Views) -> DataFrame:
    return bundles.extractive_queries(v.requests, OPTIONS).select("request_key", "query")


@register
def cache_stats(v: Views) -> DataFrame:
    return bundles.cache_stats(v.requests, v.stored_completions)


# --- evaluation --------------------------------------------------------------


@register
def tokenize(v: Views) -> DataFrame:
    return v.table("documents").select(
        "doc_id", F.array_join(F.expr(text.tokens("text")), " ").alias("tokens")
    )


@register
def bm25_local(v: Views) -> DataFrame:
    scored = evaluation.score_queries(v.queries, OPTIONS)
    return scored.select(*ROW, F.posexplode("scores").alias("slot", "score")).select(
        *ROW, "slot", F.round("score", 4).alias("score")
    )


@register
def overlap_score(v: Views) -> DataFrame:
    scored = evaluation.score_queries(v.queries, OPTIONS, scorer="overlap")
    return scored.select(*ROW, F.posexplode("scores").alias("slot", "score"))


@register
def golden_rank(v: Views) -> DataFrame:
    return evaluation.score_queries(v.queries, OPTIONS).select(*ROW, "golden_rank")


@register
def score_margin(v: Views) -> DataFrame:
    return evaluation.score_queries(v.queries, OPTIONS).select(*ROW, F.round("margin", 4).alias("margin"))


@register
def coverage(v: Views) -> DataFrame:
    return evaluation.score_queries(v.queries, OPTIONS).select(
        *ROW,
        F.round("golden_coverage", 4).alias("golden_coverage"),
        F.round("best_distractor_coverage", 4).alias("best_distractor_coverage"),
    )


@register
def nonllm_accept(v: Views) -> DataFrame:
    scored = evaluation.score_queries(v.queries, OPTIONS)
    return scored.select(*ROW, evaluation.nonllm_accept(OPTIONS).alias("accepted"))


@register
def nonllm_metrics(v: Views) -> DataFrame:
    scored = evaluation.score_queries(v.queries, OPTIONS)
    return scored.select(*ROW, evaluation.nonllm_metrics().alias("m")).select(*ROW, "m.*")


@register
def evaluation_mode(v: Views) -> DataFrame:
    """Accepted counts of all modes."""
    parts = []
    for mode in ("none", "nonllm", "llm", "hybrid", "other"):
        options = replace(OPTIONS, escalation_rate=0.5)
        done = evaluation.evaluate_queries(v.queries, options, mode, v.judge_scores)
        parts.append(
            done.filter("accepted").groupBy(F.lit(mode).alias("mode"), "evaluation").agg(F.count("*").alias("rows"))
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@register
def answer_join(v: Views) -> DataFrame:
    return evaluation.answer_join(v.queries, v.answers).select(*ROW, "answer")


@register
def judge_requests(v: Views) -> DataFrame:
    options = replace(OPTIONS, escalation_rate=0.5)
    asked = evaluation.judge_requests(v.queries, options, "hybrid", v.answers, v.judge_scores)
    return asked.select("query_key", "query", "answer", F.array_join("contexts", " ").alias("context"))


@register
def judge_accept(v: Views) -> DataFrame:
    judged = evaluation.judge_join(v.queries, v.judge_scores)
    strict = replace(OPTIONS, on_missing_score="reject")
    return judged.select(
        *ROW,
        "judge_score",
        evaluation.judge_accept(OPTIONS).alias("open"),
        evaluation.judge_accept(strict).alias("strict"),
    )


@register
def hybrid_gate(v: Views) -> DataFrame:
    options = replace(OPTIONS, escalation_rate=0.5)
    done = evaluation.evaluate_queries(v.queries, options, "hybrid", v.judge_scores)
    return done.select(*ROW, "judged", "evaluation", "accepted")


@register
def expected_doc_ids(v: Views) -> DataFrame:
    ids = evaluation.expected_doc_ids()
    return v.queries.select(*ROW, F.array_join(ids, ",").alias("expected_doc_ids"))


@register
def context_chunks(v: Views) -> DataFrame:
    rows = v.queries.select(*ROW, evaluation.context_chunks().alias("context"))
    return rows.select(*ROW, F.inline("context"))


def _ground_truth(v: Views) -> DataFrame:
    return evaluation.ground_truth_rows(evaluation.evaluate_queries(v.queries, OPTIONS), OPTIONS)


def _flat_truth(rows: DataFrame) -> DataFrame:
    return rows.select(
        "query",
        F.array_join("expected_doc_ids", ",").alias("expected_doc_ids"),
        F.col("context_chunks")[0]["chunk_id"].alias("chunk_id"),
        F.col("validation.query_type").alias("query_type"),
        F.col("validation.evaluation").alias("evaluation"),
        F.col("validation.nonllm_metrics.bm25_margin").alias("margin"),
    )


@register
def ground_truth_rows(v: Views) -> DataFrame:
    return _flat_truth(_ground_truth(v))


@register
def write_ground_truth(v: Views) -> DataFrame:
    rows, path = _ground_truth(v), fresh_dir(v.spark, "truth")
    sinks.write_ground_truth(rows, path)
    return _flat_truth(v.spark.read.schema(rows.schema).json(path))


@register
def write_rejected(v: Views) -> DataFrame:
    path = fresh_dir(v.spark, "rejected")
    sinks.write_rejected(v.validated.rejected, path)
    return v.spark.read.schema(
        "doc_id string, chunk_id string, chunk_text string, reject_reason string"
    ).json(path)


@register
def whole_run(v: Views) -> DataFrame:
    """Chunks in, scored queries out, nothing reused from the other queries."""
    return flagship(v.copied, replace(OPTIONS, sample_rate=0.25))


@register
def stage_reuse(v: Views) -> DataFrame:
    """The same run at another temperature, after one whose validated chunks and bundles it takes over."""
    store, taken = fresh_dir(v.spark, "stages"), reuse.snapshot(v.copied)
    options = replace(OPTIONS, sample_rate=0.25)
    testset.build_testset(v.copied, options, stages=reuse.Stages(v.spark, store, taken))
    stages = reuse.Stages(v.spark, store, reuse.snapshot(v.copied))
    again = testset.build_testset(v.copied, replace(options, temperature=0.9), stages=stages)
    reused = [F.lit(stages.reused[name]).alias(f"{name}_reused") for name in ("validated", "bundles", "requests")]
    return again.evaluated.select(*ROW, "query", "golden_rank", F.round("margin", 4).alias("margin"), "accepted", *reused)


def flagship(chunks: DataFrame, options: Options) -> DataFrame:
    result = testset.build_testset(chunks, options)
    return result.evaluated.select(
        *ROW, "query", "golden_rank", F.round("margin", 4).alias("margin"), "accepted"
    )


# --- jobs around the test set ------------------------------------------------


@register
def chunk_documents(v: Views) -> DataFrame:
    return extensions.chunk_documents(v.table("documents"), size=100, overlap=20)


@register
def stopword_ratio_filter(v: Views) -> DataFrame:
    kept = extensions.with_stopword_ratio(extensions.stopword_ratio_filter(v.documents, 0.3))
    return kept.select(*KEY, F.round("stopword_ratio", 6).alias("stopword_ratio"))


@register
def ranking_metrics(v: Views) -> DataFrame:
    """Of every source, documents labelled as good are wanted; the longest were found."""
    docs = v.table("documents")
    good = v.table("labels").filter("quality = 1").select("doc_id").distinct()
    expected = docs.select(F.col("source").alias("query_key"), "doc_id").join(good, "doc_id", "left_semi")
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))
    results = docs.select(F.col("source").alias("query_key"), "doc_id", place.alias("rank"))
    found = extensions.ranking_metrics(expected, results, k=10)
    return found.select("query_key", F.round("ndcg", 6).alias("ndcg"), F.round("mrr", 6).alias("mrr"))


@register
def target_bundles(v: Views) -> DataFrame:
    """Sets to sample from each language so that as many queries come out as it has labelled documents."""
    docs = v.table("documents")
    wanted = docs.join(v.table("labels").select("doc_id"), "doc_id").groupBy("lang").agg(F.count("*").alias("wanted"))
    counts = docs.groupBy("lang").agg(F.count("*").alias("rows")).join(wanted, "lang")
    parts = []
    for r in counts.collect():  # one for each language
        options = Options(target_queries=r["wanted"])
        chosen = sampling.sample_exact(docs.filter(F.col("lang") == r["lang"]), "doc_id", 42, sampling.sample_size(r["rows"], options))
        parts.append(chosen.select("lang", "doc_id", F.lit(sampling.target_bundles(options)).cast("int").alias("bundles")))
    return reduce(DataFrame.unionByName, parts)
