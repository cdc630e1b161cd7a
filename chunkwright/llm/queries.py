"""One registered query per operator over the given tables, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import language
from .alignment import link_scores
from .decontaminate import find_contamination
from .line_rules import apply_line_rules
from .order_minhash import near_duplicates
from .packing import pack
from .pivot_clusters import cluster
from .recompression import remove_repeated_words
from .sentencepiece import encode, share_model
from .sharding import shuffle_to_shards
from .suffix_dedup import remove_repeated_bytes
from .surrogates import replace_entities
from .toxicity import fit_from_labels, held_out, score


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, folder, "benchmark"), window=10)
    covered = F.expr("aggregate(transform(spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (n, x) -> n + x)")
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


#: The public model all registered tokenizer queries read; a parameter of the operator.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = share_model(docs, MODEL)
    return encode(docs, model, verify=True).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        "same_ids",
        "round_trip",
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    return shuffle_to_shards(docs, shards=16, seed=20).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_recompression(spark: SparkSession, folder: str) -> DataFrame:
    out = remove_repeated_words(table(spark, folder, "documents").select("doc_id", "text"), size=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_entities(docs, key="registered-query").select("doc_id", "text", "n_entities")


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = remove_repeated_bytes(table(spark, folder, "documents").select("doc_id", "text"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~held_out()))
    return language.identify(docs.drop("lang"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op9_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    judged = apply_line_rules(docs)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~F.col("depleted")).alias("kept"),
        F.size("gone_lines").cast("bigint").alias("n_gone_lines"),
        "n_left",
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_from_labels(docs, table(spark, folder, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op11_clusters(spark: SparkSession, folder: str) -> DataFrame:
    assigned, centres = cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    digest = F.sha2(F.concat_ws(",", F.expr("transform(centroid, x -> CAST(x AS STRING))")), 256)
    figures = centres.select(
        "cluster",
        F.col("inertia").alias("cluster_inertia"),
        F.sum("inertia").over(Window.partitionBy(F.lit(0))).alias("inertia"),
        digest.alias("centroid_sha256"),
    )
    rows = assigned.join(F.broadcast(figures), "cluster")  # a row for each cluster
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


#: The byte-level tokenizer of the registered queries; a parameter of the operators.
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return link_scores(docs, share_model(docs, BYTE_MODEL), share_model(docs, MODEL))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pack(docs, share_model(docs, BYTE_MODEL), window=2048, end_id=1).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_sharding": op3_sharding,
    "op4_recompression": op4_recompression,
    "op5_surrogates": op5_surrogates,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language": op7_language,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_line_rules": op9_line_rules,
    "op10_toxicity": op10_toxicity,
    "op11_clusters": op11_clusters,
    "op12_alignment": op12_alignment,
    "op13_packing": op13_packing,
}
