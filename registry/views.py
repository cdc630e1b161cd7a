"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.operators import bundles, neighbors, validation
from chunkwright.options import Options
from chunkwright.session import settle, spread

# Small blocks make even the small tables spread over several cells and blocks.
OPTIONS = Options(block_rows=128)
PAIRED = replace(OPTIONS, golden_chunks=2, query_types=("factual", "keyword", "comparison"))
COPY_OFFSET = 1_000_000_000


class Views:
    """Stage outputs, each computed over the whole tables and kept for the session."""

    _known: dict[tuple[str, str], "Views"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Views":
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._known:
            cls._known[key] = cls(spark, folder)
        return cls._known[key]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @property
    def documents(self) -> DataFrame:
        """Every document as a chunk; ``embedding`` is NULL where there is none."""
        docs, vectors = self.table("documents"), self.table("embeddings")
        return docs.join(vectors, docs["doc_id"] == vectors["vec_id"], "left").select(
            F.concat(F.lit("doc-"), F.expr("doc_id div 4")).alias("doc_id"),
            F.concat(F.lit("c-"), docs["doc_id"]).alias("chunk_id"),
            F.col("text").alias("chunk_text"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            docs["doc_id"].alias("ord"),
            "lang",
        )

    @property
    def chunks(self) -> DataFrame:
        return self.documents.filter(F.col("embedding").isNotNull()).drop("lang")

    @property
    def copied(self) -> DataFrame:
        """``chunks`` with every non-English one again, later in order and twice as long a vector."""
        source = self.documents.filter(F.col("embedding").isNotNull())
        again = source.filter(F.col("lang") != "en").select(
            "doc_id",
            F.concat("chunk_id", F.lit("-copy")).alias("chunk_id"),
            "chunk_text",
            F.transform("embedding", lambda x: x * 2).alias("embedding"),
            (F.col("ord") + COPY_OFFSET).alias("ord"),
        )
        return source.drop("lang").unionByName(again)

    @cached_property
    def validated(self) -> validation.Validated:
        return validation.validate(self.copied, OPTIONS)

    @cached_property
    def neighbors(self) -> DataFrame:
        """Three distractors for every valid chunk (sample rate 1, the default)."""
        valid = self.validated.valid
        return settle(neighbors.knn_join(valid, valid, OPTIONS.num_distractors, OPTIONS))

    @cached_property
    def bundles(self) -> DataFrame:
        valid = validation.drop_vectors(self.validated.valid)
        return settle(bundles.build_bundles(valid, self.neighbors, valid))

    @cached_property
    def requests(self) -> DataFrame:
        return spread(settle(bundles.build_requests(self.bundles, OPTIONS)))

    @cached_property
    def completions(self) -> DataFrame:
        return settle(bundles.extractive_queries(self.requests, OPTIONS))

    @cached_property
    def queries(self) -> DataFrame:
        return spread(settle(bundles.assemble_queries(self.requests, self.completions)))

    @property
    def stored_completions(self) -> DataFrame:
        """Only the keyword requests have been answered so far."""
        keyword = self.requests.filter(F.col("query_type") == "keyword").select("request_key")
        return self.completions.join(keyword, "request_key", "left_semi")

    @property
    def judge_scores(self) -> DataFrame:
        """Labels as judge scores: good text 0.9, bad 0.5, toxic 0.3 less; many are missing."""
        labels = self.table("labels")
        return self.queries.join(labels, F.col("bundle_id") == labels["doc_id"]).select(
            F.col("request_key").alias("query_key"),
            F.when(F.col("toxic") == 1, 0.2)
            .when(F.col("quality") == 1, 0.9)
            .otherwise(0.5)
            .alias("score"),
        )

    @property
    def answers(self) -> DataFrame:
        labels = self.table("labels")
        return self.queries.join(labels, F.col("bundle_id") == labels["doc_id"]).select(
            F.col("request_key").alias("query_key"),
            F.concat(F.lit("quality "), F.col("quality")).alias("answer"),
        )

    @cached_property
    def search_results(self) -> DataFrame:
        """Stand-in for a search service that still knows the removed copies."""
        found = neighbors.knn_join(self.validated.valid, self.copied, 24, OPTIONS)
        return settle(found.withColumnRenamed("sim", "score"))
