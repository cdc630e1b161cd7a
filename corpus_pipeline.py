"""A training-data pipeline over ``documents``: each stage applies one operator of ``chunkwright.llm``.

A stage takes all rows its predecessor kept and returns those it keeps, with the columns of
``documents``; the last returns the texts with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm.decontaminate import remove_contamination
from chunkwright.llm.order_minhash import keep_one
from chunkwright.llm.queries import MODEL, table
from chunkwright.llm.sentencepiece import encode, share_model
from chunkwright.llm.surrogates import replace_entities
from chunkwright.llm.toxicity import fit_from_labels, score
from chunkwright.session import settle

#: Score from which on a document is rejected.
TOXIC = 0.7
#: Key of the surrogates; a real run brings its own.
SURROGATE_KEY = "corpus-pipeline"


def _same_columns(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed`` with the columns of ``docs``, and the length of its texts where there is one."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return changed.select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from ``labels`` outside the held-out third."""
    model = fit_from_labels(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).filter(F.col("score") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest doc_id."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut from the texts; documents that are little else go."""
    return _same_columns(docs, remove_contamination(docs, table(spark, sf_dir, "benchmark")))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; every document stays."""
    return _same_columns(docs, replace_entities(docs, SURROGATE_KEY))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, text, ids, n_tokens): the token ids of every text."""
    coded = encode(docs, share_model(docs, MODEL))
    return coded.select("doc_id", "source", "text", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", replace_private),
    ("sentencepiece", tokenize),
]

#: Learnt scores, sketches and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
