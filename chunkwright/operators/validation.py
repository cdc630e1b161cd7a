"""Length filter, duplicate removal and the reasons for both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import whitespace_token_count
from ..options import Options
from ..session import settle
from .duplicates import dropped_rows


def with_token_count(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("n_tokens", whitespace_token_count("chunk_text"))


def length_ok(options: Options) -> Column:
    """Bounds inclusive; a chunk without a text is out of bounds."""
    within = F.col("n_tokens").between(options.min_tokens, options.max_tokens)
    return F.coalesce(within, F.lit(False))


def token_length_filter(chunks: DataFrame, options: Options) -> DataFrame:
    return with_token_count(chunks).filter(length_ok(options)).drop("n_tokens")


def reject_reason(options: Options, is_dropped: Column) -> Column:
    """Why a row with ``n_tokens`` is rejected; NULL if it is not."""
    duplicate = (
        F.lit("Near-duplicate chunk.")
        if options.duplicate_policy == "greedy"
        else F.lit("Near-duplicate chunk (via exact)")  # whatever search finds the distractors
    )
    return F.when(
        ~length_ok(options), F.format_string("Token length (%d) out of bounds.", F.col("n_tokens"))
    ).when(is_dropped, duplicate)


def annotate(chunks: DataFrame, options: Options) -> DataFrame:
    """Add n_tokens, status and reject_reason to every chunk.

    The cheap length test runs first; only survivors enter the vector join,
    and only as (ord, embedding). What comes back are the dropped keys, written
    down so that Spark knows their size: few of them are broadcast, and the
    chunks themselves are not shuffled.
    """
    counted = with_token_count(chunks)
    survivors = counted.filter(length_ok(options)).select("ord", "embedding")
    dropped = settle(dropped_rows(survivors, options, pivot_source=chunks)).withColumn("is_dropped", F.lit(True))
    return (
        counted.join(dropped, "ord", "left")
        .withColumn("reject_reason", reject_reason(options, F.col("is_dropped")))
        .withColumn("status", F.when(F.col("reject_reason").isNull(), F.lit("Validated")))
        .drop("is_dropped")
    )


@dataclass(frozen=True)
class Validated:
    annotated: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.annotated.filter(F.col("status") == "Validated")

    @property
    def rejected(self) -> DataFrame:
        return self.annotated.filter(F.col("reject_reason").isNotNull())

    @property
    def length_ok(self) -> DataFrame:
        """Chunks before duplicate removal, the wider pool distractors may come from."""
        return self.annotated.filter(
            F.col("reject_reason").isNull() | ~F.col("reject_reason").startswith("Token length")
        )


def validate(chunks: DataFrame, options: Options) -> Validated:
    return Validated(settle(annotate(chunks, options)))


def drop_vectors(chunks: DataFrame) -> DataFrame:
    return chunks.drop("embedding")


class EmptyStage(RuntimeError):
    """A stage left no rows for the next one."""


def stage_guard(df: DataFrame, stage: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyStage(stage)
    return df
