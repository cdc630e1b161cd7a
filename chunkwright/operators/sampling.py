"""Exact-size samples, top-k cuts and hash samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hash_share, sample_hash
from ..options import Options
from ..session import settle

_PREFIX_HEX = 4  # 65,536 buckets: the bound on what the counting pass returns


def target_bundles(options: Options) -> int | None:
    """How many bundles a fixed number of queries asks for; None when the rate decides."""
    if options.target_queries <= 0:
        return None
    per_bundle = max(1, len(options.query_types))
    return max(1, math.ceil(options.target_queries / per_bundle))


def sample_size(total: int, options: Options) -> int:
    target = target_bundles(options)
    if target is not None:
        return min(target, total)
    return max(1, min(int(total * options.sample_rate), total))


def bucket_counts(df: DataFrame, key: str, seed: int) -> list[tuple[str, int]]:
    """Rows per leading hash digits of the key, in hash order; reads the key column only."""
    bucket = F.substring(sample_hash(seed, F.col(key)), 1, _PREFIX_HEX).alias("bucket")
    return sorted((r["bucket"], r["count"]) for r in df.select(bucket).groupBy("bucket").count().collect())


def cut_sample(df: DataFrame, key: str, seed: int, counts: list[tuple[str, int]], size: int) -> DataFrame:
    """The ``size`` rows with the smallest hash.

    Buckets below the cut are taken by a plain filter; only the one bucket the
    cut falls into (1/65,536 of the rows) is sorted. No row but those few goes
    through a single task, however large the sample is.
    """
    if size >= sum(n for _, n in counts):
        return df
    hashed = sample_hash(seed, F.col(key))
    taken = 0
    for bucket, n in counts:
        if taken + n > size:
            break
        taken += n
    below = df.filter(hashed < bucket)
    if taken == size:
        return below
    edge = (
        df.filter(F.substring(hashed, 1, _PREFIX_HEX) == bucket)
        .orderBy(hashed, key)
        .limit(size - taken)
    )
    return below.unionByName(edge)


def sample_exact(
    df: DataFrame, key: str, seed: int, size: int | None = None, options: Options | None = None
) -> DataFrame:
    """Exactly ``size`` rows, the ones with the smallest MD5 of ``seed:key``."""
    counts = bucket_counts(df, key, seed)
    if size is None:
        size = sample_size(sum(n for _, n in counts), options or Options())
    return cut_sample(df, key, seed, counts, size)


def sample_documents(
    df: DataFrame, seed: int, options: Options | None = None, size: int | None = None
) -> DataFrame:
    """Sample documents, then one random chunk of each.

    The pick per document is a minimum, which map tasks reduce before the
    shuffle, so a document holding a third of all chunks costs nothing extra.
    """
    pick = F.min(F.struct(sample_hash(seed, F.col("ord")).alias("hash"), F.col("ord")))
    picks = df.groupBy("doc_id").agg(pick.alias("pick")).select("doc_id", F.col("pick.ord").alias("ord"))
    chosen = sample_exact(picks, "doc_id", seed, size, options)
    return df.join(settle(chosen.select("ord")), "ord", "left_semi")


def sample_golden(df: DataFrame, options: Options) -> DataFrame:
    if options.sample_unit == "documents":
        return sample_documents(df, options.seed, options)
    return sample_exact(df, "ord", options.seed, options=options)


def escalation_sample(key: Column, options: Options) -> Column:
    """True for the share of keys that go on to the judge."""
    return hash_share(options.seed, key) < F.lit(options.escalation_rate)


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group. Catalyst cuts to k per group before the shuffle too."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
