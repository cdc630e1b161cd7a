"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in source groups. For every group, how many of its rows go to each shard is drawn from the
multivariate hypergeometric distribution, so that a uniform permutation of all rows is met exactly
and the shards get their exact sizes. Rows are permuted inside their group and dealt out by these
counts, and permuted again inside their shard.

All draws on rows are hashes of their content and the seed, so a lost task gives the same rows again.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a source group, and of a part of a shard, that one task sorts.
GROUP_ROWS = 2_000
#: The driver holds one row of the matrix per source group; more rows make larger groups instead.
MAX_GROUPS = 1 << 16
#: Rows from which on the generator's own hypergeometric draw is not defined.
LARGE = 1_000_000_000


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Counts that are at most one apart."""
    return rows // shards + (np.arange(shards) < rows % shards)


def communication_matrix(groups: list[int], sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows from each group (first axis) to each shard, drawn exactly."""
    rng = np.random.default_rng(seed)
    left = np.asarray(sizes, np.int64).copy()
    matrix = np.zeros((len(groups), len(left)), np.int64)
    for k, rows in enumerate(groups):
        total = int(left.sum())
        for shard in range(len(left)):  # one shard after another, each given those before it
            here = int(left[shard])
            total -= here
            matrix[k, shard] = _draw(rng, here, total, int(rows - matrix[k].sum()))
        left -= matrix[k]
    return matrix


def _draw(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """One hypergeometric count; by inversion where numbers pass what the generator takes."""
    if not good or not taken:
        return 0
    if not bad:
        return taken
    if good + bad < LARGE:
        return int(rng.hypergeometric(good, bad, taken))
    return _inverted(rng.random(), good, bad, taken)


def _inverted(chance: float, good: int, bad: int, taken: int) -> int:
    """The count at which the distribution, added up from its mode outwards, passes ``chance``.

    The steps are of the order of the standard deviation, however many rows there are.
    """
    least, most = max(0, taken - bad), min(taken, good)
    mode = min(max((taken + 1) * (good + 1) // (good + bad + 2), least), most)
    up = down = mode
    upper = lower = weight = math.exp(
        _choose(good, mode) + _choose(bad, taken - mode) - _choose(good + bad, taken)
    )
    while chance >= weight:
        chance -= weight
        after = upper * (good - up) / (up + 1) * (taken - up) / (bad - taken + up + 1) if up < most else 0.0
        before = lower * down / (good - down + 1) * (bad - taken + down) / (taken - down + 1) if down > least else 0.0
        if not after and not before:  # what rounding leaves over
            return mode
        if after >= before:
            up, upper, weight, found = up + 1, after, after, up + 1
        else:
            down, lower, weight, found = down - 1, before, before, down - 1
        if chance < weight:
            return found
    return mode


def _choose(all_: int, some: int) -> float:
    """Logarithm of the number of ways to take ``some`` of ``all_``; only the smaller part's factors count."""
    some = min(some, all_ - some)
    if some > 1_000_000:  # log factorials; the factors would be too many
        return math.lgamma(all_ + 1) - math.lgamma(some + 1) - math.lgamma(all_ - some + 1)
    return float(np.log((all_ - np.arange(some)) / (np.arange(some) + 1.0)).sum())


def _content(df: DataFrame) -> list[Column]:
    """128 bits of a row's content; maps have no hash and are left out."""
    columns = [F.col(f"`{f.name}`") for f in df.schema if not _has_map(f.dataType)]
    return [F.xxhash64(F.lit(k), *columns) for k in range(2)]


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def _part(seed: int, step: int, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(step), "_a", "_b"), F.lit(parts))


def _order(seed: int, step: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), F.lit(step), "_a", "_b"), F.col("_a"), F.col("_b")]


def shuffle_to_shards(df: DataFrame, shards: int, seed: int = 0, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (bigint, gapless from 0 in each shard).

    Shard sizes are at most one apart, the first shards have the rest. Every row stays, null and
    repeated ones too; rows equal in every column may trade places. An empty table stays empty.
    Input columns ``shard`` and ``slot`` are replaced, others kept.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot", "_a", "_b", "_group", "_part")]
    a, b = _content(df.select(*(f"`{c}`" for c in kept)))
    rows = df.select(*(f"`{c}`" for c in kept), a.alias("_a"), b.alias("_b"))
    total = df.count()
    groups = min(max(1, math.ceil(total / group_rows)), MAX_GROUPS)
    grouped = rows.withColumn("_group", _part(seed, 1, groups))

    counts = {r["_group"]: r["count"] for r in grouped.groupBy("_group").count().collect()}
    order = sorted(counts)
    matrix = communication_matrix([counts[g] for g in order], shard_sizes(total, shards), seed)
    cuts = df.sparkSession.createDataFrame(
        [(int(g), [int(x) for x in row.cumsum()]) for g, row in zip(order, matrix)], "_group bigint, _cuts array<bigint>"
    )
    place = F.row_number().over(Window.partitionBy("_group").orderBy(*_order(seed, 2)))
    dealt = (
        grouped.withColumn("_place", place)
        .join(cuts, "_group")
        .withColumn("shard", F.size(F.filter("_cuts", lambda cut: cut < F.col("_place"))))
        .withColumn("_part", _part(seed, 3, math.ceil(total / shards / group_rows) or 1))
    )
    sizes = dealt.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("shard", "_part").orderBy(*_order(seed, 4)))
    return dealt.join(starts, ["shard", "_part"]).select(
        *(f"`{c}`" for c in kept), "shard", (F.col("_start") + inside - 1).alias("slot")
    )


def write_shards(df: DataFrame, path: str, shards: int, seed: int = 0) -> None:
    """The shuffled table as Parquet, a folder per shard; ``slot`` gives the order inside."""
    shuffle_to_shards(df, shards, seed).write.partitionBy("shard").parquet(path)
