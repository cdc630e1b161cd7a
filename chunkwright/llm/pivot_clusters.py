"""Exact k-means on integer vectors with a LAESA pivot table.

A few vectors are fixed pivots. The distance of every vector to every pivot is worked out once and
written next to it. In a round, the difference between a vector's and a centroid's distance to a pivot
is a lower bound of the distance between the two; only centroids whose bound does not exceed the best
exact distance so far get an exact integer distance. Tasks send back one sum per cluster, so a round
shuffles as many rows as there are tasks and clusters, and the driver holds the centroids alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.session import settle

from .batches import bound_batches

#: Up to this size of all components, squared distances of 64 and more components stay below 2**63.
NARROW = 1 << 27
#: Share by which bounds in floating point are loosened; far above their rounding errors.
SLACK = 1e-9
PIVOTS = 8
LONGEST = (1 << 63) - 1


def integers(vector: str, width: int, scale: int) -> tuple[str, str]:
    """SQL: whether a row's vector counts, and its components times ``scale``, rounded down, as 64-bit integers."""
    usable = f"coalesce(size({vector}), -1) = {width} AND forall({vector}, x -> x IS NOT NULL AND abs(CAST(x AS DOUBLE)) < double('inf'))"
    return usable, f"transform({vector}, x -> CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


def _wide(*arrays: np.ndarray) -> bool:
    return any(a.size and (a.max() > NARROW or a.min() < -NARROW) for a in arrays)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one point; Python integers where 64 bits may not do."""
    if _wide(x, c):
        return ((x.astype(object) - c.astype(object)) ** 2).sum(axis=1)
    off = x - c
    return np.einsum("ij,ij->i", off, off)


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows to a few points in floating point, good to a few units in the last place."""
    out = np.empty((len(x), len(points)))
    for i, point in enumerate(points):
        out[:, i] = np.sqrt(_squared(x, point).astype(float))
    return out


def choose_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Points far from each other, the first of them the first point."""
    chosen = points[:1]
    while len(chosen) < min(count, len(points)):
        far = _distances(points, chosen).min(axis=1)
        if far.max() == 0:
            break
        chosen = np.vstack((chosen, points[far.argmax()]))
    return chosen


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of every row (ties: the smaller number), its squared distance, and exact distances taken."""
    from_pivots = _distances(centroids, pivots)
    bound = np.zeros((len(x), len(centroids)))
    for p in range(to_pivots.shape[1]):
        gap = np.abs(to_pivots[:, p, None] - from_pivots[None, :, p])
        gap -= SLACK * (to_pivots[:, p, None] + from_pivots[None, :, p])
        np.maximum(bound, gap, out=bound)
    wide = _wide(x, centroids)
    best = np.full(len(x), -1, object if wide else np.int64)
    label = np.full(len(x), len(centroids), np.int64)
    reach = np.full(len(x), np.inf)
    first = bound.argmin(axis=1)
    taken = 0
    for again in (False, True):  # the most promising centroid of each row first, then all that may still win
        for c in range(len(centroids)):
            rows = np.flatnonzero((bound[:, c] <= reach) & (first != c) if again else first == c)
            if not len(rows):
                continue
            taken += len(rows)
            got = _squared(x[rows], centroids[c])
            better = (label[rows] == len(centroids)) | (got < best[rows]) | ((got == best[rows]) & (c < label[rows]))
            rows, got = rows[better], got[better]
            best[rows], label[rows] = got, c
            reach[rows] = np.sqrt(got.astype(float)) * (1 + SLACK)
    return label, best, taken


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(cluster, n, s0, s1, ...): one row for each cluster that has vectors."""
    width = centroids.shape[1]
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), width), object)
        count = np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _matrix(batch.column("ints"), width)
            label, _, _ = nearest(x, _matrix(batch.column("away"), len(pivots)), centroids, pivots)
            count += np.bincount(label, minlength=len(centroids))
            wide = _wide(x)
            for c in np.unique(label):
                total[c] += (x[label == c].astype(object) if wide else x[label == c]).sum(axis=0).astype(object)
        used = np.flatnonzero(count)
        sums = [pa.array([Decimal(int(v)) for v in total[used, i]], pa.decimal128(38, 0)) for i in range(width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used], pa.int64()), *sums], names=["cluster", "n", *names]
        )

    fields = "cluster int, n bigint, " + ", ".join(f"{s} decimal(38,0)" for s in names)
    sent = table.select("ints", "away").mapInArrow(run, fields)
    return sent.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = 64, scale: int = 256,
    clusters: int = 40, rounds: int = 5, salt: str = "2", pivots: int = PIVOTS,
) -> tuple[DataFrame, DataFrame]:
    """(``df``'s usable rows with ``cluster`` and ``distance``, (cluster, centroid, n, inertia)).

    Vectors count if they have ``width`` components, none null or not finite; others are left out.
    Components times ``scale`` are rounded down to 64-bit integers (the nearest one beyond those). The
    first centroids are the vectors with the smallest SHA-256 of ``<salt>:<key>`` (equal ones: the smaller vector;
    a null key: last), in that order; fewer vectors make fewer clusters, none an empty result. Every
    round assigns all vectors, then moves each centroid that has any to their mean, rounded down.
    ``distance`` is squared, and null beyond a 64-bit integer, as is ``inertia``, the sum of a cluster's.
    Repeated rows count each. Input columns named ``cluster`` or ``distance`` are replaced, all others kept.
    """
    spark = df.sparkSession
    bound_batches(spark)
    usable, ints = integers(f"`{vector}`", width, scale)
    kept = df.filter(usable)
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(f"`{key}`").cast("string")), 256)
    seeds = kept.select(order.alias("hash"), F.expr(ints).alias("ints"))
    seeds = seeds.orderBy(F.col("hash").asc_nulls_last(), "ints").limit(clusters).collect()
    out = [f for f in df.columns if f.lower() not in ("cluster", "distance")]
    centroids = np.array([r.ints for r in seeds], np.int64).reshape(len(seeds), width)
    fixed = choose_pivots(centroids, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = _distances(_matrix(batch.column("ints"), width), fixed)
            offsets = pa.array(np.arange(len(away) + 1) * len(fixed), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(away.ravel()))],
                names=[*batch.schema.names, "away"],
            )

    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in out]).alias("row"), F.expr(ints).alias("ints"))
    table = rows.mapInArrow(measure, T.StructType([*rows.schema, T.StructField("away", T.ArrayType(T.DoubleType()))]))
    if len(seeds):
        table = settle(table)
    for _ in range(rounds if len(seeds) else 0):
        centroids = centroids.copy()
        for r in _sums(table, centroids, fixed).collect():
            centroids[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(width)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, best, _ = nearest(
                _matrix(batch.column("ints"), width), _matrix(batch.column("away"), len(fixed)), centroids, fixed
            )
            best = [int(d) if d <= LONGEST else None for d in best] if best.dtype == object else best
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(label, pa.int32()), pa.array(best, pa.int64())],
                names=["row", "cluster", "distance"],
            )

    schema = T.StructType(
        [rows.schema["row"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    assigned = table.mapInArrow(assign, schema)
    if len(seeds):
        assigned = settle(assigned)
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = F.when(F.count("distance") == F.count("*"), total).try_cast("bigint")
    figures = assigned.groupBy("cluster").agg(F.count("*").alias("n"), whole.alias("inertia"))
    centres = spark.createDataFrame(
        [(i, c.tolist()) for i, c in enumerate(centroids)], "cluster int, centroid array<bigint>"
    )
    centres = centres.join(figures, "cluster", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return assigned.select("row.*", "cluster", "distance"), centres
