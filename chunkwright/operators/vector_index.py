"""An inverted-file vector index: written once, searched by any number of later jobs.

The folder holds the centres, every vector under its cell, and a curve: for each number of probed cells,
the share of true neighbours found for a sample of rows. A search that names the recall it needs reads
the number of cells off the curve, and reads the files of those cells only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import Options
from ..session import settle
from .cells import assign_homes, block_join, collapse_copies, matrix, points_of, unit_rows
from .neighbors import _FOUND, _nearest_cells, _nearest_members, _ranked, _to_golden, knn_join
from .sampling import bucket_counts, cut_sample

#: Rows whose true neighbours are looked up to measure the curve.
MEASURED_ROWS = 256
#: What a wanted recall is raised by before it is looked up, as the curve is measured on a sample.
MARGIN = 0.02


@dataclass(frozen=True)
class VectorIndex:
    spark: SparkSession
    path: str
    centres: np.ndarray  # at most ivf_nlist
    curve: np.ndarray  # recall by number of probed cells, from one cell on

    @property
    def members(self) -> DataFrame:
        """(ord, unit, cell), in a folder for each cell."""
        return self.spark.read.schema("ord bigint, unit array<double>, cell int").parquet(f"{self.path}/members")

    def info(self) -> dict[str, int | str]:
        """What a caller may ask of a search backend: rows, width, cells, and its name."""
        width = self.centres.shape[1] if len(self.centres) else 0
        return {"backend": "ivf", "rows": self.members.count(), "width": width, "cells": len(self.centres)}

    def probes_for(self, recall: float) -> int:
        """The fewest cells with which the sampled rows found that share of their neighbours, and a little more."""
        enough = np.flatnonzero(self.curve >= min(1.0, recall + MARGIN))
        return int(enough[0]) + 1 if len(enough) else len(self.centres)

    def search(self, golden: DataFrame, k: int, options: Options, recall: float | None = None) -> DataFrame:
        """(golden_ord, ord, sim, rank): the k nearest other rows in the probed cells.

        ``recall`` chooses how many cells, else ``options.ivf_nprobe`` says; all of them make the result exact.
        """
        golden = points_of(golden)
        if not len(self.centres):
            return self.spark.createDataFrame([], "golden_ord bigint, ord bigint, sim double, rank int")
        probes = options.ivf_nprobe if recall is None else self.probes_for(recall)
        homes = assign_homes(golden, self.centres)
        firsts = settle(collapse_copies(homes))
        visits = settle(_nearest_cells(firsts, self.centres, probes))
        asked = [r["cell"] for r in visits.select("cell").distinct().collect()]  # a row for each centre at most
        members = self.members.filter(F.col("cell").isin(asked))
        found = block_join(members, visits, options, _nearest_members(k + 1), self.centres.shape[1], _FOUND)
        return _to_golden(homes, firsts, _ranked(found, "visitor_ord", k + 1).drop("rank"), k)


def _fit(corpus: DataFrame, options: Options) -> np.ndarray:
    """Unit centres, trained on ``ivf_training_rows`` rows for each of ``ivf_nlist`` centres, or one for each row if there are fewer."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    counts = bucket_counts(corpus, "ord", options.seed)
    total = sum(n for _, n in counts)
    nlist = min(options.ivf_nlist, total)
    if nlist < 2:
        first = corpus.select("embedding").first()
        return np.eye(1, len(first["embedding"])) if first else np.empty((0, 0))
    training = cut_sample(corpus, "ord", options.seed, counts, options.ivf_training_rows * nlist)
    model = KMeans(k=nlist, seed=options.seed, maxIter=10, distanceMeasure="cosine").fit(
        training.select(array_to_vector("embedding").alias("features"))
    )
    return np.unique(unit_rows(np.array(model.clusterCenters())), axis=0)


def _measure(index: VectorIndex, corpus: DataFrame, k: int, options: Options) -> np.ndarray:
    """The curve: of the true neighbours of sampled rows, the share within the first 1, 2, ... cells."""
    counts = bucket_counts(corpus, "ord", options.seed)
    sample = settle(cut_sample(corpus, "ord", options.seed, counts, MEASURED_ROWS))
    true = settle(knn_join(sample, corpus, k, options)).select("golden_ord", "ord")
    cells = index.members.select("ord", "cell")
    rows = true.join(cells, "ord").select("golden_ord", "cell").toArrow()  # k for each sampled row at most
    units = sample.toArrow()
    place = {o: i for i, o in enumerate(units.column("ord").to_pylist())}
    if not rows.num_rows:
        return np.ones(len(index.centres))
    order = np.argsort(-(unit_rows(matrix(units.column("embedding"))) @ index.centres.T), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
    at = rank[[place[g] for g in rows.column("golden_ord").to_pylist()], rows.column("cell").to_numpy()]
    return np.cumsum(np.bincount(at, minlength=len(index.centres))) / rows.num_rows


def build_index(corpus: DataFrame, path: str, options: Options, measured_k: int = 10) -> VectorIndex:
    """Write an index of the rows that have a vector below ``path``, which must be new or empty of one."""
    spark, corpus = corpus.sparkSession, points_of(corpus)
    path = path.rstrip("/")
    centres = _fit(corpus, options)
    if not len(centres):
        members = spark.createDataFrame([], "ord bigint, unit array<double>, cell int")
    else:
        members = assign_homes(corpus, centres).select("ord", "unit", "cell")
    # Rows of a cell come together, cut into several tasks where a cell is large, so that a cell has few files.
    rows = members.count()
    parts = max(1, math.ceil(rows / max(1, options.ivf_training_rows * len(centres))))
    dealt = members.repartition("cell", F.pmod(F.xxhash64("ord"), F.lit(parts)))
    dealt.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/members")
    listed = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, unit array<double>")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    index = VectorIndex(spark, path, centres, np.ones(len(centres)))
    curve = _measure(index, corpus, measured_k, options) if len(centres) > 1 else index.curve
    figures = spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(curve)], "probes int, recall double")
    figures.coalesce(1).write.mode("overwrite").parquet(f"{path}/curve")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index written before; its centres and curve are read, its vectors stay where they are."""
    path = path.rstrip("/")
    centres = spark.read.schema("cell int, unit array<double>").parquet(f"{path}/centres").orderBy("cell").collect()
    curve = spark.read.schema("probes int, recall double").parquet(f"{path}/curve").orderBy("probes").collect()
    return VectorIndex(spark, path, np.array([r["unit"] for r in centres]), np.array([r["recall"] for r in curve]))
