"""Validation of arriving chunks against all that were validated before.

A state folder keeps, per version, the verdicts (keys and reasons, no text) and one unit vector for every
direction that can drop later rows. A new version reads its own arrivals, the keys of the rows it
has in common with the past, and the vectors of the cells its rows visit; old texts stay unread. The pivots
are stored with the vectors, so both sides always mean the same cells; when the state has grown several
times over, one version draws new pivots and files the vectors anew.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import chunk_key
from ..options import Options
from ..session import settle
from .cells import (
    Cells,
    assign_homes,
    cell_join,
    choose_pivots,
    collapse_copies,
    near,
    points_of,
    with_visits,
)
from .duplicates import _radius, _without_earlier, greedy_rounds
from .validation import length_ok, reject_reason, with_token_count

_VERDICT = "ord bigint, doc_id string, chunk_id string, chunk_key string, n_tokens int, reject_reason string"
_POINT = "ord bigint, unit array<double>, cell int, dist double"
_STEP = "generation int, first int, points bigint, drawn_at bigint"
#: Pivots are drawn anew once there are so many times the vectors there were when they were drawn.
REDRAW = 4


@dataclass(frozen=True)
class State:
    """A state folder, as the settings that shape a verdict see it."""

    spark: SparkSession
    root: str

    @staticmethod
    def of(spark: SparkSession, folder: str, options: Options) -> "State":
        """Other limits, another threshold or policy: another state, filed beside this one."""
        shaping = (options.min_tokens, options.max_tokens, options.duplicate_cosine, options.duplicate_policy, options.config_hash())
        return State(spark, f"{folder.rstrip('/')}/{hashlib.sha256(repr(shaping).encode()).hexdigest()[:16]}")

    def read(self, table: str, schema: str, version: int, first: int = 0) -> DataFrame:
        """Rows of the versions from ``first`` on and before ``version``."""
        if version <= first:
            return self.spark.createDataFrame([], f"{schema}, version int")
        paths = [f"{self.root}/{table}/version={v}" for v in range(first, version)]
        return self.spark.read.schema(f"{schema}, version int").option("basePath", f"{self.root}/{table}").parquet(*paths)

    def write(self, df: DataFrame, table: str, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/version={version}")

    def step(self, version: int) -> tuple[int, int, int, int]:
        """After ``version``: generation of the pivots, version it began with, vectors, vectors there were at its beginning."""
        if version < 0:
            return 0, 0, 0, 0
        return tuple(self.spark.read.schema(_STEP).parquet(f"{self.root}/steps/version={version}").first())

    def pivots(self, generation: int) -> np.ndarray:
        """At most ``max_pivots`` rows."""
        rows = self.spark.read.schema("at int, unit array<double>").parquet(f"{self.root}/pivots/generation={generation}")
        return np.array([r["unit"] for r in rows.orderBy("at").collect()])

    def keep_pivots(self, generation: int, pivots: np.ndarray) -> None:
        rows = self.spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pivots)], "at int, unit array<double>")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pivots/generation={generation}")


def _any_member(threshold: float):
    """Visitors that have a member within the limit, whatever the order numbers of the two say."""

    def compare(member_ord, members, visitor_ord, visitors):
        for v, _, _ in near(members, visitors, threshold):
            yield {"ord": visitor_ord[np.unique(v)]}

    return compare


def _near_old(firsts: DataFrame, old: DataFrame, pivots: np.ndarray, options: Options) -> DataFrame:
    """``ord`` of the new rows within the limit of an old one; old cells that no new row visits are not read."""
    figures = Cells.measure(old, pivots, options)
    visitors = with_visits(firsts, figures, _radius(options.duplicate_cosine))
    visited = [r["cell"] for r in visitors.select("cell").distinct().collect()]  # one per bin at most
    members = figures.in_bins(old.filter(F.col("cell").isin(np.flatnonzero(np.isin(figures.bins, visited)).tolist())))
    found = cell_join(
        members, visitors, figures.rows, options, _any_member(options.duplicate_cosine), pivots.shape[1], "ord bigint"
    )
    return settle(found.distinct())


def _new_rows(arrivals: DataFrame, verdicts: DataFrame, replaced: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """(arrivals that have no verdict yet, ``ord`` of the stored rows whose text they replace); of a key that comes twice, the lower ``ord``."""
    keyed = with_token_count(arrivals).withColumn(
        "chunk_key", chunk_key(F.coalesce("chunk_text", F.lit("")), options.config_hash())
    )
    first = F.min(F.struct("ord", "chunk_key")).alias("first")  # reduced map-side
    came = settle(keyed.groupBy("doc_id", "chunk_id").agg(first).select("doc_id", "chunk_id", "first.*"))
    stored = verdicts.select("doc_id", "chunk_id", F.col("ord").alias("old_ord"), F.col("chunk_key").alias("old_key"))
    stored = stored.join(came.select("doc_id", "chunk_id"), ["doc_id", "chunk_id"], "left_semi")
    stored = stored.join(replaced.select(F.col("ord").alias("old_ord")), "old_ord", "left_anti")
    met = settle(came.join(stored, ["doc_id", "chunk_id"], "left"))
    fresh = met.filter(~F.col("chunk_key").eqNullSafe(F.col("old_key"))).select("ord")
    gone = met.filter(F.col("chunk_key") != F.col("old_key")).select(F.col("old_ord").alias("ord"))
    rows = keyed.join(fresh, "ord", "left_semi")
    return rows.select("ord", "doc_id", "chunk_id", "chunk_key", "n_tokens", "embedding"), gone


def incremental_validate(arrivals: DataFrame, state: str, version: int, options: Options) -> DataFrame:
    """(ord, doc_id, chunk_id, n_tokens, status, reject_reason, version) of all chunks up to ``version``.

    ``arrivals`` are the chunks that came with ``version``; they count as later than all stored ones, and
    ``ord``, unique over all versions, decides among themselves. With the default policy a row is dropped by any
    earlier one, with ``greedy`` by kept rows alone: the verdicts are those of one run over everything.
    A chunk that comes again under its key with the same text keeps its verdict. One with another
    text is judged anew and takes the place of the old text, which drops no later row any more; rows it
    dropped before stay dropped. Versions start at 0 and follow each other; running one
    again replaces it, so a run that broke off can be repeated.
    """
    spark = arrivals.sparkSession
    past = State.of(spark, state, options)
    replaced = past.read("replaced", "ord bigint", version).select("ord")
    fresh, gone = _new_rows(arrivals, past.read("verdicts", _VERDICT, version), replaced, options)
    fresh, gone = settle(fresh), settle(gone)
    past.write(gone, "replaced", version)

    length = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.abs(x))
    points = points_of(fresh.filter(length_ok(options) & F.coalesce(length > 0, F.lit(False))))
    generation, first, stored, drawn_at = past.step(version - 1)
    arrived = points.count()
    old = past.read(f"points/generation={generation}", _POINT, version, first).drop("version")
    old = old.join(replaced.unionByName(gone), "ord", "left_anti")
    redraw = arrived > 0 and (not drawn_at or stored + arrived >= REDRAW * drawn_at)
    if redraw:
        vectors = old.select("ord", F.col("unit").alias("embedding"))
        pivots = choose_pivots(vectors.unionByName(points), options)
        generation, first, drawn_at = generation + 1, version, stored + arrived
        past.keep_pivots(generation, pivots)
        if stored:
            old = settle(assign_homes(vectors, pivots))
    elif arrived:
        pivots = past.pivots(generation)

    able, kept = spark.createDataFrame([], _POINT), spark.createDataFrame([], "ord bigint")
    if arrived:
        able = settle(collapse_copies(assign_homes(points, pivots))).select("ord", "unit", "cell", "dist")
        near = _near_old(able, old, pivots, options) if stored else kept
        if options.duplicate_policy == "greedy":
            kept = settle(greedy_rounds(settle(able.join(near, "ord", "left_anti")), pivots, options))
            able = able.join(kept, "ord", "left_semi")
        else:
            alone, _ = _without_earlier(able, pivots, options)
            kept = settle(alone.select("ord").join(near, "ord", "left_anti"))
    dropped = settle(points.select("ord").join(kept, "ord", "left_anti")).withColumn("is_dropped", F.lit(True))
    judged = fresh.join(dropped, "ord", "left").withColumn("reject_reason", reject_reason(options, F.col("is_dropped")))
    past.write(judged.select(*[c.split()[0] for c in _VERDICT.split(", ")]), "verdicts", version)

    if redraw and stored:  # the new generation begins with everything before this version
        able = old.select("ord", "unit", "cell", "dist").unionByName(able)
    table = f"points/generation={generation}"
    past.write(able.sortWithinPartitions("cell"), table, version)  # readers skip the row groups of other cells
    count = past.read(table, _POINT, version + 1, version).count()
    step = (generation, first, count if redraw else stored + count, drawn_at)
    past.write(spark.createDataFrame([step], _STEP).coalesce(1), "steps", version)
    return validated_until(spark, state, version, options)


def validated_until(spark: SparkSession, state: str, version: int, options: Options) -> DataFrame:
    """The verdicts that ``state`` holds up to ``version``, without those of replaced texts."""
    past = State.of(spark, state, options)
    replaced = past.read("replaced", "ord bigint", version + 1).select("ord")
    status = F.when(F.col("reject_reason").isNull(), F.lit("Validated")).alias("status")
    rows = past.read("verdicts", _VERDICT, version + 1).join(replaced, "ord", "left_anti")
    return rows.select("ord", "doc_id", "chunk_id", "n_tokens", status, "reject_reason", "version")
