"""Near-duplicate search and removal on embeddings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..options import Options
from ..session import settle
from .cells import (
    Cells,
    assign_homes,
    at_least,
    cell_join,
    choose_pivots,
    collapse_copies,
    matrix,
    near,
    points_of,
    slice_rows,
    with_visits,
)
from .neighbors import knn_join
from .sampling import sample_exact


def _radius(threshold: float) -> float:
    """Chord length between unit vectors whose cosine is ``threshold``."""
    return math.sqrt(max(2 - 2 * threshold, 0.0))


def _earliest(threshold: float):
    """For each visitor its earliest member within the limit."""

    def compare(member_ord, members, visitor_ord, visitors):
        for v, m, sim in near(members, visitors, threshold):
            order = np.lexsort((member_ord[m], v))
            order = order[member_ord[m[order]] < visitor_ord[v[order]]]
            first = order[np.unique(v[order], return_index=True)[1]]
            yield {"left_ord": member_ord[m[first]], "right_ord": visitor_ord[v[first]], "sim": sim[first]}

    return compare


#: Pairs handed over at a time.
_PAIRS = 100_000


def _all_earlier(threshold: float):
    """For each visitor all its earlier members within the limit."""

    def compare(member_ord, members, visitor_ord, visitors):
        for v, m, sim in near(members, visitors, threshold):
            left, right = member_ord[m], visitor_ord[v]
            earlier = np.flatnonzero(left < right)
            for start in range(0, len(earlier), _PAIRS):
                at = earlier[start : start + _PAIRS]
                yield {"left_ord": left[at], "right_ord": right[at], "sim": sim[at]}

    return compare


def _has_earlier(threshold: float):
    def compare(member_ord, members, visitor_ord, visitors):
        for v, m, _ in near(members, visitors, threshold):
            yield {"ord": visitor_ord[np.unique(v[member_ord[m] < visitor_ord[v]])]}

    return compare


def _with_leaders(firsts: DataFrame, cells: Cells, threshold: float) -> DataFrame:
    """Add ``leader`` and ``leader_sim``: the earliest among the first rows of the cells that is earlier and within the limit.

    ``until`` is the leader's ``ord``, or else the row's own: an earlier match than the leader has a lower ``ord``.
    One leader per cell, so as many vectors as there are pivots are shared. All
    but the leader of a dense crowd of near copies are settled here in one pass
    over the rows, and are never compared with each other.
    """
    firsts_of_cells = list(cells.first.values())
    leaders = firsts.filter(F.col("ord").isin(firsts_of_cells)).select("ord", "unit").orderBy("ord").collect()
    shared = firsts.sparkSession.sparkContext.broadcast(
        (np.array([r["ord"] for r in leaders]), np.array([r["unit"] for r in leaders]))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader_ord, leader_unit = shared.value
        for batch in batches:
            step = slice_rows(len(leader_ord))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ords = part.column("ord").to_numpy()
                row, leader, sim = at_least(matrix(part.column("unit")) @ leader_unit.T, threshold)
                earlier = leader_ord[leader] < ords[row]
                row, leader, sim = row[earlier], leader[earlier], sim[earlier]
                row, at = np.unique(row, return_index=True)  # leaders are in order, so the first is the earliest
                until, cosine, none = ords.copy(), np.zeros(len(ords)), np.ones(len(ords), bool)
                until[row], cosine[row], none[row] = leader_ord[leader[at]], sim[at], False
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("ord"), part.column("unit"), part.column("cell"),
                        pa.array(until, mask=none), pa.array(cosine, mask=none), pa.array(until),
                    ],
                    ["ord", "unit", "cell", "leader", "leader_sim", "until"],
                )

    return firsts.select("ord", "unit", "cell").mapInArrow(
        run, "ord bigint, unit array<double>, cell int, leader bigint, leader_sim double, until bigint"
    )


def _distinct_directions(
    chunks: DataFrame, options: Options, pivot_source: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(homes of all rows, one settled row per distinct direction, pivots)."""
    points = points_of(chunks)
    pivots = choose_pivots(points if pivot_source is None else points_of(pivot_source), options)
    homes = assign_homes(points, pivots)
    return homes, settle(collapse_copies(homes)), pivots


def _every_pair(chunks: DataFrame, options: Options) -> DataFrame:
    """(left_ord, right_ord, sim) of all pairs within the limit: each row meets the rows of the cells that begin before it.

    Nothing is collapsed or settled by leaders, as a crowd's pairs are all wanted; blocks bound what a task holds.
    """
    threshold = options.duplicate_cosine
    points = points_of(chunks).filter("ord IS NOT NULL")
    if threshold > 0:  # the zero vector is like nothing
        points = points.filter(F.exists("embedding", lambda x: x != 0))
    pivots = choose_pivots(points, options)
    homes = settle(assign_homes(points, pivots))
    cells = Cells.measure(homes, pivots, options)
    return cell_join(
        cells.in_bins(homes),
        with_visits(homes.withColumn("until", F.col("ord")), cells, _radius(threshold), before="until"),
        cells.rows,
        options,
        _all_earlier(threshold),
        pivots.shape[1],
        "left_ord bigint, right_ord bigint, sim double",
    )


def near_duplicate_pairs(
    chunks: DataFrame, options: Options, max_neighbors: int | None = None, every: bool = False
) -> DataFrame:
    """(left_ord, right_ord, sim): every row that has an earlier one within the limit, with its earliest.

    One row per later row, so a crowd of copies gives as many rows as it has members, and whether two
    copies are equal to the last bit makes no difference. It is all that removing duplicates needs.

    With ``every``, all pairs within the limit; a crowd of n rows then has n (n - 1) / 2 of them.

    With ``max_neighbors`` the pairs are those among each row's nearest
    neighbours, as a capped index search finds them.
    """
    if every and max_neighbors is not None:
        raise ValueError("every pair or those of max_neighbors, not both")
    threshold = options.duplicate_cosine
    if max_neighbors is not None:
        near = knn_join(chunks, chunks, max_neighbors, options, floor=threshold)
        return near.filter(F.col("ord") > F.col("golden_ord")).select(F.col("golden_ord").alias("left_ord"), F.col("ord").alias("right_ord"), "sim")
    if every:
        return _every_pair(chunks, options)
    homes, firsts, pivots = _distinct_directions(chunks, options)
    cells = Cells.measure(firsts, pivots, options)
    led = settle(_with_leaders(firsts, cells, threshold))
    between = cell_join(
        cells.in_bins(firsts),
        with_visits(led, cells, _radius(threshold), before="until"),
        cells.rows,
        options,
        _earliest(threshold),
        pivots.shape[1],
        "left_ord bigint, right_ord bigint, sim double",
    )
    by_leader = led.filter("leader IS NOT NULL").select(
        F.col("leader").alias("left_ord"), F.col("ord").alias("right_ord"), F.col("leader_sim").alias("sim")
    )
    between = between.unionByName(by_leader)
    best = F.min(F.struct("left_ord", "sim")).alias("best")
    between = settle(between.groupBy("right_ord").agg(best).select("right_ord", "best.*"))
    return with_copies(homes, firsts, between)


def with_copies(homes: DataFrame, firsts: DataFrame, between: DataFrame) -> DataFrame:
    """(left_ord, right_ord, sim) of first copies, and of all other copies by theirs."""
    # An exact copy has the earliest match of its first copy, or else that copy itself.
    # The zero vector has no direction; its copies are not similar to each other.
    repeated = firsts.filter(
        (F.col("copies") > 1) & (F.aggregate("unit", F.lit(0.0), lambda a, x: a + F.abs(x)) > 0)
    )
    matched = repeated.join(between, repeated["ord"] == between["right_ord"], "left").select(
        "cell",
        "unit",
        F.col("ord").alias("first_ord"),
        F.coalesce("left_ord", "ord").alias("left_ord"),
        F.coalesce("sim", F.lit(1.0)).alias("sim"),
    )
    copies = (
        homes.join(matched, ["cell", "unit"])
        .filter(F.col("ord") > F.col("first_ord"))
        .select("left_ord", F.col("ord").alias("right_ord"), "sim")
    )
    return between.select("left_ord", "right_ord", "sim").unionByName(copies)


def _without_earlier(firsts: DataFrame, pivots: np.ndarray, options: Options) -> tuple[DataFrame, DataFrame]:
    """Split (ord, unit, cell, dist) rows by whether an earlier row is within the limit."""
    threshold = options.duplicate_cosine
    cells = Cells.measure(firsts, pivots, options)
    marked = _with_leaders(firsts, cells, threshold)
    later = cell_join(
        cells.in_bins(firsts),
        with_visits(marked.filter("leader IS NULL"), cells, _radius(threshold), before="until"),
        cells.rows,
        options,
        _has_earlier(threshold),
        pivots.shape[1],
        "ord bigint",
    ).distinct()
    later = settle(later.unionByName(marked.filter("leader IS NOT NULL").select("ord")))
    return firsts.join(later, "ord", "left_anti"), firsts.join(later, "ord", "left_semi")


def dedup_any_earlier(
    chunks: DataFrame, options: Options, pivot_source: DataFrame | None = None
) -> DataFrame:
    """``ord`` of the kept rows: those with no earlier row within the limit, kept or not."""
    zero, firsts, pivots = _split_zero(chunks, options, pivot_source)
    kept, _ = _without_earlier(firsts, pivots, options)
    return kept.select("ord").unionByName(zero)


def dedup_greedy(
    chunks: DataFrame, options: Options, pivot_source: DataFrame | None = None
) -> DataFrame:
    """``ord`` of the rows a first-come scan keeps: a dropped row drops nobody."""
    zero, firsts, pivots = _split_zero(chunks, options, pivot_source)
    return zero.unionByName(greedy_rounds(firsts, pivots, options))


def greedy_rounds(open_rows: DataFrame, pivots: np.ndarray, options: Options) -> DataFrame:
    """``ord`` of the kept ones of (ord, unit, cell, dist) rows.

    Each round keeps every open row without an earlier open row nearby, then
    drops the open rows near those. That is the serial scan's answer; a round
    costs one cell join over what is still open, and no list of pairs is built.
    """
    kept = open_rows.select("ord").limit(0)
    while not open_rows.isEmpty():
        winners, rest = _without_earlier(open_rows, pivots, options)
        winners, rest = settle(winners), settle(rest)
        kept = kept.unionByName(winners.select("ord"))
        if rest.isEmpty():
            break
        cells = Cells.measure(winners, pivots, options)
        dropped = settle(
            cell_join(
                cells.in_bins(winners),
                with_visits(rest, cells, _radius(options.duplicate_cosine)),
                cells.rows,
                options,
                _has_earlier(options.duplicate_cosine),
                pivots.shape[1],
                "ord bigint",
            ).distinct()
        )
        open_rows = settle(rest.join(dropped, "ord", "left_anti"))
    return kept


def _split_zero(chunks: DataFrame, options: Options, pivot_source: DataFrame | None):
    """Rows without a vector or with the zero vector are nobody's duplicate."""
    length = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.abs(x))
    has_direction = F.coalesce(length > 0, F.lit(False))
    _, firsts, pivots = _distinct_directions(chunks.filter(has_direction), options, pivot_source)
    return chunks.filter(~has_direction).select("ord"), firsts, pivots


def dropped_rows(
    chunks: DataFrame, options: Options, pivot_source: DataFrame | None = None
) -> DataFrame:
    """``ord`` of the rows the configured duplicate policy removes."""
    dedup = dedup_greedy if options.duplicate_policy == "greedy" else dedup_any_earlier
    return chunks.select("ord").join(dedup(chunks, options, pivot_source), "ord", "left_anti")


def dedup_sampled(chunks: DataFrame, options: Options, *, sample_rows: int, neighbors: int) -> DataFrame:
    """Pairs found by searching the nearest ``neighbors`` (self included) of a row sample.

    A sampling operator: pairs of rows outside the sample of ``sample_rows``, and those
    beyond the nearest ``neighbors``, are not looked for.
    """
    sample = sample_exact(chunks, "ord", options.seed, sample_rows)
    near = knn_join(sample, chunks, neighbors - 1, options)
    return (
        near.filter(F.col("sim") >= options.duplicate_cosine)
        .select(
            F.least("golden_ord", "ord").alias("left_ord"),
            F.greatest("golden_ord", "ord").alias("right_ord"),
            "sim",
        )
        .groupBy("left_ord", "right_ord")
        .agg(F.max("sim").alias("sim"))
    )
