"""Nearest-neighbour joins: golden rows against a corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..options import Options
from ..session import fresh_dir, settle
from .cells import (
    SLACK,
    Cells,
    assign_homes,
    at_least,
    block_join,
    choose_pivots,
    collapse_copies,
    divide,
    inner_cells,
    matrix,
    may_hold,
    points_of,
    slice_rows,
    unit_rows,
    visits_inside,
    with_visits,
)
from .sampling import top_k

_FARTHEST = 2.0  # chord length across the unit sphere


def _best(rows, ords, sims, k):
    """Positions of the k best entries per row: highest similarity, then lowest ord."""
    order = np.lexsort((ords, -sims, rows))
    sorted_rows = rows[order]
    starts = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < k]


def _entries(cosine: np.ndarray, k: int, floor: float | np.ndarray = -np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of all entries that reach ``floor`` and can be among the k best of their row, ties included.

    Only rows with many entries that reach the floor are cut by their k-th.
    """
    cut = np.broadcast_to(floor, len(cosine)).astype(float)
    many = np.count_nonzero(cosine >= cut[:, None], axis=1) > 4 * k
    if many.any():
        kth = np.partition(cosine if many.all() else cosine[many], cosine.shape[1] - k, axis=1)[:, cosine.shape[1] - k]
        cut[many] = np.maximum(cut[many], kth)
    return at_least(cosine, cut[:, None])


def _chord(floor: float) -> float:
    """Distance of unit vectors whose cosine is ``floor``."""
    return float(np.sqrt(np.clip(2 - 2 * floor, 0, _FARTHEST**2)))


def _nearest_members(k: int, floor: float = -np.inf):
    """The k nearest members of each visitor, of those that reach ``floor``.

    Members are divided into small cells inside the task. A visitor's nearest cell yields a
    similarity that k members reach; other cells are looked at only if the bounds let them hold better ones.
    """

    def compare(member_ord, members, visitor_ord, visitors):
        if not len(members):
            return
        step = slice_rows(len(member_ord))
        pivots, rows, low, high = inner_cells(members)
        for start in range(0, len(visitor_ord), step):
            part = visitors[start : start + step]
            cosine = part @ pivots.T
            lead = cosine.argmax(axis=1)
            reach, found = np.full(len(part), _chord(floor)), []
            least = np.full(len(part), floor)  # what k members reach

            def look(who, cell):
                v, m, sim = _entries(part[who] @ members[rows[cell]].T, k, least[who])
                found.append((who[v], rows[cell][m], sim))

            for cell in np.unique(lead):
                who = np.flatnonzero(lead == cell)
                look(who, cell)
                if len(rows[cell]) >= k:
                    v, _, sim = found[-1]
                    worst = np.full(len(part), 2.0)
                    keep = _best(v, member_ord[rows[cell]][:1].repeat(len(v)), sim, k)
                    np.minimum.at(worst, v[keep], sim[keep])
                    who = who[np.bincount(v[keep], minlength=len(part))[who] >= k]
                    reach[who] = np.sqrt(np.maximum(2 - 2 * worst[who], 0))
                    least[who] = worst[who]
            visit = may_hold(cosine, pivots, low, high, reach[:, None] + SLACK)
            if 2 * np.count_nonzero(visit) > visit.size:  # little to leave out
                product = part @ members.T
                v, m, sim = _entries(product, k, least)
            else:
                visit[np.arange(len(part)), lead] = False
                for cell in np.flatnonzero(visit.any(axis=0)):
                    look(np.flatnonzero(visit[:, cell]), cell)
                v, m, sim = (np.concatenate(x) for x in zip(*found))
            keep = _best(v, member_ord[m], sim, k)
            v, m = v[keep], m[keep]
            yield {"visitor_ord": visitor_ord[start + v], "ord": member_ord[m], "sim": sim[keep]}

    return compare


_FOUND = "visitor_ord bigint, ord bigint, sim double"


def _ranked(found: DataFrame, group: str, k: int) -> DataFrame:
    return top_k(found, [group], [F.desc("sim"), F.asc("ord")], k)


def _knn_broadcast(golden: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Golden matrix to every task, one pass over the corpus, k rows per task and golden.

    Only called after the size of ``golden`` has been checked.
    """
    table = golden.toArrow()
    ords = table.column("ord").to_numpy()
    shared = golden.sparkSession.sparkContext.broadcast((ords, unit_rows(matrix(table.column("embedding")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golden_ord, golden_unit = shared.value
        step = slice_rows(len(golden_ord))
        row, ord_, sim = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                part_ord = part.column("ord").to_numpy()
                scores = golden_unit @ unit_rows(matrix(part.column("embedding"))).T
                scores[golden_ord[:, None] == part_ord[None, :]] = -np.inf
                r, c, values = _entries(scores, k)
                row = np.concatenate([row, r])
                ord_ = np.concatenate([ord_, part_ord[c]])
                sim = np.concatenate([sim, values])
                keep = _best(row, ord_, sim, k)
                row, ord_, sim = row[keep], ord_[keep], sim[keep]
        real = np.isfinite(sim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(golden_ord[row[real]]), pa.array(ord_[real]), pa.array(sim[real])],
            ["golden_ord", "ord", "sim"],
        )

    return _ranked(corpus.mapInArrow(run, "golden_ord bigint, ord bigint, sim double"), "golden_ord", k)


def _to_golden(homes: DataFrame, firsts: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Give every golden row its direction's list, without itself."""
    lists = found.groupBy("visitor_ord").agg(
        F.collect_list(F.struct("ord", "sim")).alias("list")  # at most k + 1 entries
    )
    owners = homes.select("cell", "unit", F.col("ord").alias("golden_ord")).join(
        firsts.select("cell", "unit", F.col("ord").alias("visitor_ord")), ["cell", "unit"]
    )
    pairs = (
        owners.select("golden_ord", "visitor_ord")
        .join(lists, "visitor_ord")
        .select("golden_ord", F.inline("list"))
        .filter(F.col("ord") != F.col("golden_ord"))
    )
    return _ranked(pairs, "golden_ord", k)


def _knn_cells(golden: DataFrame, corpus: DataFrame, k: int, options: Options, floor: float) -> DataFrame:
    """Exact search when the golden side is too big to broadcast.

    Golden rows with the same direction are searched once. The first round looks
    into the home bin (if it was divided, into the nearest cells inside) and yields a radius; the second
    visits only the bins that can hold something nearer.
    """
    pivots = choose_pivots(corpus, options)
    members = settle(assign_homes(corpus, pivots))
    cells = Cells.measure(members, pivots, options)
    homes = assign_homes(golden, pivots)
    firsts = settle(collapse_copies(homes))
    inside = divide(cells.in_bins(members), cells.rows, options, pivots.shape[1])
    held = settle(inside.members) if inside.divided else inside.members

    depth = k + 1  # the row itself may be in its own list
    at_home = visits_inside(cells.in_bins(firsts), inside, options, pivots.shape[1], nearest=2)
    at_home = settle(at_home) if inside.divided else at_home
    home_found = settle(
        _ranked(
            block_join(held, at_home, options, _nearest_members(depth, floor), pivots.shape[1], _FOUND),
            "visitor_ord",
            depth,
        ).drop("rank")
    )
    reached = (
        home_found.groupBy("visitor_ord")
        .agg(F.count("*").alias("n"), F.min("sim").alias("worst"))
        .filter(F.col("n") >= depth)
        .select(
            F.col("visitor_ord").alias("ord"),
            F.sqrt(F.greatest(2 - 2 * F.col("worst"), F.lit(0.0))).alias("radius"),
        )
    )
    seekers = firsts.join(reached, "ord", "left").withColumn(
        "radius", F.least("radius", F.lit(_chord(floor)))  # of what is not null
    )
    # A home bin that was not divided has been seen as a whole.
    away = with_visits(seekers, cells, "radius", without_home=set(cells.bins.tolist()) - set(inside.divided))
    far = visits_inside(away, inside, options, pivots.shape[1])
    if inside.divided:
        far = settle(far.join(at_home.select("ord", "cell"), ["ord", "cell"], "left_anti"))
    far_found = block_join(held, far, options, _nearest_members(depth, floor), pivots.shape[1], _FOUND)
    found = _ranked(home_found.unionByName(far_found), "visitor_ord", depth).drop("rank")
    return _to_golden(homes, firsts, found, k)


def knn_join(golden: DataFrame, corpus: DataFrame, k: int, options: Options, floor: float = -np.inf) -> DataFrame:
    """(golden_ord, ord, sim, rank): the k most similar other rows, exact; of those whose similarity reaches ``floor``.

    Ties go to the lower ``ord``. Small golden sides are broadcast, by row count
    and bytes; larger ones use the cells.
    """
    golden, corpus = points_of(golden), points_of(corpus)
    rows = golden.count()
    first = golden.limit(1).collect()
    if not first:
        return golden.sparkSession.createDataFrame(
            [], "golden_ord bigint, ord bigint, sim double, rank int"
        )
    if rows <= options.broadcast_rows and rows * len(first[0]["embedding"]) * 8 <= options.broadcast_bytes:
        found = _knn_broadcast(golden, corpus, k)
    else:
        found = _knn_cells(golden, corpus, k, options, floor)
    return found if floor == -np.inf else found.filter(F.col("sim") >= floor)


def knn_ivf(golden: DataFrame, corpus: DataFrame, k: int, options: Options) -> DataFrame:
    """Approximate: an index of the corpus is built and its nearest ``ivf_nprobe`` cells searched.

    For a corpus that is searched more than once, build the index with
    :func:`~.vector_index.build_index` and keep it. With ``ivf_nprobe`` at least the number
    of cells the result is exact.
    """
    from .vector_index import build_index

    return build_index(corpus, fresh_dir(corpus.sparkSession, "index"), options).search(golden, k, options)


def _nearest_cells(df: DataFrame, centers: np.ndarray, nprobe: int) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(centers)
    nprobe = min(nprobe, len(centers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = matrix(batch.column("unit")) @ shared.value.T
            near = np.argsort(-cosine, axis=1, kind="stable")[:, :nprobe].astype(np.int32)
            offsets = np.arange(0, near.size + 1, nprobe, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("ord"),
                    batch.column("unit"),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.ravel())),
                ],
                ["ord", "unit", "visits"],
            )

    return df.select("ord", "unit").mapInArrow(
        run, "ord bigint, unit array<double>, visits array<int>"
    ).select("ord", "unit", F.explode("visits").alias("cell"))


def vector_search(golden: DataFrame, corpus: DataFrame, results: DataFrame, k: int) -> DataFrame:
    """Distractors from a ranked results table of an outside search service.

    ``results`` has (golden_ord, ord, rank, score). The row itself and rows the
    corpus does not hold are left out before the cut at k, however long a
    service's list is; the score stays.
    """
    usable = (
        results.filter(F.col("ord") != F.col("golden_ord"))
        .join(golden.select(F.col("ord").alias("golden_ord")), "golden_ord", "left_semi")
        .join(corpus.select("ord"), "ord", "left_semi")
        .withColumnRenamed("rank", "service_rank")
    )
    ranked = top_k(usable, ["golden_ord"], [F.asc("service_rank"), F.asc("ord")], k)
    return ranked.select("golden_ord", "ord", F.col("score").alias("sim"), "rank")


Strategy = Callable[[DataFrame, DataFrame, int, Options], DataFrame]


def search_strategy(name: str, results: DataFrame | None = None, index: str | None = None) -> Strategy:
    """Neighbour search by name. Any function of the same shape can stand in for it.

    ``ivf`` searches the index at ``index`` if one is named, and reads rows of it that the corpus does not hold as
    well; without it, one is built for the search.
    """
    from .hybrid import hybrid_search
    from .vector_index import open_index

    def saved(golden, corpus, k, options):
        return open_index(golden.sparkSession, index).search(golden, k, options)

    def external(golden, corpus, k, options):
        if results is None:
            raise ValueError("strategy 'external' needs a results table")
        return vector_search(golden, corpus, results, k)

    known: dict[str, Strategy] = {
        "exact": knn_join,
        "ivf": knn_ivf if index is None else saved,
        "hybrid": hybrid_search,
        "external": external,
    }
    if name not in known:
        raise ValueError(f"unknown search strategy {name!r}; expected one of {sorted(known)}")
    return known[name]
