"""Metric cells: how vector joins are spread over the cluster.

Unit vectors are assigned to the nearest of a few pivots (a sample of the data).
Two vectors within chord distance R of each other meet when one of them visits,
besides its own cell, every cell whose boundary is within R. The test is the
distance to the hyperplane between the two pivots together with the range of
distances the cell's members have to their pivot, both exact consequences of the
triangle inequality, so nothing within R is missed.

There are at most ``max_pivots`` such pivots, as every task gets them. Cells decide what a row has to
meet, bins what is sent: neighbouring cells are put together into about sixteen bins, more only where their bytes ask for
them, and a row is sent once to each bin that holds a cell it visits. So no row has more copies because
the table is larger; what a bin holds besides is left out inside the task (:func:`near`).

Bins that hold more than two blocks, one cell of a dense crowd, are divided again, by pivots of their own that lie in a
table next to the bin's rows and are sent to no other bin. What is still larger than a block is cut into
blocks; one task group holds one block of each side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import MIN_NORM, SIM_DIGITS
from ..options import Options
from ..session import settle
from .sampling import bucket_counts, cut_sample

SLACK = 1e-4  # added to every distance bound; covers rounding of cosines near 1
_TIE = 1e-9  # the same for a difference of two cosines
_ROWS = 1024  # rows per matrix product when the other side is no larger than the pivots
_PRODUCT = 4_000_000  # entries of a similarity matrix held at once


def points_of(df: DataFrame) -> DataFrame:
    """(ord, embedding) of the rows that have a vector."""
    return df.select("ord", F.col("embedding").cast("array<double>").alias("embedding")).filter(
        F.size("embedding") > 0
    )


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.maximum(norms, MIN_NORM)[:, None]


def list_column(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def slice_rows(width: int) -> int:
    """Rows to multiply at a time against ``width`` others."""
    return max(16, _PRODUCT // max(width, 1))


def at_least(cosine: np.ndarray, limit: float | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the entries that reach ``limit``.

    Values are rounded, so that copies tie whatever the block shape; only the
    few entries near or above the limit are, not the whole product.
    """
    row, column = np.nonzero(cosine >= limit - _TIE)
    value = np.round(cosine[row, column], SIM_DIGITS)
    bound = limit[row, 0] - _TIE if isinstance(limit, np.ndarray) else limit
    keep = value >= bound
    return row[keep], column[keep], value[keep]


def inner_cells(members: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """A block divided once more, inside the task: pivots, the rows of each, and the range of their distances."""
    pivots = members[:: max(1, math.isqrt(len(members)))]
    cell, best = np.empty(len(members), np.int64), np.empty(len(members))
    for start in range(0, len(members), _ROWS):
        cosine = members[start : start + _ROWS] @ pivots.T
        cell[start : start + _ROWS] = cosine.argmax(axis=1)
        best[start : start + _ROWS] = cosine.max(axis=1)
    dist = np.sqrt(np.maximum(2 - 2 * best, 0))
    order = np.argsort(cell, kind="stable")
    held = np.unique(cell)
    rows = np.split(order, np.searchsorted(cell[order], held[1:]))
    low, high = (np.array([f(dist[r]) for r in rows]) for f in (np.min, np.max))
    return pivots[held], rows, low, high


def may_hold(cosine: np.ndarray, pivots: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray | float) -> np.ndarray:
    """Which cells can hold something within ``reach`` of rows with these cosines to their pivots."""
    lead = cosine.argmax(axis=1)
    gaps = np.sqrt(np.maximum(2 - 2 * pivots[lead] @ pivots.T, 0))
    ahead = cosine[np.arange(len(lead)), lead][:, None] - cosine
    dist = np.sqrt(np.maximum(2 - 2 * cosine, 0))
    return (ahead <= reach * gaps + _TIE) & (dist - reach <= high) & (dist + reach >= low)


def near(members: np.ndarray, visitors: np.ndarray, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(visitor, member, similarity) of all pairs of two blocks that reach ``limit``, some visitors at a time.

    Members are divided into small cells first; a product is taken only with those that the bounds leave over.
    """
    if not len(members):
        return
    step = slice_rows(len(members))
    reach = math.sqrt(max(2 - 2 * limit, 0.0)) + SLACK
    pivots, rows, low, high = inner_cells(members)
    for start in range(0, len(visitors), step):
        part = visitors[start : start + step]
        visit = may_hold(part @ pivots.T, pivots, low, high, reach)
        if 2 * np.count_nonzero(visit) > visit.size:  # little to leave out
            v, m, sim = at_least(part @ members.T, limit)
            yield start + v, m, sim
            continue
        found = []
        for cell in np.flatnonzero(visit.any(axis=0)):
            who = np.flatnonzero(visit[:, cell])
            v, m, sim = at_least(part[who] @ members[rows[cell]].T, limit)
            found.append((start + who[v], rows[cell][m], sim))
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))


def choose_pivots(points: DataFrame, options: Options) -> np.ndarray:
    """Unit pivots sampled from the data; about one for ``block_rows`` rows, never above the bound.

    ``points`` may be a wider table than the one to be joined: any pivots are
    correct, and a plain table is read without the filters of the other.
    """
    first = points.select("embedding").limit(1).collect()
    dim = len(first[0]["embedding"]) if first else 1
    counts = bucket_counts(points, "ord", options.seed)
    rows = sum(n for _, n in counts)
    # By the smallest block: cells may be far smaller than the bins they are sent in.
    limit = max(1, min(options.max_pivots, options.broadcast_bytes // (8 * dim)))
    wanted = min(limit, math.ceil(rows / options.rows_per_block(dim)))
    if wanted < 2:
        return np.eye(1, dim)
    sample = cut_sample(points, "ord", options.seed, counts, wanted).select("embedding").collect()
    return np.unique(unit_rows(np.array([r["embedding"] for r in sample], dtype=float)), axis=0)


def assign_homes(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(ord, unit, cell, dist): normalised vector, nearest pivot, chord distance to it."""
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                unit = unit_rows(matrix(part.column("embedding")))
                cosine = unit @ shared.value.T
                # Rounded, so that copies always choose the same cell.
                cell = np.round(cosine, SIM_DIGITS).argmax(axis=1)
                best = cosine[np.arange(len(cell)), cell]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("ord"),
                        list_column(unit),
                        pa.array(cell.astype(np.int32)),
                        pa.array(np.sqrt(np.maximum(2 - 2 * best, 0))),
                    ],
                    ["ord", "unit", "cell", "dist"],
                )

    return points.select("ord", "embedding").mapInArrow(
        run, "ord bigint, unit array<double>, cell int, dist double"
    )


def collapse_copies(homes: DataFrame) -> DataFrame:
    """One row per distinct direction, carrying its first ``ord``.

    Map tasks collapse copies before the shuffle, so a vector held by a third of
    all rows arrives as one row per task.
    """
    return homes.groupBy("cell", "unit").agg(
        F.min("ord").alias("ord"), F.min("dist").alias("dist"), F.count("*").alias("copies")
    )


Compare = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[dict[str, np.ndarray]]]


def bins_of(pivots: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The bin of each cell: all cells, halved across their longest extent until a part holds about ``size`` rows."""
    bins, parts, number = np.zeros(len(pivots), np.int64), [np.arange(len(pivots))], 0
    while parts:
        part = parts.pop()
        total = rows[part].sum()
        if len(part) < 2 or 2 * total <= 3 * size:
            bins[part], number = number, number + 1
            continue
        one = part[(pivots[part] @ pivots[part[0]]).argmin()]
        other = part[(pivots[part] @ pivots[one]).argmin()]
        order = part[np.argsort(pivots[part] @ (pivots[one] - pivots[other]), kind="stable")]
        middle = int(np.searchsorted(np.cumsum(rows[order]), total / 2)) + 1
        middle = min(max(middle, 1), len(order) - 1)
        parts += [order[middle:], order[:middle]]
    return bins


@dataclass(frozen=True)
class Cells:
    """Per-cell figures; at most one entry per pivot, so safe to hold on the driver."""

    pivots: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: dict[int, int]
    bins: np.ndarray
    rows: dict[int, int]  # of each bin that has some

    def in_bins(self, df: DataFrame) -> DataFrame:
        """(ord, unit, cell) rows with their bin in place of their cell."""
        listed = ",".join(str(b) for b in self.bins)
        return df.select("ord", "unit", F.expr(f"element_at(array({listed}), cell + 1)").cast("int").alias("cell"))

    @staticmethod
    def measure(homes: DataFrame, pivots: np.ndarray, options: Options) -> "Cells":
        figures = (
            homes.groupBy("cell")
            .agg(
                F.count("*").alias("rows"),
                F.min("dist").alias("low"),
                F.max("dist").alias("high"),
                F.min("ord").alias("first"),
            )
            .collect()
        )
        low = np.full(len(pivots), np.inf)
        high = np.full(len(pivots), -np.inf)
        for f in figures:
            low[f["cell"]], high[f["cell"]] = f["low"], f["high"]
        rows = np.zeros(len(pivots), np.int64)
        rows[[f["cell"] for f in figures]] = [f["rows"] for f in figures]
        bins = bins_of(pivots, rows, options.rows_per_block(pivots.shape[1], int(rows.sum())))
        held = np.bincount(bins, rows).astype(np.int64)
        return Cells(
            pivots,
            low,
            high,
            {f["cell"]: f["first"] for f in figures},
            bins,
            {b: int(held[b]) for b in np.flatnonzero(held).tolist()},
        )


def with_visits(
    df: DataFrame, cells: Cells, radius: float | str, before: str | None = None, without_home: set[int] = frozenset()
) -> DataFrame:
    """Explode each row to the bins that hold a cell it has to visit.

    ``df`` has (ord, unit, cell); ``radius`` is a number or the name of a column.
    The result has (ord, unit, cell, radius) with ``cell`` the visited bin. ``before`` names a column
    with a row number; cells whose first row is not before it are not visited. Rows at home in a bin of
    ``without_home`` do not visit that one. The rows are written down once each, with the list of their visits.
    """
    context = df.sparkSession.sparkContext
    between = np.sqrt(np.maximum(2 - 2 * cells.pivots @ cells.pivots.T, 0))
    first = np.full(len(cells.pivots), np.iinfo(np.int64).max)
    first[list(cells.first)] = list(cells.first.values())
    number = int(cells.bins.max()) + 1
    in_bin = np.zeros((len(cells.pivots), number), np.float32)
    in_bin[np.arange(len(cells.pivots)), cells.bins] = 1
    met_at_home = np.isin(cells.bins, list(without_home))
    shared = context.broadcast((cells.pivots, between, cells.low, cells.high, first, in_bin, cells.bins, met_at_home))
    per_row = isinstance(radius, str)
    columns = ["ord", "unit", "cell"] + ([radius] if per_row else []) + ([before] if before else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, gaps, low, high, first, in_bin, bins, met_at_home = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                unit = matrix(part.column("unit"))
                home = part.column("cell").to_numpy()
                reach = (
                    part.column(radius).to_numpy()[:, None] if per_row else radius
                ) + SLACK
                cosine = unit @ pivots.T
                rows = np.arange(len(home))
                lead = cosine[rows, home][:, None] - cosine
                dist = np.sqrt(np.maximum(2 - 2 * cosine, 0))
                visit = (lead <= reach * gaps[home] + _TIE) & (dist - reach <= high) & (dist + reach >= low)
                if before:
                    visit &= first < part.column(before).to_numpy()[:, None]
                visited = visit.astype(np.float32) @ in_bin > 0
                visited[rows[met_at_home[home]], bins[home[met_at_home[home]]]] = False
                which, target = np.nonzero(visited)
                offsets = np.searchsorted(which, np.arange(len(home) + 1)).astype(np.int32)
                visits = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(target.astype(np.int32))
                )
                far = part.column(radius) if per_row else pa.array(np.full(len(home), radius))
                yield pa.RecordBatch.from_arrays(
                    [part.column("ord"), part.column("unit"), far, visits], ["ord", "unit", "radius", "visits"]
                )

    visited = settle(
        df.select(*columns).mapInArrow(run, "ord bigint, unit array<double>, radius double, visits array<int>")
    )
    return visited.select("ord", "unit", F.explode("visits").alias("cell"), "radius")


#: Cells a bin is divided into at most; a cell's number is that of the bin times this, plus its own.
_INSIDE = 1024
_IN_CELL = "ord bigint, unit array<double>, cell bigint"


@dataclass(frozen=True)
class Inside:
    """Members in their small cells, and the pivots of the cells that were divided."""

    members: DataFrame  # (ord, unit, cell)
    pivots: DataFrame | None  # (large, inner, unit, low, high)
    divided: tuple[int, ...]


def _with_pivots(rows: DataFrame, pivots: DataFrame, counts: dict[int, int], size: int, work, schema: str) -> DataFrame:
    """Blocks of the rows of a large cell (column ``cell``), each with the pivots inside that cell."""
    plan = [(cell, -(-n // size)) for cell, n in counts.items()]
    blocks = F.broadcast(rows.sparkSession.createDataFrame(plan, "large int, blocks int"))  # a row per large cell
    left = rows.withColumnRenamed("cell", "large").join(blocks, "large")
    left = left.withColumn("block", F.pmod(F.xxhash64("ord"), F.col("blocks")).cast("int")).drop("blocks")
    right = pivots.join(blocks, "large").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = right.select(F.col("large").alias("of"), F.col("block").alias("for"), "inner", "unit", "low", "high")
    return left.groupBy("large", "block").cogroup(right.groupBy("of", "for")).applyInArrow(work, schema)


def divide(members: DataFrame, rows: dict[int, int], options: Options, dim: int) -> Inside:
    """Divide the bins (column ``cell``) of (ord, unit, cell) rows that hold more than two blocks.

    The pivots inside are sampled by hash, about one a block. They, and the range of distances
    of their cells, stay in tables: only a row's bin ever sees them.
    """
    size = options.rows_per_block(dim, sum(rows.values()))
    large = {cell: n for cell, n in rows.items() if n > 2 * size}
    flat = members.select("ord", "unit", (F.col("cell").cast("bigint") * _INSIDE).alias("cell"))
    if not large:
        return Inside(flat, None, ())
    spark = members.sparkSession
    share = [(cell, min(_INSIDE // 2, -(-n // size)) / n) for cell, n in large.items()]
    wanted = F.broadcast(spark.createDataFrame(share, "cell int, share double"))
    drawn = F.pmod(F.xxhash64("ord", F.lit("inside")), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    of_large = members.select("ord", "unit", "cell").join(wanted, "cell")
    # About half as many as fit: a hash may draw more than wanted, and rows beyond the limit are no pivots.
    number = F.row_number().over(Window.partitionBy("cell").orderBy("ord")) - 1
    drawn = of_large.filter(drawn).groupBy("cell", "unit").agg(F.min("ord").alias("ord"))
    drawn = drawn.select(F.col("cell").alias("large"), number.alias("inner"), "unit").filter(F.col("inner") < _INSIDE)
    drawn = settle(drawn.withColumns({"low": F.lit(0.0), "high": F.lit(2.0)}))

    def assign(left: pa.Table, right: pa.Table) -> pa.Table:
        number = np.full(left.num_rows, left.column("large")[0].as_py() * _INSIDE) if left.num_rows else np.zeros(0, np.int64)
        best = np.ones(left.num_rows)
        if left.num_rows and right.num_rows:
            centres, inner = matrix(right.column("unit")), right.column("inner").to_numpy()
            order = np.argsort(inner)
            centres, inner = centres[order], inner[order]
            unit = matrix(left.column("unit"))
            for start in range(0, len(unit), _ROWS):
                cosine = unit[start : start + _ROWS] @ centres.T
                nearest = np.round(cosine, SIM_DIGITS).argmax(axis=1)
                number[start : start + _ROWS] += inner[nearest]
                best[start : start + _ROWS] = cosine[np.arange(len(nearest)), nearest]
        dist = np.sqrt(np.maximum(2 - 2 * best, 0))
        columns = [left.column("ord"), left.column("unit"), pa.array(number, pa.int64()), pa.array(dist)]
        return pa.table(columns, ["ord", "unit", "cell", "dist"])

    inside = settle(_with_pivots(of_large.drop("share"), drawn, large, size, assign, f"{_IN_CELL}, dist double"))
    ranges = inside.groupBy("cell").agg(F.min("dist").alias("low"), F.max("dist").alias("high"))
    pivots = settle(
        drawn.select("large", "inner", "unit", (F.col("large").cast("bigint") * _INSIDE + F.col("inner")).alias("cell"))
        .join(ranges, "cell")
        .drop("cell")
    )
    small = flat.filter(~F.col("cell").isin([cell * _INSIDE for cell in large]))
    return Inside(small.unionByName(inside.drop("dist")), pivots, tuple(large))


def visits_inside(visitors: DataFrame, inside: Inside, options: Options, dim: int, nearest: int = 0) -> DataFrame:
    """(ord, unit, cell) of the small cells that (ord, unit, cell, radius) rows have to visit in their bins.

    With ``nearest``, so many of the small cells that are nearest instead, and no radius is needed.
    """
    flat = visitors.select("ord", "unit", (F.col("cell").cast("bigint") * _INSIDE).alias("cell"))
    if inside.pivots is None:
        return flat

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        base = left.column("large")[0].as_py() * _INSIDE if left.num_rows else 0
        which, target = np.arange(left.num_rows), np.zeros(left.num_rows, np.int64)
        if left.num_rows and right.num_rows:
            centres, inner = matrix(right.column("unit")), right.column("inner").to_numpy()
            low, high = right.column("low").to_numpy(), right.column("high").to_numpy()
            unit, found = matrix(left.column("unit")), []
            for start in range(0, len(unit), _ROWS):
                cosine = unit[start : start + _ROWS] @ centres.T
                if nearest:
                    close = np.argsort(-cosine, axis=1, kind="stable")[:, :nearest]
                    row, column = np.repeat(np.arange(len(cosine)), close.shape[1]), close.ravel()
                else:
                    reach = left.column("radius").to_numpy()[start : start + _ROWS, None] + SLACK
                    row, column = np.nonzero(may_hold(cosine, centres, low, high, reach))
                found.append((start + row, inner[column]))
            which, target = (np.concatenate(x) for x in zip(*found))
        return pa.table(
            [left.column("ord").take(which), left.column("unit").take(which), pa.array(base + target, pa.int64())],
            ["ord", "unit", "cell"],
        )

    parted = visitors.filter(F.col("cell").isin(list(inside.divided)))
    counts = rows_per_cell(parted)
    if not counts:
        return flat
    size = options.rows_per_block(dim, sum(counts.values()))
    chosen = _with_pivots(parted, inside.pivots, counts, size, choose, _IN_CELL)
    rest = flat.filter(~F.col("cell").isin([cell * _INSIDE for cell in inside.divided]))
    return rest.unionByName(chosen)


def rows_per_cell(df: DataFrame) -> dict[int, int]:
    return {r["cell"]: r["count"] for r in df.groupBy("cell").count().collect()}


def block_join(
    members: DataFrame,
    visitors: DataFrame,
    options: Options,
    compare: Compare,
    dim: int,
    schema: str,
) -> DataFrame:
    """Bring members and visitors of a cell together, one block of each at a time.

    Both sides carry (ord, unit, cell). ``compare`` gets the ord and matrix of a
    member block and of a visitor block and yields only what passes its test,
    slice by slice, so neither all products nor all results are held at once.
    """
    spark = members.sparkSession
    asked = visitors.groupBy("cell").agg(F.count("*").alias("visitors"))
    held = members.groupBy("cell").agg(F.count("*").alias("members"))
    counted = settle(held.join(asked, "cell"))
    met, most = counted.agg(F.sum("members"), F.max("visitors")).first()
    rows = max(met or 0, most or 0)
    # Fewer and larger blocks of visitors: members are sent once for each of them.
    size, longer = options.rows_per_block(dim, rows), options.rows_per_block(dim, 4 * rows)
    blocks = lambda count, size: F.ceil(F.col(count) / size).cast("int")
    plan = counted.withColumns({"member_blocks": blocks("members", size), "visitor_blocks": blocks("visitors", longer)})
    groups, rows = plan.agg(
        F.sum(F.expr("bigint(member_blocks) * visitor_blocks")), F.sum(F.expr("members * visitor_blocks + visitors * member_blocks"))
    ).first()
    blocks_of = plan.drop("members", "visitors")
    own = lambda count: F.pmod(F.xxhash64("ord"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = members.join(blocks_of, "cell").select(
        "cell",
        own("member_blocks").alias("member_block"),
        every("visitor_blocks").alias("visitor_block"),
        F.lit(True).alias("is_member"),
        "ord",
        "unit",
    )
    right = visitors.join(blocks_of, "cell").select(
        "cell",
        every("member_blocks").alias("member_block"),
        own("visitor_blocks").alias("visitor_block"),
        F.lit(False).alias("is_member"),
        "ord",
        "unit",
    )
    names = [field.split()[0] for field in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))  # at most one block of each side
        is_member = table.column("is_member").to_numpy()
        ords = table.column("ord").to_numpy()
        vectors = matrix(table.column("unit"))
        for found in compare(ords[is_member], vectors[is_member], ords[~is_member], vectors[~is_member]):
            yield pa.RecordBatch.from_arrays([pa.array(found[name]) for name in names], names)

    # As many tasks as the rows that are sent ask for, not as there are groups.
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_size = math.ceil((rows or 0) * dim * 8 / options.block_bytes)
    tasks = max(1, min(groups or 0, max(configured, by_size)))
    keys = ["cell", "member_block", "visitor_block"]
    return left.unionByName(right).repartition(tasks, *keys).groupBy(*keys).applyInArrow(run, schema)


def cell_join(
    members: DataFrame,
    visitors: DataFrame,
    member_rows: dict[int, int],
    options: Options,
    compare: Compare,
    dim: int,
    schema: str,
) -> DataFrame:
    """:func:`block_join` of (ord, unit, cell) members with (ord, unit, cell, radius) visitors of their bins, by small cells."""
    inside = divide(members, member_rows, options, dim)
    return block_join(inside.members, visits_inside(visitors, inside, options, dim), options, compare, dim, schema)
