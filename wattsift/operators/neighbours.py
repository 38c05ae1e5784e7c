"""Exact k nearest neighbours (Euclidean) and the local outlier factor.

Training rows are cut into cells around about sqrt(n) pivots, cells that lie close together into slices of
bounded size.  The pivots are the leaves of a tree of balls: a row is compared with the centres of the leaves and then
with the pivots of few of them, or with all pivots at once where most leaves would be looked into.  Queries are packed by the slice of their home cell and meet the rows in two rounds.  The
first searches the home slice, which bounds how far the k-th neighbour can be.  The second visits only slices with a
cell that may hold a nearer row, and in them only such cells.  Rows and queries travel as packed blocks; a cell
with any share of the rows is spread over as many slices as it needs.

A ``NeighbourIndex`` is stored: built once, it serves any number of searches, and rows that come later are added as
a layer of slices of their own, without a look at the rows it has.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.functions.batches import matrix, one_thread
from wattsift.operators.donors import small
from wattsift.operators.order_stats import DIRECT_ROWS, exact_quantiles
from wattsift.operators.sample import sample_exact
from wattsift.session import materialise

SLICE_ROWS = 32_768
PACK_ROWS = 8_192
BLOCK_ROWS = 4_096
PAIRS_AT_ONCE = 2_000_000
QUERY_BLOCK = 256
REACH_BLOCK = 2_048
TILE_ROWS = 2048
MERGE_PAIRS = 100_000
LEAF_PIVOTS = 16
TREE_ROWS = 1_024
DENSE_ROWS = 128


# ---- per-batch arithmetic ----


def _rounding(width: int) -> float:
    """Relative error to allow for in a float32 product over ``width`` terms."""
    return 2e-7 * (width + 8)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _slack(x: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """What rounding may add to a distance of each row."""
    return 1e-6 * (1.0 + np.sqrt((x * x).sum(1)) + np.where(np.isfinite(reach), reach, 0.0))


@dataclass(frozen=True)
class Cells:
    """Pivots and, per cell, the number of rows and the radius."""

    pivots: np.ndarray
    counts: np.ndarray
    radius: np.ndarray

    def own(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gaps = _distances(x, self.pivots)
        return gaps.argmin(axis=1), gaps

    def within(self, x: np.ndarray, home: np.ndarray, mine: np.ndarray, gaps: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """rows x cells mask of the cells that may hold a row within ``reach`` of each query.

        ``home`` is each query's nearest pivot and ``mine`` its distance.  A cell is out of reach when its ball is, or
        when the plane halfway to its pivot is.
        """
        between = _distances(home, self.pivots)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(between > 0, (gaps**2 - mine[:, None] ** 2) / (2.0 * between), 0.0)
        nearest = np.maximum(gaps - self.radius[None, :], plane)
        return (nearest <= (reach + _slack(x, reach))[:, None]) & (self.counts > 0)[None, :]

    def reach(self, gaps: np.ndarray, k: int) -> np.ndarray:
        """A distance within which each query surely has k rows: whole balls, the nearest first."""
        far = np.where(self.counts > 0, gaps + self.radius, np.inf)
        order = np.argsort(far, axis=1)
        held = np.cumsum(self.counts[order], axis=1) >= k
        place = held.argmax(axis=1)
        rows = np.arange(len(gaps))
        return np.where(held[rows, place], far[rows, order[rows, place]], np.inf)


@dataclass(frozen=True)
class PivotTree:
    """Halves of the line of chained pivots, again and again; a node is a ball around the mean of its pivots."""

    cells: Cells
    ranges: np.ndarray  # per node: its first pivot and the one after its last
    children: np.ndarray  # per node: two nodes, -1 at a leaf
    centres: np.ndarray
    spans: np.ndarray  # distance of the farthest pivot
    reaches: np.ndarray  # bound of the distance of the farthest row in its cells

    @staticmethod
    def over(cells: Cells) -> PivotTree:
        ranges, children, todo = [(0, len(cells.pivots))], [(-1, -1)], [0]
        while todo:
            node = todo.pop()
            lo, hi = ranges[node]
            if hi - lo > LEAF_PIVOTS:
                middle, new = lo + (hi - lo) // 2, len(ranges)
                ranges += [(lo, middle), (middle, hi)]
                children[node] = (new, new + 1)
                children += [(-1, -1)] * 2
                todo += [new, new + 1]
        centres, spans, reaches = [], [], []
        for lo, hi in ranges:
            centre = cells.pivots[lo:hi].mean(0)
            away = np.sqrt(((cells.pivots[lo:hi] - centre) ** 2).sum(1))
            held = cells.counts[lo:hi] > 0
            centres.append(centre)
            spans.append(away.max())
            reaches.append((away + cells.radius[lo:hi])[held].max() if held.any() else -np.inf)
        return PivotTree(cells, np.array(ranges), np.array(children), np.array(centres), np.array(spans), np.array(reaches))

    @functools.cached_property
    def leaves(self) -> np.ndarray:
        nodes = np.flatnonzero(self.children[:, 0] < 0)
        return nodes[np.argsort(self.ranges[nodes, 0])]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest pivot of each row, its distance, and the number of distances measured.

        Each row first looks into the leaf with the nearest centre, then into every leaf whose ball may hold a nearer
        pivot; rows that would look into most leaves are compared with all pivots in one product instead.
        """
        own, near, measured = np.zeros(len(x), np.int64), np.full(len(x), np.inf), 0
        leaves, pivots = self.leaves, self.cells.pivots
        for start in range(0, len(x), TREE_ROWS):
            part, o, d = (v[start : start + TREE_ROWS] for v in (x, own, near))
            gaps = _distances(part, self.centres[leaves])
            first = gaps.argmin(axis=1)
            measured += gaps.size + self._look(part, first[:, None] == np.arange(len(leaves)), o, d)
            taken = gaps - self.spans[leaves] <= (d + _slack(part, d))[:, None]
            taken[np.arange(len(part)), first] = False
            if 2 * np.count_nonzero(taken) < taken.size:
                measured += self._look(part, taken, o, d)
                continue
            for low in range(0, len(part), DENSE_ROWS):
                gaps = _distances(part[low : low + DENSE_ROWS], pivots)
                o[low : low + DENSE_ROWS], d[low : low + DENSE_ROWS] = gaps.argmin(axis=1), gaps.min(axis=1)
                measured += gaps.size
        return own, near, measured

    def _look(self, x: np.ndarray, asked: np.ndarray, own: np.ndarray, near: np.ndarray) -> int:
        """Pivots of the leaves that rows ask for (rows x leaves), put into ``own`` and ``near`` where they are nearer."""
        measured = 0
        for i in np.flatnonzero(asked.any(axis=0)):
            rows, (lo, hi) = np.flatnonzero(asked[:, i]), self.ranges[self.leaves[i]]
            gaps = _distances(x[rows], self.cells.pivots[lo:hi])
            measured += gaps.size
            place = gaps.argmin(axis=1)
            gap, place = gaps[np.arange(len(rows)), place], place + lo
            better = (gap < near[rows]) | ((gap == near[rows]) & (place < own[rows]))
            own[rows[better]], near[rows[better]] = place[better], gap[better]
        return measured

    def wanted(self, x: np.ndarray, own: np.ndarray, near: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, int, int]:
        """Cells that may hold a row within reach of any of the queries, their number summed over the queries, and the
        number of distances measured."""
        cells, found, needed, measured = self.cells, np.zeros(len(self.cells.counts), bool), 0, 0
        far, leaves = reach + _slack(x, reach), self.leaves
        sizes = self.ranges[leaves, 1] - self.ranges[leaves, 0]
        for start in range(0, len(x), TREE_ROWS):
            some = np.arange(start, min(start + TREE_ROWS, len(x)))
            gaps = _distances(x[some], self.centres[leaves])
            measured += gaps.size
            taken = gaps - self.reaches[leaves] <= far[some][:, None]
            if 2 * np.count_nonzero(taken) >= taken.size:
                for low in range(0, len(some), DENSE_ROWS):
                    rows = some[low : low + DENSE_ROWS]
                    mask = cells.within(x[rows], cells.pivots[own[rows]], near[rows], _distances(x[rows], cells.pivots), reach[rows])
                    mask &= np.repeat(taken[low : low + DENSE_ROWS], sizes, axis=1)
                    found |= mask.any(axis=0)
                    needed, measured = needed + int(np.count_nonzero(mask)), measured + mask.size
                continue
            for i in np.flatnonzero(taken.any(axis=0)):
                rows, span = some[taken[:, i]], slice(*self.ranges[leaves[i]])
                part = Cells(cells.pivots[span], cells.counts[span], cells.radius[span])
                mask = part.within(x[rows], cells.pivots[own[rows]], near[rows], _distances(x[rows], part.pivots), reach[rows])
                found[span] |= mask.any(axis=0)
                needed, measured = needed + int(mask.sum()), measured + mask.size
        return found, needed, measured


def _top(q: np.ndarray, t: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, training row, distance) of the k nearest per query, ties by id, in that order.

    Matrix products preselect with a margin; the kept pairs are measured again by differences.
    """
    k = min(k, len(t))
    step = max(1, PAIRS_AT_ONCE // max(len(t), 1))
    tt = (t * t).sum(1)
    out = []
    for start in range(0, len(q), step):
        part = q[start : start + step]
        qq = (part * part).sum(1)
        squared = tt[None, :] - 2.0 * (part @ t.T)
        kth = np.partition(squared, k - 1, axis=1)[:, k - 1]
        margin = 1e-9 * (qq + tt.max() + 1.0)
        qi, ti = np.nonzero(squared <= (kth + margin)[:, None])
        exact = np.sqrt(((part[qi] - t[ti]) ** 2).sum(1))
        order = np.lexsort((ids[ti], exact, qi))
        qi, ti, exact = qi[order], ti[order], exact[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = place < k
        out.append((qi[keep] + start, ti[keep], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, int),) * 2 + (np.empty(0),)


def _merge(found, fresh, ids: np.ndarray, k: int):
    """The k best per query of two lists of (query row, training row, distance)."""
    qi, ti, d = (np.concatenate(pair) for pair in zip(found, fresh, strict=True))
    order = np.lexsort((ids[ti], d, qi))
    qi, ti, d = qi[order], ti[order], d[order]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[keep], ti[keep], d[keep]


def _true_spots(mask: np.ndarray) -> np.ndarray:
    """Flat positions of the few true entries; eight are tested at a time where the size allows."""
    flat = mask.ravel()
    if len(flat) % 8:
        return np.flatnonzero(flat)
    words = np.flatnonzero(flat.view(np.uint64))
    word, bit = np.nonzero(flat.reshape(-1, 8)[words])
    return words[word] * 8 + bit


def _tiles(mask: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """The queries that ask for a cell by ``mask`` (queries x cells), and row ranges of at most TILE_ROWS of the cell."""
    for c in np.flatnonzero(mask.any(axis=0)):
        asking, end = np.flatnonzero(mask[:, c]), int(starts[c] + counts[c])
        for lo in range(int(starts[c]), end, TILE_ROWS):
            yield asking, lo, min(lo + TILE_ROWS, end)


@dataclass(frozen=True)
class Slice:
    """Rows of some cells in memory, sorted by cell."""

    cells: Cells
    x: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    wide: np.ndarray  # float32, with squared norms

    @staticmethod
    def of(pivots: np.ndarray, cell: np.ndarray, x: np.ndarray, ids: np.ndarray) -> Slice:
        present, own = np.unique(cell, return_inverse=True)
        order = np.lexsort((ids, own))
        x, ids, own = x[order], ids[order], own[order]
        counts = np.bincount(own, minlength=len(present))
        starts = np.cumsum(counts) - counts
        away = np.sqrt(((x - pivots[present][own]) ** 2).sum(1))
        cells = Cells(pivots[present], counts, np.maximum.reduceat(away, starts))
        wide = np.empty((len(x), x.shape[1] + 1), np.float32)
        wide[:, :-1], wide[:, -1] = x, (x * x).sum(1) * (1.0 - _rounding(x.shape[1]))
        return Slice(cells, x, ids, starts, wide)


def _search_block(q: np.ndarray, reach: np.ndarray, part: Slice, k: int):
    """(query row, slice row, distance) of the k nearest in the slice, at most ``reach`` away, of a block of queries.

    Where no reach is known yet the home cells give a first one.  Every cell meets only the queries whose reach it is
    within, in tiles, where a float32 product only has to name the few pairs within the bound (with its rounding
    error allowed for).  Named pairs are measured exactly and tighten the bound as the sweep goes on.
    """
    cells, x, ids = part.cells, part.x, part.ids
    own, gaps = cells.own(q)
    best = (np.empty(0, int), np.empty(0, int), np.empty(0))
    home = np.empty(0, int)
    if not np.isfinite(reach).all():
        home = np.unique(own)
        if cells.counts[home].sum() < k:
            by_gap = np.argsort(gaps.min(axis=0))
            near = int(np.searchsorted(np.cumsum(cells.counts[by_gap]), k)) + 1
            home = np.unique(np.concatenate([home, by_gap[:near]]))
        members = np.concatenate([np.arange(part.starts[c], part.starts[c] + cells.counts[c]) for c in home])
        qi, ti, d = _top(q, x[members], ids[members], k)
        best = (qi, members[ti], d)
        if len(members) == len(x):
            return best
    qq, slack = (q * q).sum(1), _rounding(q.shape[1])
    lifted = np.concatenate([-2.0 * q, np.ones((len(q), 1))], axis=1).astype(np.float32)

    def bound() -> np.ndarray:
        full = reach.copy()
        ends = np.searchsorted(best[0], np.arange(len(q)), "right")
        complete = ends - np.searchsorted(best[0], np.arange(len(q))) >= k
        full[complete] = np.minimum(full[complete], best[2][ends[complete] - 1])
        return full

    def limit(radius: np.ndarray) -> np.ndarray:
        return (radius**2 * (1 + 1e-9) - qq * (1.0 - slack) + slack).astype(np.float32)[:, None]

    radius = bound()
    mask = cells.within(q, cells.pivots[own], gaps.min(axis=1), gaps, radius)
    mask[:, home] = False
    threshold, fresh, pending = limit(radius), [], 0
    for asking, lo, hi in _tiles(mask, part.starts, cells.counts):
        hit = _true_spots(lifted[asking] @ part.wide[lo:hi].T <= threshold[asking])
        if len(hit):
            hq, ht = asking[hit // (hi - lo)], hit % (hi - lo) + lo
            fresh.append((hq, ht, np.sqrt(((q[hq] - x[ht]) ** 2).sum(1))))
            pending += len(hit)
        if pending > MERGE_PAIRS:
            best = _merge(best, tuple(np.concatenate(f) for f in zip(*fresh, strict=True)), ids, k)
            threshold, fresh, pending = limit(bound()), [], 0
    if fresh:
        best = _merge(best, tuple(np.concatenate(f) for f in zip(*fresh, strict=True)), ids, k)
    inside = best[2] <= (reach * (1 + 1e-9) + 1e-9)[best[0]]
    return tuple(b[inside] for b in best)


def _search(q: np.ndarray, reach: np.ndarray, part: Slice, k: int):
    """The same for many queries, taken by home cell so that a block shares its cells."""
    order = np.argsort(part.cells.own(q)[0], kind="stable")
    found, block = [], REACH_BLOCK if np.isfinite(reach).all() else QUERY_BLOCK
    for start in range(0, len(q), block):
        rows = order[start : start + block]
        qi, ti, d = _search_block(q[rows], reach[rows], part, min(k, len(part.x)))
        found.append((rows[qi], ti, d))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


# ---- rows and queries in slices ----


def fold_copies(train: DataFrame, keep: int, salts: int = 64) -> DataFrame:
    """At most ``keep`` rows per distinct vector, those with the smallest ids.

    Ties are broken by id, so no other copy can be among the ``keep`` nearest of any query.  Copies are
    thinned per salt first, so that a vector shared by a third of the table is spread over many tasks.
    """
    vector = [F.xxhash64("features").alias("__hash")]
    salted = train.select("row_id", "features", *vector).withColumn("__salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)))
    first = Window.partitionBy("__hash", "features", "__salt").orderBy("row_id")
    thinned = salted.withColumn("__place", F.row_number().over(first)).filter(F.col("__place") <= keep)
    last = Window.partitionBy("__hash", "features").orderBy("row_id")
    return thinned.withColumn("__place", F.row_number().over(last)).filter(F.col("__place") <= keep).select("row_id", "features")


def _spot(before: np.ndarray, counts: np.ndarray, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """A place for each row in the line of all rows by cell; rows of a cell are spread over its stretch by their id."""
    with np.errstate(over="ignore"):
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    share = (mixed >> np.uint64(11)).astype(float) / 2.0**53
    return before[cell] + np.minimum((share * counts[cell]).astype(np.int64), np.maximum(counts[cell] - 1, 0))


def _chained(pivots: np.ndarray) -> np.ndarray:
    """Pivots in an order that keeps near ones together: halves along the widest direction, again and again."""
    out, todo = [], [np.arange(len(pivots))]
    while todo:
        part = todo.pop()
        if len(part) < 3:
            out.append(part)
            continue
        x = pivots[part] - pivots[part].mean(0)
        line = x @ x[np.argmax((x * x).sum(1))]
        order = part[np.argsort(line, kind="stable")]
        todo += [order[len(order) // 2 :], order[: len(order) // 2]]
    return np.concatenate(out)


_PACKED = "n long, ids binary, vectors binary"


def _pack(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """One row per key with the ids and vectors of all its rows; callers bound the rows per key."""
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row_id")
        vectors = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        columns = [table.column(k).slice(0, 1) for k in keys]
        blobs = [pa.array([table.num_rows], pa.int64()), pa.array([table.column("row_id").to_numpy().tobytes()], pa.binary())]
        return pa.table([*columns, *blobs, pa.array([np.asarray(vectors, float).tobytes()], pa.binary())], names=[*keys, "n", "ids", "vectors"])

    return rows.select(*keys, "row_id", "features").groupBy(*keys).applyInArrow(pack, f"{kinds}, {_PACKED}")


def _arrays(row: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], float).reshape(-1, width)


def _slice_of(blocks: pa.Table, pivots: np.ndarray, width: int) -> Slice:
    cells, ids, vectors = [], [], []
    for row in blocks.select(["cell", "ids", "vectors"]).to_pylist():
        i, x = _arrays(row, width)
        cells.append(np.full(len(i), row["cell"]))
        ids.append(i)
        vectors.append(x)
    return Slice.of(pivots, np.concatenate(cells), np.concatenate(vectors), np.concatenate(ids))


# ---- the stored index ----

_PLACED = "row_id long, features array<double>, cell int, near double"
_CUT = "row_id long, features array<double>, cell int, home long, pack long"
_CELLS = "layer int, cell int, rows long, radius double, pivot array<double>"


@dataclass(frozen=True)
class Layer:
    """Rows that were put in together: their number and the farthest of them per cell, and their first slice."""

    counts: np.ndarray
    radius: np.ndarray
    first_slice: int

    @property
    def before(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    @property
    def slices(self) -> int:
        return -(-int(self.counts.sum()) // SLICE_ROWS)


@dataclass(frozen=True)
class NeighbourIndex:
    """``blocks``: packed rows by slice and cell.  It has the first ``keep`` copies of every vector of a layer, and so
    answers searches for up to that many neighbours."""

    blocks: DataFrame
    pivots: np.ndarray
    layers: tuple[Layer, ...]
    keep: int

    @property
    def cells(self) -> Cells:
        return Cells(self.pivots, sum(x.counts for x in self.layers), np.maximum.reduce([x.radius for x in self.layers]))


def _in_cells(table: DataFrame, tree: PivotTree, label: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Rows with their cell and the distance of its pivot; rows and farthest row per cell."""
    shared, cells = table.sparkSession.sparkContext.broadcast(tree), len(tree.cells.pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, near, _ = shared.value.nearest(matrix(batch))
            columns = [*batch.columns, pa.array(own.astype(np.int32)), pa.array(near)]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", "features", "cell", "near"])

    found = materialise(table.select("row_id", "features").mapInArrow(assign, _PLACED), label)
    counts, radius = np.zeros(cells, np.int64), np.zeros(cells)
    for r in found.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("near").alias("far")).collect():  # one row per pivot
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    return found, counts, radius


def _cut(placed: DataFrame, layer: Layer, counts: np.ndarray, pack_rows: int) -> DataFrame:
    """Placed rows with the slice of ``layer`` they belong to and the pack of about ``pack_rows`` of their own kind."""
    shared = placed.sparkSession.sparkContext.broadcast((layer.before, layer.counts, layer.first_slice, np.cumsum(counts) - counts, counts))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held, first, own_before, own_counts = shared.value
        for batch in batches:
            ids, cell = batch.column("row_id").to_numpy(), batch.column("cell").to_numpy()
            home = first + _spot(before, held, cell, ids) // SLICE_ROWS
            pack = _spot(own_before, own_counts, cell, ids) // pack_rows
            columns = [batch.column("row_id"), batch.column("features"), batch.column("cell"), pa.array(home.astype(np.int64)), pa.array(pack.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", "features", "cell", "home", "pack"])

    return placed.mapInArrow(cut, _CUT)


def _layer(rows: DataFrame, pivots: np.ndarray, first_slice: int) -> tuple[Layer, DataFrame]:
    empty = Cells(pivots, np.zeros(len(pivots), np.int64), np.zeros(len(pivots)))
    placed, counts, radius = _in_cells(rows, PivotTree.over(empty), "cells")
    layer = Layer(counts, radius, first_slice)
    blocks = _pack(_cut(placed, layer, counts, BLOCK_ROWS), ["home", "cell", "pack"], pivots.shape[1])
    return layer, materialise(blocks.withColumnRenamed("home", "slice").drop("pack"), "cell-blocks")


def build_index(train: DataFrame, keep: int, seed: int = 42) -> NeighbourIndex:
    """An index of all rows (``row_id`` long, ``features`` array<double> of one width) for up to ``keep`` neighbours."""
    train = materialise(fold_copies(train.select("row_id", "features"), keep), "folded")
    rows, width = train.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    if not rows:
        raise ValueError("There are no rows to be neighbours.")
    picked = sample_exact(train, math.ceil(math.sqrt(rows)), seed, "row_id").orderBy("row_id").toArrow()  # about sqrt(n) rows
    pivots = np.asarray(picked.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)
    pivots = pivots[_chained(pivots)]
    layer, blocks = _layer(train, pivots, 0)
    return NeighbourIndex(blocks, pivots, (layer,), keep)


def add_rows(index: NeighbourIndex, rows: DataFrame) -> NeighbourIndex:
    """The index with further rows, whose ids it must not have yet.  Only they are read and written.

    Pivots stay as they are, so an index that has grown many times over is better built anew.
    """
    rows = materialise(fold_copies(rows.select("row_id", "features"), index.keep), "folded")
    if rows.isEmpty():
        return index
    last = index.layers[-1]
    layer, blocks = _layer(rows, index.pivots, last.first_slice + last.slices)
    return NeighbourIndex(index.blocks.unionByName(blocks), index.pivots, (*index.layers, layer), index.keep)


def save_index(index: NeighbourIndex, path: str) -> None:
    """Blocks, and one row per layer and cell."""
    index.blocks.write.mode("errorifexists").parquet(f"{path}/blocks")
    lines = [
        (i, c, int(x.counts[c]), float(x.radius[c]), index.pivots[c].tolist()) for i, x in enumerate(index.layers) for c in range(len(index.pivots))
    ]  # about sqrt(n) of each layer
    spark = index.blocks.sparkSession
    spark.createDataFrame(lines, _CELLS).coalesce(1).write.parquet(f"{path}/cells")
    meta = [(i, x.first_slice, index.keep) for i, x in enumerate(index.layers)]
    spark.createDataFrame(meta, "layer int, first_slice long, keep int").coalesce(1).write.parquet(f"{path}/layers")


def load_index(spark: SparkSession, path: str) -> NeighbourIndex:
    meta = spark.read.parquet(f"{path}/layers").orderBy("layer").collect()
    lines = spark.read.parquet(f"{path}/cells").orderBy("layer", "cell").collect()
    cells = len(lines) // len(meta)
    layers = []
    for r in meta:
        part = lines[r["layer"] * cells : (r["layer"] + 1) * cells]
        layers.append(Layer(np.array([x["rows"] for x in part], np.int64), np.array([x["radius"] for x in part]), r["first_slice"]))
    pivots = np.array([x["pivot"] for x in lines[:cells]], float)
    return NeighbourIndex(spark.read.parquet(f"{path}/blocks"), pivots, tuple(layers), meta[0]["keep"])


def nearest(queries: DataFrame, train: DataFrame, k: int, skip_self: bool = False, seed: int = 42) -> DataFrame:
    """(row_id, neighbour_id, distance, rank) for the k nearest training rows of every query, ties by id.

    Both tables have ``row_id`` long and ``features`` array<double> of one width.
    """
    return search_index(queries, build_index(train, k + skip_self, seed), k, skip_self)[0]


def search_index(queries: DataFrame, index: NeighbourIndex, k: int, skip_self: bool = False) -> tuple[DataFrame, DataFrame]:
    """The neighbours, as ``nearest`` gives them, and a line per pack of queries: (home, pack, n, cells, needed, measured,
    slices, all_slices).  Of all cells a query had to look into ``needed`` on average, which it found by ``measured``
    distances."""
    context, want, width = queries.sparkSession.sparkContext, k + skip_self, index.pivots.shape[1]
    if want > index.keep:
        raise ValueError(f"The index answers searches for up to {index.keep} neighbours, not {want}.")
    layers, blocks = index.layers, index.blocks
    tree = PivotTree.over(index.cells)
    asked, asked_counts, _ = _in_cells(queries, tree, "cell-queries")
    # a slice travels once to each pack that visits it: packs grow with the queries while all cores still have several
    pack_rows = max(PACK_ROWS, min(SLICE_ROWS // 2, int(asked_counts.sum()) // (4 * context.defaultParallelism)))
    packs = materialise(_pack(_cut(asked, layers[0], asked_counts, pack_rows), ["home", "pack"], width), "query-packs")
    plan = context.broadcast((tree, [(x.first_slice, x.before, x.counts) for x in layers]))

    def slices_of(found: np.ndarray, parts: list) -> set[int]:
        visit: set[int] = set()
        for start, before, counts in parts:
            cells = np.flatnonzero(found & (counts > 0))
            first, last = before[cells] // SLICE_ROWS, (before[cells] + counts[cells] - 1) // SLICE_ROWS
            visit.update(start + s for lo, hi in set(zip(first.tolist(), last.tolist(), strict=True)) for s in range(lo, hi + 1))
        return visit

    def first_round(asking: pa.Table, near: pa.Table) -> pa.Table:
        one_thread()
        tree, parts = plan.value
        cells = tree.cells
        out: list[tuple] = []
        part = _slice_of(near, cells.pivots, width) if near.num_rows else None
        for row in asking.to_pylist():
            ids, q = _arrays(row, width)
            reach = np.full(len(q), np.inf)
            qi, ti, d = _search(q, reach, part, want) if part is not None else (np.empty(0, int),) * 2 + (np.empty(0),)
            complete = np.bincount(qi, minlength=len(q)) >= want
            worst = np.zeros(len(q))
            np.maximum.at(worst, qi, d)
            reach[complete] = worst[complete]
            open_ = np.flatnonzero(~complete)
            for start in range(0, len(open_), 1024):
                some = open_[start : start + 1024]
                reach[some] = cells.reach(_distances(q[some], cells.pivots), want)
            own, gap, measured = tree.nearest(q)
            found, needed, more = tree.wanted(q, own, gap, reach)
            visit = sorted(slices_of(found, parts) - {row["home"]})
            neighbours = part.ids[ti] if part is not None else ti
            costs = (needed / len(q), (measured + more) / len(q))
            out.append((row["home"], row["pack"], row["n"], reach.tobytes(), visit, *costs, ids[qi].tobytes(), neighbours.astype(np.int64).tobytes(), d.tobytes()))
        names = ["home", "pack", "n", "reach", "visit", "needed", "measured", "row_ids", "neighbour_ids", "distances"]
        kinds = [pa.int64()] * 3 + [pa.binary(), pa.list_(pa.int64()), pa.float64(), pa.float64()] + [pa.binary()] * 3
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 10, kinds, strict=True)], names=names)

    def second_round(asking: pa.Table, near: pa.Table) -> pa.Table:
        one_thread()
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if asking.num_rows and near.num_rows:
            part = _slice_of(near, plan.value[0].cells.pivots, width)
            for row in asking.to_pylist():
                ids, q = _arrays(row, width)
                qi, ti, d = _search(q, np.frombuffer(row["reach"], float).copy(), part, want)
                found.append((ids[qi], part.ids[ti], d))
        return pa.table([np.concatenate(f) for f in zip(*found, strict=True)], names=["row_id", "neighbour_id", "distance"])

    by_home = packs.withColumn("slice", F.col("home"))
    pairs = by_home.select("slice", F.col("home").alias("to_home"), F.col("pack").alias("to_pack"))
    sent = blocks.join(small(pairs, packs.count()), "slice")
    result = "home long, pack long, n long, reach binary, visit array<long>, needed double, measured double, row_ids binary, neighbour_ids binary, distances binary"
    one = materialise(by_home.groupBy("home", "pack", "slice").cogroup(sent.groupBy("to_home", "to_pack", "slice")).applyInArrow(first_round, result), "first-round")
    visits = one.select("home", "pack", "reach", F.explode("visit").alias("slice"))
    pairs = materialise(visits.select(F.col("home").alias("to_home"), F.col("pack").alias("to_pack"), "slice"), "visits")
    asked_again = packs.join(visits, ["home", "pack"])
    sent = blocks.join(small(pairs, pairs.count()), "slice")
    found = "row_id long, neighbour_id long, distance double"
    two = asked_again.groupBy("home", "pack", "slice").cogroup(sent.groupBy("to_home", "to_pack", "slice")).applyInArrow(second_round, found)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = [np.frombuffer(row["row_ids"], np.int64), np.frombuffer(row["neighbour_ids"], np.int64), np.frombuffer(row["distances"], float)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row_id", "neighbour_id", "distance"])

    both = one.select("row_ids", "neighbour_ids", "distances").mapInArrow(unpack, found).unionByName(two)
    if skip_self:
        both = both.filter(F.col("row_id") != F.col("neighbour_id"))
    order = Window.partitionBy("row_id").orderBy("distance", "neighbour_id")
    ranked = both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked, one.select("home", "pack", "n", F.lit(len(index.pivots)).alias("cells"), "needed", "measured", F.size("visit").alias("slices"), F.lit(sum(x.slices for x in layers)).alias("all_slices"))


# ---- local outlier factor ----


@dataclass(frozen=True)
class OutlierFactor:
    """``rows``: row_id, features, k_distance, density of every training row.  ``index`` holds the same rows."""

    rows: DataFrame
    k: int
    offset: float
    index: NeighbourIndex


def _mean_reach(pairs: DataFrame, reach: DataFrame) -> DataFrame:
    """Density per query: inverse mean of max(distance, the neighbour's own k-distance)."""
    farther = F.greatest(F.col("distance"), F.col("k_distance"))
    return (
        pairs.join(reach, "neighbour_id")
        .groupBy("row_id")
        .agg((1.0 / (F.avg(farther) + F.lit(1e-10))).alias("density"))
    )


def fit_outlier_factor(
    train: DataFrame,
    k: int = 35,
    contamination: float = 0.05,
    seed: int = 42,
    direct_rows: int = DIRECT_ROWS,
) -> OutlierFactor:
    rows = train.count()
    if rows < 2:
        raise ValueError("At least two rows are required.")
    k = max(1, min(k, rows - 1))
    index = build_index(train, k + 1, seed)
    pairs = materialise(search_index(train, index, k, True)[0], "neighbours")
    reach = pairs.groupBy(F.col("row_id").alias("neighbour_id")).agg(F.max("distance").alias("k_distance"))
    density = materialise(
        _mean_reach(pairs, small(reach, rows)).join(reach.withColumnRenamed("neighbour_id", "row_id"), "row_id"), "densities"
    )
    around = density.select(F.col("row_id").alias("neighbour_id"), F.col("density").alias("near"))
    factors = (
        pairs.join(small(around, rows), "neighbour_id")
        .groupBy("row_id")
        .agg(F.avg("near").alias("near"))
        .join(density, "row_id")
        .select((-F.col("near") / F.col("density")).alias("factor"))
    )
    factors = materialise(factors, "factors")
    offset = exact_quantiles(factors, {"f": F.col("factor")}, [contamination], direct_rows)["f"][0]
    return OutlierFactor(train.select("row_id", "features").join(density, "row_id"), k, offset, index)


def score_outlier_factor(queries: DataFrame, model: OutlierFactor) -> DataFrame:
    """(row_id, score_samples): minus the local outlier factor, lower is more anomalous.

    Queries are new rows: a training row asked again counts itself among its neighbours.
    """
    pairs = search_index(queries, model.index, model.k)[0]
    about = model.rows.select(F.col("row_id").alias("neighbour_id"), "k_distance", F.col("density").alias("near"))
    farther = F.greatest(F.col("distance"), F.col("k_distance"))
    return (
        pairs.join(small(about, model.rows.count()), "neighbour_id")
        .groupBy("row_id")
        .agg((-F.avg("near") * (F.avg(farther) + F.lit(1e-10))).alias("score_samples"))
    )


def save_outlier_factor(model: OutlierFactor, path: str) -> None:
    model.rows.write.mode("errorifexists").parquet(f"{path}/rows")
    save_index(model.index, f"{path}/index")
    spark = model.rows.sparkSession
    spark.createDataFrame([(model.k, model.offset)], "k int, offset double").coalesce(1).write.parquet(f"{path}/meta")


def load_outlier_factor(spark, path: str) -> OutlierFactor:
    meta = spark.read.parquet(f"{path}/meta").first()
    return OutlierFactor(spark.read.parquet(f"{path}/rows"), meta["k"], meta["offset"], load_index(spark, f"{path}/index"))
