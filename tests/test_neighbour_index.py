"""The stored neighbour index: its tree of pivots, rows that come later, what it stores, what a search measures."""

from __future__ import annotations

import numpy as np
import pytest

from wattsift.operators import neighbours
from wattsift.operators.neighbours import (
    Cells,
    PivotTree,
    add_rows,
    build_index,
    fit_outlier_factor,
    load_index,
    load_outlier_factor,
    save_index,
    save_outlier_factor,
    score_outlier_factor,
    search_index,
)
from wattsift.session import scratch_path


def _frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, features array<double>")


def _plain(q, t, k, skip=False):
    d = np.sqrt(((q[:, None] - t[None]) ** 2).sum(2))
    if skip:
        np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :k]


def _found(pairs, k):
    return pairs.toPandas().sort_values(["row_id", "rank"])["neighbour_id"].to_numpy().reshape(-1, k)


@pytest.mark.parametrize("pivots", [1, 2, 40, 500])
def test_the_tree_finds_what_all_pivots_would(pivots):
    rng = np.random.default_rng(pivots)
    line = np.cumsum(rng.normal(size=(3000, 3)) * 0.2, axis=0)
    chosen = line[rng.choice(3000, pivots, replace=False)]
    chosen = chosen[neighbours._chained(chosen)]
    chosen = np.vstack([chosen, chosen[:1]])  # a pivot that stands twice: the first one has the rows
    gaps = np.sqrt(((line[:, None] - chosen[None]) ** 2).sum(2))
    own = gaps.argmin(1)
    counts = np.bincount(own, minlength=len(chosen))
    radius = np.array([gaps[own == c, c].max() if counts[c] else 0.0 for c in range(len(chosen))])
    tree = PivotTree.over(Cells(chosen, counts, radius))
    found, near, measured = tree.nearest(line)
    assert np.allclose(near, gaps.min(1), atol=1e-6) and np.allclose(gaps[np.arange(3000), found], gaps.min(1), atol=1e-6)
    reach = np.full(3000, 0.3)
    cells, needed, more = tree.wanted(line, found, near, reach)
    within = np.sqrt(((line[:, None] - line[None]) ** 2).sum(2)) <= 0.3
    assert set(own[within.any(0)]) <= set(np.flatnonzero(cells))
    assert needed >= sum(len(set(own[w])) for w in within[:200])
    if pivots == 500:  # both walks together measure less than each comparing with all pivots
        assert measured + more < 3000 * 500


@pytest.mark.parametrize("slice_rows", [32_768, 100])
def test_rows_that_come_later(spark, monkeypatch, slice_rows):
    """Three layers, a stored index read in between, copies over the layers, rows far from every pivot."""
    monkeypatch.setattr(neighbours, "SLICE_ROWS", slice_rows)
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(150, 4)) * 3, rng.normal(size=(60, 4)) + 40, np.repeat(rng.normal(size=(1, 4)), 90, 0)])
    x = x[rng.permutation(len(x))]
    index, path = build_index(_frame(spark, x[:120]), 6), scratch_path(spark, "index")
    index = add_rows(index, _frame(spark, x[120:121], 120))
    save_index(index, path)
    index = add_rows(load_index(spark, path), _frame(spark, x[121:], 121))
    index = add_rows(index, _frame(spark, x[:1]).limit(0))
    assert len(index.layers) == 3 and sum(int(layer.counts.sum()) for layer in index.layers) <= len(x)
    assert np.array_equal(_found(search_index(_frame(spark, x), index, 5, True)[0], 5), _plain(x, x, 5, True))
    fresh = rng.normal(size=(50, 4)) * 20
    assert np.array_equal(_found(search_index(_frame(spark, fresh), index, 6)[0], 6), _plain(fresh, x, 6))
    with pytest.raises(ValueError, match="up to 6"):
        search_index(_frame(spark, fresh), index, 7)


def test_fewer_rows_than_neighbours(spark):
    index = build_index(_frame(spark, np.eye(3)), 9)
    assert search_index(_frame(spark, np.zeros((2, 3))), index, 9)[0].count() == 6
    with pytest.raises(ValueError, match="no rows"):
        build_index(_frame(spark, np.eye(3)).limit(0), 2)


def test_measured_distances_grow_slower_than_the_pivots(spark):
    rng = np.random.default_rng(1)
    costs = []
    for n in (1_000, 16_000):
        x = rng.uniform(size=(n, 2))
        data = _frame(spark, x)
        line = search_index(data, build_index(data, 4), 3, True)[1].selectExpr("sum(measured * n) / sum(n)", "max(cells)").first()
        costs.append(tuple(line))
    (few, small), (many, large) = costs
    assert large / small >= 3.9 and many / few < 2.5


def test_a_stored_outlier_factor_scores_the_same(spark):
    rng = np.random.default_rng(8)
    data, path = _frame(spark, rng.normal(size=(200, 3))), scratch_path(spark, "lof")
    model = fit_outlier_factor(data, k=9)
    save_outlier_factor(model, path)
    asked = _frame(spark, rng.normal(size=(40, 3)))
    pair = [score_outlier_factor(asked, m).orderBy("row_id").toPandas() for m in (model, load_outlier_factor(spark, path))]
    assert np.allclose(pair[0]["score_samples"], pair[1]["score_samples"])


def test_cell_meets_only_the_queries_that_reach_it(monkeypatch):
    """Far groups of rows in one slice: a block of queries from all of them measures each against its own group only."""
    rng, groups, each = np.random.default_rng(5), 8, 64
    centres = np.eye(groups) * 1_000.0
    x = (centres[:, None, :] + rng.normal(size=(groups, each, groups))).reshape(-1, groups)
    part = neighbours.Slice.of(centres, np.repeat(np.arange(groups), each), x, np.arange(len(x)))
    spent, spots = [], neighbours._true_spots
    monkeypatch.setattr(neighbours, "_true_spots", lambda mask: spent.append(mask.size) or spots(mask))
    qi, ti, d = neighbours._search(x, np.full(len(x), 20.0), part, 5)
    gaps = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    assert np.allclose(d.reshape(-1, 5), np.sort(gaps, axis=1)[:, :5])
    assert sum(spent) == groups * each * each


def test_rows_near_most_leaves_meet_all_pivots_at_once(monkeypatch):
    """In many dimensions no leaf can be left out: a row is then taken up a few times, not once per node of the tree."""
    rng = np.random.default_rng(11)
    pivots = rng.normal(size=(600, 20))
    pivots = pivots[neighbours._chained(pivots)]
    x = rng.normal(size=(1_500, 20))
    gaps = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2))
    counts = np.bincount(gaps.argmin(1), minlength=600)
    radius = np.array([gaps[gaps.argmin(1) == c, c].max() if counts[c] else 0.0 for c in range(600)])
    tree = PivotTree.over(Cells(pivots, counts, radius))
    taken, measure = [], neighbours._distances
    monkeypatch.setattr(neighbours, "_distances", lambda a, b: taken.append(len(a)) or measure(a, b))
    own, near, _ = tree.nearest(x)
    assert np.array_equal(own, gaps.argmin(1)) and np.allclose(near, gaps.min(1))
    assert sum(taken) <= 4 * len(x)
    taken.clear()
    found, needed, _ = tree.wanted(x, own, near, np.full(len(x), 3.0))
    assert sum(taken) <= 4 * len(x) and set(own) <= set(np.flatnonzero(found)) and needed <= 600 * len(x)
    within = np.sqrt(((x[:200, None] - x[None]) ** 2).sum(2)) <= 3.0
    assert needed >= sum(len(set(own[w])) for w in within)
