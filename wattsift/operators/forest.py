"""Isolation forest (Liu, Ting and Zhou 2008) with trees grown and applied by Spark tasks.

Each tree takes a few hundred random rows of the whole table.  One hash of a row says how many draws fall on
it, for most rows of a large table none, and only those draws are made.  Groups of trees grow side by side.
The fitted forest is a table of nodes.  Scoring is a narrow map over Arrow batches with the nodes (bounded by
trees x subsample) shipped once per executor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.functions.batches import matrix, schema_with, with_column
from wattsift.operators.order_stats import DIRECT_ROWS, exact_quantiles
from wattsift.session import materialise

NODE_SCHEMA = "tree int, node int, feature int, threshold double, size int, depth int"
META_SCHEMA = "trees int, subsample int, features int, seed long, contamination double, offset double"
TREES_PER_GROUP = 25
_TOP = (1 << 63) - 1  # hashes are numbers from 0 to this


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame
    meta: DataFrame


def mean_path(size: np.ndarray | int) -> np.ndarray:
    """Expected path length of an unsuccessful search among ``size`` rows."""
    n = np.asarray(size, dtype=float)
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, value))


def _uniform(seed: int, tree: np.ndarray, node: np.ndarray, purpose: int) -> np.ndarray:
    """Uniforms in [0, 1) keyed by (seed, tree, node, purpose): the same on any executor and in any grouping."""
    with np.errstate(over="ignore"):
        x = np.uint64(seed & (2**63 - 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (tree.astype(np.uint64) << np.uint64(32)) ^ (node.astype(np.uint64) << np.uint64(8)) ^ np.uint64(purpose)
        for multiplier in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(30))) * np.uint64(multiplier)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) / float(2**53)


def _grow(trees: np.ndarray, values: np.ndarray, seed: int, limit: int) -> pd.DataFrame:
    """All trees of a group, one depth at a time; nodes are numbered as in a heap from 1."""
    node = np.ones(len(trees), dtype=np.int64)
    found: list[pd.DataFrame] = []
    for depth in range(limit + 1):
        if not len(trees):
            break
        order = np.lexsort((node, trees))
        trees, node, values = trees[order], node[order], values[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(trees) != 0) | (np.diff(node) != 0)])
        sizes = np.diff(np.r_[starts, len(trees)])
        t, k = trees[starts], node[starts]
        low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
        varied = high > low
        choices = varied.sum(axis=1)
        splits = (sizes > 1) & (choices > 0) & (depth < limit)
        # pick the n-th varied feature, then a threshold between its bounds
        nth = np.floor(_uniform(seed, t, k, 1) * np.maximum(choices, 1)).astype(int)
        feature = np.argmax(np.cumsum(varied, axis=1) > nth[:, None], axis=1)
        rows = np.arange(len(starts))
        lo, hi = low[rows, feature], high[rows, feature]
        cut = lo + _uniform(seed, t, k, 2) * (hi - lo)
        cut = np.where(cut >= hi, lo, cut)
        found.append(
            pd.DataFrame(
                {
                    "tree": t.astype(np.int32),
                    "node": k.astype(np.int32),
                    "feature": np.where(splits, feature, -1).astype(np.int32),
                    "threshold": np.where(splits, cut, 0.0),
                    "size": sizes.astype(np.int32),
                    "depth": np.int32(depth),
                }
            )
        )
        owner = np.repeat(rows, sizes)
        right = values[np.arange(len(values)), feature[owner]] > cut[owner]
        node = node * 2 + right
        go_on = splits[owner]
        trees, node, values = trees[go_on], node[go_on], values[go_on]
    return pd.concat(found, ignore_index=True)


def _poisson_steps(mean: float) -> list[int]:
    """63-bit bounds: a uniform number has passed as many of them as a Poisson draw of this mean is high."""
    steps, term, total = [], math.exp(-mean), 0.0
    while total + term < 1.0 and (not steps or steps[-1] < _TOP):
        total += term
        steps.append(min(int(total * (_TOP + 1)), _TOP))
        term *= mean / len(steps)
        if len(steps) > mean and term < 2.0**-63:
            break
    return steps


def tree_draws(data: DataFrame, trees: int, share: float, seed: int, row_id: str) -> DataFrame:
    """Adds ``draws``: (tree, hash) of every tree the row may go to, each tree with a chance of about ``share``.

    The number of draws of a row is Poisson with mean trees x share, by inversion of one hash; each draw falls on any
    tree, and of two on one tree the first counts.  So trees are independent of each other, rows are alike, and the
    order of the hashes within a tree is a random order.  A table so small that most trees want most of its rows
    (``share`` above a quarter) gets a draw for each row and tree instead.
    """
    key = F.col(row_id).cast("string")

    def hashed(*what) -> Column:
        return F.xxhash64(F.lit(seed), *what, key).bitwiseAND(F.lit(_TOP))

    if share > 0.25:
        entries = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), hashed(t).alias("hash")))
        return data.withColumn("draws", F.filter(entries, lambda e: e["hash"] <= F.lit(min(int(share * (1 << 63)), _TOP))))
    chance = hashed(F.lit("draws"))
    steps = _poisson_steps(trees * share)
    many = reduce(add, [(chance >= F.lit(b)).cast("int") for b in steps])
    drawn = data.where(chance >= F.lit(steps[0])).withColumn("draws", F.sequence(F.lit(1), many))
    tree = lambda n: F.pmod(hashed(F.lit("tree"), n), F.lit(trees)).cast("int")
    drawn = drawn.withColumn("draws", F.transform("draws", lambda n: F.struct(tree(n).alias("tree"), hashed(F.lit("place"), n).alias("hash"))))
    first = F.filter("draws", lambda e, i: ~F.exists(F.slice("draws", F.lit(1), i), lambda x: x["tree"] == e["tree"]))
    return drawn.withColumn("draws", first)


def tree_samples(data: DataFrame, trees: int, subsample: int, total: int, seed: int, row_id: str) -> DataFrame:
    """(tree, features): ``subsample`` random rows of the table for every tree, the same under any partitioning."""
    share = min(1.0, (2.0 * subsample + 64.0) / total)
    rows = data.select("features", F.col(row_id).alias("__id"))
    rows = tree_draws(rows, trees, share, seed, "__id").select(F.explode("draws").alias("e"), "features", "__id").select("e.tree", "e.hash", "features", "__id")
    place = F.row_number().over(Window.partitionBy("tree").orderBy("hash", "__id"))
    return rows.withColumn("__place", place).filter(F.col("__place") <= subsample).select("tree", "features")


def fit_forest(
    data: DataFrame,
    trees: int = 200,
    max_samples: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
    row_id: str = "source_row_id",
    direct_rows: int = DIRECT_ROWS,
) -> Forest:
    """``data``: row id and ``features`` array<double>.

    Every tree draws ``max_samples`` rows of the whole table without replacement: it takes the rows with the
    smallest hashes among about twice as many that were drawn for it (``tree_draws``), so what travels does not
    grow with the table, and neither does the work per row grow with the number of trees.
    """
    spark = data.sparkSession
    total, width = data.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    if not total:
        raise ValueError("Cannot fit on an empty table.")
    subsample = min(max_samples, total)
    limit = math.ceil(math.log2(max(subsample, 2)))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        return _grow(group["tree"].to_numpy(), np.stack(group["features"].to_numpy()), seed, limit)

    drawn = tree_samples(data.select(row_id, "features"), trees, subsample, total, seed, row_id)
    groves = drawn.withColumn("grove", F.floor(F.col("tree") / TREES_PER_GROUP))
    nodes = groves.groupBy("grove").applyInPandas(grow, NODE_SCHEMA)
    nodes = materialise(nodes, "forest-nodes")
    draft = spark.createDataFrame([(trees, subsample, width, seed, contamination, None)], META_SCHEMA)
    scored = materialise(score_forest(data.select("features"), Forest(nodes, draft)).select("score_samples"), "forest-fit")
    offset = exact_quantiles(scored, {"s": F.col("score_samples")}, [contamination], direct_rows, {"s": total})["s"][0]
    return Forest(nodes, draft.withColumn("offset", F.lit(offset)))


def forest_arrays(forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Heap-shaped arrays (feature, threshold, path length at leaf) and the normaliser; bounded by the model size."""
    meta = forest.meta.first()
    nodes = forest.nodes.toPandas()
    size = int(2 ** (nodes["depth"].max() + 2))
    feature = np.full((meta["trees"], size), -1, dtype=np.int32)
    threshold = np.zeros((meta["trees"], size))
    path = np.zeros((meta["trees"], size))
    t, k = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    feature[t, k] = nodes["feature"]
    threshold[t, k] = nodes["threshold"]
    path[t, k] = nodes["depth"] + mean_path(nodes["size"].to_numpy())
    return feature, threshold, path, float(mean_path(meta["subsample"]))


def _score_block(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, path: np.ndarray, normal: float, depth: int) -> np.ndarray:
    """Score of a block of rows: all rows step down one tree together, a row in a leaf stays there."""
    rows, width = x.shape
    flat = np.ascontiguousarray(x).ravel()
    base = np.arange(rows) * width
    total = np.zeros(rows)
    for f, cut, length in zip(feature, threshold, path, strict=True):
        inner = f >= 0
        tested = np.where(inner, f, 0)
        left = np.where(inner, 2 * np.arange(len(f)), np.arange(len(f)))
        limit = np.where(inner, cut, np.inf)
        at = np.ones(rows, dtype=np.int64)
        for _ in range(depth):
            at = left[at] + (flat[base + tested[at]] > limit[at])
        total += length[at]
    return -np.power(2.0, -total / (len(feature) * normal)) if normal else np.full(rows, -1.0)


def score_forest(data: DataFrame, forest: Forest, block: int = 2048) -> DataFrame:
    """All columns of ``data`` but ``features``, plus ``score_samples`` in [-1, 0]: lower is more anomalous."""
    arrays = data.sparkSession.sparkContext.broadcast(forest_arrays(forest))
    kept = [f for f in data.schema.fields if f.name != "features"]
    names = [f.name for f in kept]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, threshold, path, normal = arrays.value
        depth = int(math.log2(feature.shape[1])) - 2
        for batch in batches:
            x = matrix(batch)
            result = np.empty(len(x))
            for start in range(0, len(x), block):
                result[start : start + block] = _score_block(x[start : start + block], feature, threshold, path, normal, depth)
            yield with_column(batch, names, "score_samples", result)

    return data.mapInArrow(score, schema_with(kept, "score_samples"))


def with_decision(scored: DataFrame, forest: Forest) -> DataFrame:
    """Adds ``decision`` (score less offset) and ``is_anomaly`` (decision below 0)."""
    offset = F.lit(forest.meta.first()["offset"])
    return scored.withColumns(
        {"decision": F.col("score_samples") - offset, "is_anomaly": F.col("score_samples") < offset}
    )


def save_forest(forest: Forest, path: str) -> None:
    forest.nodes.write.mode("errorifexists").parquet(f"{path}/nodes")
    forest.meta.coalesce(1).write.mode("errorifexists").parquet(f"{path}/meta")


def load_forest(spark: SparkSession, path: str) -> Forest:
    return Forest(
        spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes"),
        spark.read.schema(META_SCHEMA).parquet(f"{path}/meta"),
    )
