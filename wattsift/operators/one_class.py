"""One-class SVM with an RBF kernel, approximated by random Fourier features (Rahimi and Recht 2007).

In feature space the nu one-class problem is the shortest vector of a reduced convex hull: w is the
mean of the lowest-scoring nu share of the rows under w itself.  Frank-Wolfe steps towards that mean
need two passes per step, a quantile and a sum, both plain distributed aggregates.  The result is
approximate and meant to be judged by its ranking.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsift.functions.batches import matrix, schema_with, with_column
from wattsift.operators.order_stats import DIRECT_ROWS, exact_quantiles
from wattsift.session import materialise

COMPONENT_SCHEMA = "component int, direction array<double>, phase double, weight double"
LIFT_ROWS = 1_024  # rows lifted at once: their components stay in a core's cache


@dataclass(frozen=True)
class OneClass:
    """``components``: one row per random feature (a fixed number); ``meta``: gamma, nu, offset."""

    components: DataFrame
    meta: DataFrame


def scale_gamma(data: DataFrame) -> float:
    """1 / (features * variance of all entries)."""
    total = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x)
    squares = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x * x)
    row = data.agg(F.sum(total).alias("s"), F.sum(squares).alias("q"), F.sum(F.size("features")).alias("n"), F.max(F.size("features")).alias("d")).first()
    spread = row["q"] / row["n"] - (row["s"] / row["n"]) ** 2
    return 1.0 / (row["d"] * spread) if spread > 0 else 1.0


def _lift(x: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    z = x @ directions
    z += phases
    np.cos(z, out=z)
    z *= np.sqrt(2.0 / len(phases))
    return z


def _lifted(batch: pa.RecordBatch, directions: np.ndarray, phases: np.ndarray) -> Iterator[np.ndarray]:
    x = matrix(batch)
    for low in range(0, len(x), LIFT_ROWS):
        yield _lift(x[low : low + LIFT_ROWS], directions, phases)


def _scores(data: DataFrame, parts: tuple[np.ndarray, np.ndarray, np.ndarray], name: str) -> DataFrame:
    shipped = data.sparkSession.sparkContext.broadcast(parts)
    kept = [f for f in data.schema.fields if f.name != "features"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, phases, weights = shipped.value
        for batch in batches:
            value = np.concatenate([z @ weights for z in _lifted(batch, directions, phases)] or [np.empty(0)])
            yield with_column(batch, names, name, value)

    return data.mapInArrow(run, schema_with(kept, name))


def _mean_lift(data: DataFrame, parts, ceiling: float | None) -> np.ndarray | None:
    """Mean lifted vector of the rows scoring at most ``ceiling`` (all rows without one)."""
    shipped = data.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, phases, weights = shipped.value
        total, rows = np.zeros(len(phases)), 0
        for batch in batches:
            for z in _lifted(batch, directions, phases):
                if ceiling is not None:
                    z = z[z @ weights <= ceiling]
                total, rows = total + z.sum(axis=0), rows + len(z)
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([rows], pa.int64())], ["total", "rows"])

    partial = data.select("features").mapInArrow(run, "total array<double>, rows long")
    summed = (
        partial.select("rows", F.posexplode("total").alias("component", "value"))
        .groupBy("component")
        .agg(F.sum("value").alias("value"), F.sum("rows").alias("rows"))
        .orderBy("component")
        .collect()
    )
    rows = summed[0]["rows"] if summed else 0
    return np.array([r["value"] for r in summed]) / rows if rows else None


def fit_one_class(
    data: DataFrame,
    nu: float = 0.05,
    gamma: float | None = None,
    components: int = 256,
    steps: int = 12,
    seed: int = 42,
    direct_rows: int = DIRECT_ROWS,
) -> OneClass:
    """``data`` has ``features`` array<double>."""
    spark = data.sparkSession
    data = data.select("features")
    width = len(data.first()[0])
    gamma = scale_gamma(data) if gamma is None else gamma
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, np.sqrt(2.0 * gamma), (width, components))
    phases = rng.uniform(0.0, 2.0 * np.pi, components)
    weights = _mean_lift(data, (directions, phases, np.zeros(components)), None)
    for step in range(steps):
        parts = (directions, phases, weights)
        cut = _scores(data, parts, "s").agg(F.percentile_approx("s", nu, 10_000)).first()[0]
        tail = _mean_lift(data, parts, cut)
        if tail is None:
            break
        weights = weights + 2.0 / (step + 3.0) * (tail - weights)
    scored = materialise(_scores(data, (directions, phases, weights), "s").select("s"), "one-class-fit")
    offset = exact_quantiles(scored, {"s": F.col("s")}, [nu], direct_rows)["s"][0]
    rows = [(i, [float(v) for v in directions[:, i]], float(phases[i]), float(weights[i])) for i in range(components)]
    meta = spark.createDataFrame([(float(gamma), float(nu), float(offset))], "gamma double, nu double, offset double")
    return OneClass(spark.createDataFrame(rows, COMPONENT_SCHEMA), meta)


def score_one_class(data: DataFrame, model: OneClass) -> DataFrame:
    """All columns but ``features``, plus ``decision``: negative outside the learned region."""
    rows = model.components.orderBy("component").collect()
    directions = np.array([r["direction"] for r in rows]).T
    parts = (directions, np.array([r["phase"] for r in rows]), np.array([r["weight"] for r in rows]))
    offset = model.meta.first()["offset"]
    return _scores(data, parts, "decision").withColumn("decision", F.col("decision") - F.lit(offset))


def save_one_class(model: OneClass, path: str) -> None:
    model.components.write.mode("errorifexists").parquet(f"{path}/components")
    model.meta.coalesce(1).write.mode("errorifexists").parquet(f"{path}/meta")


def load_one_class(spark: SparkSession, path: str) -> OneClass:
    return OneClass(spark.read.schema(COMPONENT_SCHEMA).parquet(f"{path}/components"), spark.read.parquet(f"{path}/meta"))
