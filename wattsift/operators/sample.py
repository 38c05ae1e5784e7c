"""Exact-size seeded samples, splits and allocation of counts to types."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattsift.functions.keys import draw
from wattsift.operators.order_stats import DIRECT_ROWS, boundaries
from wattsift.profile import ANOMALY_TYPES

BROADCAST_ROWS = 2_000_000


def exclude_ids(df: DataFrame, ids: DataFrame, row_id: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose id is not listed; rows without an id stay.

    The id list is broadcast only when it is small; otherwise Spark shuffles both sides on the id.
    """
    listed = ids.select(row_id).filter(F.col(row_id).isNotNull()).distinct()
    if listed.limit(broadcast_rows + 1).count() <= broadcast_rows:
        listed = F.broadcast(listed)
    return df.join(listed, row_id, "left_anti")


def sample_exact(
    df: DataFrame,
    n_rows: int = 100_000,
    seed: int = 42,
    row_id: str = "source_row_id",
    exclude: DataFrame | None = None,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """min(n_rows, rows) rows without replacement: those with the smallest draws.

    One boundary key decides membership, so the sample is a filter over the table.
    """
    if exclude is not None:
        df = exclude_ids(df, exclude, row_id)
    total = df.count()
    if n_rows >= total:
        return df
    key = draw(seed, "sample", F.col(row_id))
    edge = boundaries(df, key, F.col(row_id), [n_rows], total, uniform_draw=True, direct_rows=direct_rows)[0]
    return df.filter(edge.covers(key, F.col(row_id)))


def split_evaluation(
    df: DataFrame,
    fraction: float = 0.5,
    seed: int = 42,
    row_id: str = "source_row_id",
    label: str = "is_anomaly",
    direct_rows: int = DIRECT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(validation, test); stratified by the boolean label when the table has it."""
    if not 0 < fraction < 1:
        raise ValueError(f"fraction is a share of the rows, above 0 and below 1: {fraction}")
    key, rid = draw(seed, "split", F.col(row_id)), F.col(row_id)
    strata = [F.lit(True)]
    if label in df.columns:
        flag = F.col(label).cast("boolean")
        strata = [flag.eqNullSafe(True), flag.eqNullSafe(False)]
    counts = df.agg(*[F.count_if(s).alias(f"c{i}") for i, s in enumerate(strata)]).first()
    chosen = F.lit(False)
    for i, stratum in enumerate(strata):
        part = df.filter(stratum)
        size = round(counts[i] * fraction)
        edge = boundaries(part, key, rid, [size], counts[i], uniform_draw=True, direct_rows=direct_rows)[0]
        chosen = chosen | (stratum & edge.covers(key, rid))
    return df.filter(chosen), df.filter(~chosen)


def allocate_counts(total: int, weights: Mapping[str, float]) -> dict[str, int]:
    """Largest-remainder split of a total over the anomaly types; equal remainders go in the given order."""
    unknown = sorted(set(weights) - set(ANOMALY_TYPES))
    if unknown:
        raise ValueError(f"Unsupported anomaly types: {unknown}")
    values = [float(w) for w in weights.values()]
    sound = bool(values) and all(math.isfinite(w) and w >= 0 for w in values)
    if not sound or abs(sum(values) - 1.0) > 1e-8 + 1e-5:
        raise ValueError(f"the shares of the types are finite, none below 0, and add up to 1: {weights}")
    exact = {name: float(w) * total for name, w in weights.items()}
    counts = {name: math.floor(x) for name, x in exact.items()}
    by_remainder = sorted(exact, key=lambda name: counts[name] - exact[name])
    for name in by_remainder[: total - sum(counts.values())]:
        counts[name] += 1
    return counts


def weights_from_form(fields: Mapping[str, str | float]) -> dict[str, float]:
    """Form fields named ``<type>_weight`` to type weights; they must sum to 1 within 1e-9."""
    weights = {name: float(fields[f"{name}_weight"]) for name in ANOMALY_TYPES}
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError(f"the weights in the form add up to {sum(weights.values())}, not to 1")
    return weights
