"""Random donors under conditions, as equi-joins.

A target needs a uniformly drawn pool row from another context (from its own only where the pool has
no other) whose values differ from its own.  Each pool is put in one fixed order, (context, draw, id),
so a context is a range of positions and "any row outside my context" is a draw over the remaining
positions: one number, one equi-join on (pool, position).  Only "values differ" is left as a test
after the join, with further draws for the few targets that fail it, and a short list per pool for
those whose draws all fail.

Positions come from counts, not from a global sort: contexts are cut into slices by ranges of the
draw, sized from the context's row count, so a context with a third of all rows becomes many slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.functions.keys import DRAW_BITS, draw
from wattsift.functions.numbers import ATOL, RTOL, vectors_close
from wattsift.operators.sample import BROADCAST_ROWS
from wattsift.session import materialise

SLICE_ROWS = 500_000
FEW_DRAWS = 2
FIRST_DRAWS = 8
ALL_DRAWS = 64
TRY_ROWS = 500_000  # draws to broadcast: each carries its target's values
BARRED_CELLS = 3  # a target's own cell and its neighbours
SPECIAL_CELL = 1 << 40  # beyond the cell of any finite number


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a side whose row count has been checked."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def pool_positions(pool: DataFrame, seed: int, slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(pool rows with ``position``, ranges per (pool, context) with ``lo``, ``len``, ``size``).

    ``pool`` has columns pool, context, donor_id, donor_values.
    """
    keyed = pool.withColumn("order_key", draw(seed, "pool", F.col("donor_id")))
    contexts = keyed.groupBy("pool", "context").agg(F.count(F.lit(1)).alias("len"))
    contexts = materialise(
        contexts.withColumns(
            {
                "context_key": draw(seed, "context", F.col("context")),
                "slices": F.ceil(F.col("len") / slice_rows).cast("long"),
            }
        ),
        "donor-contexts",
    )
    n_contexts, n_slices = contexts.agg(F.count(F.lit(1)), F.coalesce(F.sum("slices"), F.lit(0))).first()

    in_pool = Window.partitionBy("pool").orderBy("context_key", "context")
    before = in_pool.rowsBetween(Window.unboundedPreceding, -1)
    ranges = contexts.select(
        "pool",
        "context",
        "slices",
        "len",
        F.coalesce(F.sum("len").over(before), F.lit(0)).alias("lo"),
        F.sum("len").over(Window.partitionBy("pool")).alias("size"),
    )
    placed = keyed.join(small(ranges.select("pool", "context", "slices", "lo"), n_contexts), ["pool", "context"])
    part = F.floor(F.col("order_key") / F.lit(float(2**DRAW_BITS)) * F.col("slices")).cast("long")
    placed = placed.withColumn("slice", part)
    in_slice = Window.partitionBy("pool", "context", "slice").orderBy("order_key", "donor_id")
    placed = placed.withColumn("place", F.row_number().over(in_slice))
    placed = materialise(placed.select("pool", "context", "slice", "place", "donor_id", "donor_values", "lo"), "donor-places")

    earlier = Window.partitionBy("pool", "context").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("pool", "context", "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("pool", "context", "slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    )
    offsets = materialise(offsets, "donor-offsets")
    position = (F.col("lo") + F.col("offset") + F.col("place") - 1).alias("position")
    positions = placed.join(small(offsets, n_slices), ["pool", "context", "slice"]).select(
        "pool", "context", "donor_id", "donor_values", position
    )
    return positions, ranges.drop("slices")


def with_ranges(targets: DataFrame, ranges: DataFrame, n_ranges: int) -> DataFrame:
    """Adds lo, len, size of the target's own context in its pool (len 0 where the context is absent)."""
    sizes = ranges.groupBy("pool").agg(F.first("size").alias("size"))  # one row per pool
    return (
        targets.join(small(ranges.select("pool", "context", "lo", "len"), n_ranges), ["pool", "context"], "left")
        .join(F.broadcast(sizes), "pool", "left")
        .withColumns({"lo": F.coalesce("lo", F.lit(0)), "len": F.coalesce("len", F.lit(0))})
    )


def drawn_position(seed: int, pool: Column, target: Column, attempt: Column) -> Column:
    others = F.col("size") - F.col("len")
    pick = draw(seed, "donor", pool, target, attempt)
    shifted = F.when(pick % others < F.col("lo"), pick % others).otherwise(pick % others + F.col("len"))
    return F.when(others > 0, shifted).otherwise(pick % F.col("size"))


def _try_draws(targets: DataFrame, positions: DataFrame, seed: int, attempts: range, n_targets: int) -> DataFrame:
    tries = targets.select(
        "pool",
        "target_id",
        "target_values",
        F.explode(F.sequence(F.lit(attempts.start), F.lit(attempts.stop - 1))).alias("attempt"),
        "lo",
        "len",
        "size",
    )
    tries = tries.withColumn("position", drawn_position(seed, F.col("pool"), F.col("target_id"), F.col("attempt")))
    tries = tries.select("pool", "position", "target_id", "target_values", "attempt")
    light = F.broadcast(tries) if n_targets * len(attempts) <= TRY_ROWS else tries
    met = positions.select("pool", "position", "donor_id", "donor_values").join(light, ["pool", "position"])
    return (
        met.filter(~vectors_close(F.col("donor_values"), F.col("target_values")))
        .groupBy("pool", "target_id")
        .agg(F.min_by(F.struct("donor_id", "donor_values"), "attempt").alias("donor"))
        .select("pool", "target_id", "donor.donor_id", "donor.donor_values")
    )


def _cell(value: Column) -> Column:
    """Number of the value's cell.  Values that are close lie in one cell or in neighbouring ones.

    The scale is bent so that the tolerance of ``is_close`` has length one everywhere; a cell has length two.
    Null, NaN and the infinities have cells of their own, far from all others.
    """
    bent = F.signum(value) * F.log1p(F.abs(value) * F.lit(RTOL / ATOL)) / F.lit(RTOL)
    endless = F.abs(value) == F.lit(float("inf"))
    return (
        F.when(value.isNull(), F.lit(-SPECIAL_CELL))
        .when(F.isnan(value), F.lit(SPECIAL_CELL))
        .when(endless, F.signum(value).cast("long") * (2 * SPECIAL_CELL))
        .otherwise(F.floor(F.when(endless | F.isnan(value), 0.0).otherwise(bent) / 2))
    )


def _first_of(df: DataFrame, keys: list[str], order: list[Column], rows: int) -> DataFrame:
    """The first rows of each group; every task first drops what cannot be among them, so no group is gathered."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= rows).drop("place")


def pool_options(positions: DataFrame) -> DataFrame:
    """(pool, options): for every pool a short list that has a donor for each target the pool can serve at all.

    For each component of the values it holds two kinds of rows.  Kind 0: smallest ids by cell.  A target bars its own
    context and three cells (its own and both neighbours).  The first row it does not bar is among the first four cells
    of its context, then among the first two contexts of its cell, and then among the first eleven rows, since of those
    before it at most four are of the barred context and two of each barred cell.  Kind 1: the least and the greatest
    value, in two contexts each: if neither differs from the target's, nothing between them does.
    """
    parts = positions.select("pool", "context", "donor_id", "donor_values", F.posexplode("donor_values").alias("component", "value"))
    donor = F.struct("donor_id", "donor_values")
    by_id = [F.col("donor.donor_id"), F.col("context")]
    cells = parts.groupBy("pool", "component", _cell(F.col("value")).alias("cell"), "context").agg(F.min_by(donor, "donor_id").alias("donor"))
    cells = _first_of(cells, ["pool", "component", "context"], by_id, BARRED_CELLS + 1)
    cells = _first_of(cells, ["pool", "component", "cell"], by_id, 2)
    cells = _first_of(cells, ["pool", "component"], by_id, (BARRED_CELLS + 1) + 2 * BARRED_CELLS + 1)
    kept = [cells.select("pool", F.lit(0).alias("kind"), "context", "donor")]
    finite = parts.filter("value is not null and not isnan(value)")
    for sign in (1, -1):
        ends = finite.groupBy("pool", "component", "context").agg(
            F.min(F.struct((F.col("value") * sign).alias("value"), "donor_id", "donor_values")).alias("end")
        )
        ends = _first_of(ends, ["pool", "component"], [F.col("end.value"), F.col("end.donor_id")], 2)
        kept.append(ends.select("pool", F.lit(1).alias("kind"), "context", F.struct("end.donor_id", "end.donor_values").alias("donor")))
    options = kept[0].unionByName(kept[1]).unionByName(kept[2])
    entry = F.struct("kind", "donor.donor_id", "context", "donor.donor_values")
    return options.groupBy("pool").agg(F.array_sort(F.collect_set(entry)).alias("options"))


def _from_options(targets: DataFrame, positions: DataFrame) -> DataFrame:
    """A donor for targets that met only rows like themselves: the first acceptable row of their pool's short list.

    Reads the pool once for all targets, however many rows and kinds of rows it has.
    """
    wanted = targets.select("pool").distinct()
    options = materialise(pool_options(positions.join(F.broadcast(wanted), "pool", "left_semi")), "donor-options")
    fits = F.filter(
        "options",
        lambda d: ((d["context"] != F.col("context")) | (F.col("size") == F.col("len")))
        & ~vectors_close(d["donor_values"], F.col("target_values")),
    )
    served = targets.join(small(options, options.count()), "pool").withColumn("donor", F.get(fits, F.lit(0)))
    return served.filter("donor is not null").select("pool", "target_id", "donor.donor_id", "donor.donor_values")


def match_donors(
    targets: DataFrame,
    pool: DataFrame,
    seed: int,
    first_draws: int = FIRST_DRAWS,
    all_draws: int = ALL_DRAWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """(pool, target_id, donor_id, donor_values), one row per target that has any acceptable donor.

    ``targets``: pool, context, target_id, target_values.  The target itself never qualifies, because
    its values equal its own.  Targets without a donor are missing from the result.
    """
    positions, ranges = pool_positions(pool, seed, slice_rows)
    n_ranges = ranges.count()
    ranged = materialise(with_ranges(targets, ranges, n_ranges).filter(F.col("size") > 0), "donor-targets")
    n_targets = ranged.count()
    few = min(FEW_DRAWS, first_draws)
    matched = materialise(_try_draws(ranged, positions, seed, range(few), n_targets), "donor-first")
    left = ranged.join(matched.select("pool", "target_id"), ["pool", "target_id"], "left_anti")
    n_left = left.count()
    # most targets take their first or second draw, so the others are made for the few that are left only
    for low, high in ((few, first_draws), (first_draws, all_draws)):
        if n_left and high > low:
            more = materialise(_try_draws(left, positions, seed, range(low, high), n_left), "donor-more")
            left = left.join(more.select("pool", "target_id"), ["pool", "target_id"], "left_anti")
            matched = matched.unionByName(more)
            n_left = left.count()
    if n_left:
        matched = matched.unionByName(_from_options(left, positions))
    return matched
