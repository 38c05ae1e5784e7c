"""Exact order statistics without a global sort.

``F.percentile`` and ``F.median`` keep every distinct value of a group in one task, and a top-n merges
n rows per task.  Here a quantile sketch brackets the wanted rank, one counting pass verifies the
bracket, and only rows strictly inside it are looked at again; each round cuts the open rows by a
factor of about accuracy/4.  When few enough are left they are grouped by value and ranked.  The
driver holds two bounds per wanted rank, nothing that grows with the table.

Two facts make the primitive useful beyond quantiles.  A rank over (value, id) turns "the n first
rows" into a comparison with one boundary key, so exact-size samples, tails and top-k sets become
plain filters that neither shuffle nor sort the table.  And the result carries how many rows lie
below the value, so ties are resolved by a second search over the ids of one value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.functions.keys import DRAW_BITS

DIRECT_ROWS = 1_000_000


@dataclass(frozen=True)
class RankHit:
    value: float | int
    below: int  # rows with a smaller value
    ties: int  # rows with exactly this value


@dataclass
class _Open:
    name: str
    rank: int
    lo: float | int | None = None  # exclusive bounds
    hi: float | int | None = None
    below: int = 0  # rows at or under lo
    inside: int = 0
    guess: tuple | None = None

    def within(self, value: Column) -> Column:
        test = value.isNotNull()
        if self.lo is not None:
            test = test & (value > F.lit(self.lo))
        if self.hi is not None:
            test = test & (value < F.lit(self.hi))
        return test


def values_at_ranks(
    df: DataFrame,
    values: Mapping[str, Column],
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int] | None = None,
    guesses: Mapping[tuple[str, int], tuple] | None = None,
    direct_rows: int = DIRECT_ROWS,
    accuracy: int = 10_000,
) -> dict[tuple[str, int], RankHit]:
    """Value at each 1-based ascending rank of each expression; nulls are not ranked.

    ``values`` must be numeric (integers below 2**53); ``guesses`` may name a first bracket where the
    distribution is known.  All expressions share every scan.
    """
    wanted = [(name, int(rank)) for name in values for rank in sorted(set(ranks.get(name, ())))]
    if not wanted:
        return {}
    if counts is None:
        counts = count_values(df, {name: values[name] for name, _ in wanted})
    pending = []
    for name, rank in wanted:
        if not 1 <= rank <= counts[name]:
            raise ValueError(f"rank must be between 1 and {counts[name]}, got {rank}.")
        pending.append(_Open(name, rank, inside=counts[name], guess=(guesses or {}).get((name, rank))))

    # each expression is worked out once per row, however many bounds it is compared with
    spots = {name: f"__value_{i}" for i, name in enumerate(dict.fromkeys(name for name, _ in wanted))}
    df = df.select(*[values[name].alias(spot) for name, spot in spots.items()])
    values = {name: F.col(spot) for name, spot in spots.items()}
    found: dict[tuple[str, int], RankHit] = {}
    while True:
        wide = [o for o in pending if o.inside > direct_rows]
        if not wide:
            break
        _narrow(df, values, wide, found, accuracy)
        pending = [o for o in pending if (o.name, o.rank) not in found]
    if pending:
        _rank_directly(df, values, pending, found)
    return found


def count_values(df: DataFrame, values: Mapping[str, Column]) -> dict[str, int]:
    names = list(values)
    row = df.agg(*[F.count(values[n]).alias(f"n{i}") for i, n in enumerate(names)]).first()
    return {n: int(row[i]) for i, n in enumerate(names)}


def _narrow(df, values, wide: list[_Open], found: dict, accuracy: int) -> None:
    sketches = []
    for i, o in enumerate(wide):
        if o.guess is None:
            share = (o.rank - o.below) / o.inside
            slack = 2.0 / accuracy
            marks = [max(0.0, share - slack), min(1.0, share + slack)]
            v = values[o.name]
            sketches.append(F.percentile_approx(F.when(o.within(v), v), marks, accuracy).alias(f"b{i}"))
    row = df.agg(*sketches).first() if sketches else {}
    brackets = [o.guess if o.guess is not None else tuple(row[f"b{i}"]) for i, o in enumerate(wide)]

    tallies = []
    for i, (o, (lo, hi)) in enumerate(zip(wide, brackets, strict=True)):
        v, inside = values[o.name], o.within(values[o.name])
        tallies += [
            F.count_if(inside & (v < F.lit(lo))).alias(f"lt{i}"),
            F.count_if(inside & (v == F.lit(lo))).alias(f"lo{i}"),
            F.count_if(inside & (v > F.lit(lo)) & (v < F.lit(hi))).alias(f"mid{i}"),
            F.count_if(inside & (v == F.lit(hi))).alias(f"hi{i}"),
        ]
    row = df.agg(*tallies).first()
    for i, (o, (lo, hi)) in enumerate(zip(wide, brackets, strict=True)):
        lt, at_lo, mid = row[f"lt{i}"], row[f"lo{i}"], row[f"mid{i}"]
        at_hi = row[f"hi{i}"] if hi != lo else 0
        o.guess = None
        local = o.rank - o.below
        if local <= lt:
            o.hi, o.inside = lo, lt
        elif local <= lt + at_lo:
            found[(o.name, o.rank)] = RankHit(lo, o.below + lt, at_lo)
        elif local <= lt + at_lo + mid:
            o.lo, o.hi, o.below, o.inside = lo, hi, o.below + lt + at_lo, mid
        elif local <= lt + at_lo + mid + at_hi:
            found[(o.name, o.rank)] = RankHit(hi, o.below + lt + at_lo + mid, at_hi)
        else:
            passed = lt + at_lo + mid + at_hi
            o.lo, o.below, o.inside = hi, o.below + passed, o.inside - passed


def _rank_directly(df, values, pending: list[_Open], found: dict) -> None:
    # one search per distinct bracket, whatever the number of ranks looked up in it
    searches: dict[tuple, list[_Open]] = {}
    for o in pending:
        searches.setdefault((o.name, o.lo, o.hi, o.below), []).append(o)
    entries, lookups = [], []
    for i, ((name, _, _, below), members) in enumerate(searches.items()):
        v = values[name]
        entries.append(F.struct(F.lit(i).alias("search"), F.when(members[0].within(v), v).alias("value")))
        spots = [(F.col("before") < F.lit(o.rank - below)) & (F.col("upto") >= F.lit(o.rank - below)) for o in members]
        lookups.append((F.col("search") == i) & reduce(or_, spots))
    tallied = (
        # most rows lie inside few of the searches, so the others' entries go before the rows are multiplied
        df.select(F.explode(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())).alias("e"))
        .select("e.search", "e.value")
        .groupBy("search", "value")
        .agg(F.count(F.lit(1)).alias("ties"))
    )
    order = Window.partitionBy("search").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = tallied.withColumn("upto", F.sum("ties").over(order)).withColumn("before", F.col("upto") - F.col("ties"))
    hits = ranked.filter(reduce(or_, lookups)).collect()
    for i, ((name, _, _, below), members) in enumerate(searches.items()):
        for o in members:
            local = o.rank - below
            hit = next(r for r in hits if r["search"] == i and r["before"] < local <= r["upto"])
            found[(o.name, o.rank)] = RankHit(hit["value"], below + hit["before"], hit["ties"])


def exact_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    quantiles: Sequence[float],
    direct_rows: int = DIRECT_ROWS,
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each expression; None where it has no value."""
    if counts is None:
        counts = count_values(df, values)
    ranks = {}
    for name, n in counts.items():
        spots = [(n - 1) * q for q in quantiles] if n else []
        ranks[name] = sorted({math.floor(s) + 1 for s in spots} | {math.ceil(s) + 1 for s in spots})
    hits = values_at_ranks(df, values, ranks, counts, direct_rows=direct_rows)
    result: dict[str, list[float | None]] = {}
    for name, n in counts.items():
        result[name] = []
        for q in quantiles:
            if not n:
                result[name].append(None)
                continue
            spot = (n - 1) * q
            low = float(hits[(name, math.floor(spot) + 1)].value)
            high = float(hits[(name, math.ceil(spot) + 1)].value)
            result[name].append(low + (high - low) * (spot - math.floor(spot)))
    return result


@dataclass(frozen=True)
class Boundary:
    """The row at one rank of the order (value, id)."""

    value: float | int | None
    last_id: int | None  # None: every row of this value belongs

    def covers(self, value: Column, row_id: Column) -> Column:
        if self.value is None:
            return F.lit(False)
        bound = F.lit(self.value)
        if self.last_id is None:
            return value <= bound
        # rows above the bound, most of them as a rule, are settled by the first comparison
        return (value <= bound) & ((value < bound) | (row_id <= F.lit(self.last_id)))


def boundaries(
    df: DataFrame,
    value: Column,
    row_id: Column,
    ranks: Sequence[int],
    count: int | None = None,
    uniform_draw: bool = False,
    direct_rows: int = DIRECT_ROWS,
) -> list[Boundary]:
    """Boundary key at each rank of the order (value, id); rank 0 covers nothing."""
    counts = None if count is None else {"v": count}
    return boundaries_by_name(df, {"v": value}, row_id, {"v": ranks}, counts, uniform_draw, direct_rows)["v"]


def boundaries_by_name(
    df: DataFrame,
    values: Mapping[str, Column],
    row_id: Column,
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int] | None = None,
    uniform_draw: bool = False,
    direct_rows: int = DIRECT_ROWS,
) -> dict[str, list[Boundary]]:
    """Boundary keys of several expressions over the same rows, sharing every scan."""
    live = {name: sorted({r for r in ranks[name] if r > 0}) for name in values}
    if counts is None:
        counts = count_values(df, values) if any(live.values()) else {}
    guesses = None
    if uniform_draw:
        guesses = {(name, r): _draw_bracket(r, counts[name]) for name, rs in live.items() for r in rs}
    hits = values_at_ranks(df, values, live, counts, guesses, direct_rows)
    tied = {key: h for key, h in hits.items() if key[1] < h.below + h.ties}
    last_ids: dict[tuple[str, int], int] = {}
    if tied:
        label = {key: f"{key[0]}:{key[1]}" for key in tied}
        ids = {label[key]: F.when(values[key[0]] == F.lit(h.value), row_id) for key, h in tied.items()}
        spots = {label[key]: [key[1] - h.below] for key, h in tied.items()}
        id_hits = values_at_ranks(df, ids, spots, {label[k]: h.ties for k, h in tied.items()}, direct_rows=direct_rows)
        last_ids = {key: id_hits[(label[key], key[1] - h.below)].value for key, h in tied.items()}
    return {
        name: [
            Boundary(hits[(name, r)].value, last_ids.get((name, r))) if r > 0 else Boundary(None, None) for r in ranks[name]
        ]
        for name in values
    }


def _draw_bracket(rank: int, count: int) -> tuple[int, int]:
    """Where the draw of this rank must lie, six deviations wide; a miss only costs another pass."""
    share = rank / count
    slack = 6.0 * math.sqrt(share * (1.0 - share) / count) + 1.0 / count
    scale = float(2**DRAW_BITS)
    return int(max(0.0, share - slack) * scale), int(min(1.0, share + slack) * scale)
