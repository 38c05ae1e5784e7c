"""Nearest vectors by inner product from randomly rotated one-bit codes.

A vector is the mean vector plus a rest.  The rest is turned by a random rotation into a longer space and only the
signs are kept, packed eight to a byte, with two scalars: one turns the sum of signed query components into an
estimate of the inner product, the other bounds the estimate's error, which for a random rotation is about normal.
Only vectors whose estimate plus ``sigmas`` times that bound reaches the query's present k-th best are compared in
full.  Queries and vectors meet in blocks of bounded size.  The table is searched in a few rounds of growing shares:
each starts with the k-th best of those before, so that a block returns little more than what is still in the running.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.session import materialise

BITS = 4  # signs per component
SIGMAS = 3.0  # a vector at the border is missed about once in 700 times
BLOCK_BYTES = 64 << 20
BLOCK_ROWS = 4_096  # blocks are made smaller than BLOCK_BYTES, down to this, to keep all cores busy
FIRST_ROWS, GROWTH = 32_768, 32  # rows of the first round; how many times as many have been seen after each next one
TILE_ROWS, TILE_QUERIES = 4_096, 256
SHARES = 1 << 20


def rotation(width: int, length: int, seed: int) -> np.ndarray:
    """``length`` x ``width`` with orthonormal columns."""
    draws = np.random.default_rng(seed).standard_normal((length, width))
    q, r = np.linalg.qr(draws)
    return q * np.sign(np.diag(r))


def whole_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) without vectors that are null, zero or hold null, NaN or infinity."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return table.where(v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & some).select(F.col(key).alias("id"), v.alias("v"))


def _rows(batch: pa.RecordBatch | pa.Table, width: int, name: str = "v") -> np.ndarray:
    lists = batch.column(name)
    flat = (lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists).flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(flat) != width * len(lists):
        raise ValueError(f"all vectors must have {width} components")
    return flat.reshape(-1, width)


def _centre(vectors: DataFrame) -> tuple[np.ndarray, int]:
    """Mean of all vectors and their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            if batch.num_rows:
                part = _rows(batch, len(batch.column("v")[0]))
                if total is not None and len(total) != part.shape[1]:
                    raise ValueError("all vectors must have one number of components")
                total, n = part.sum(0) + (0 if total is None else total), n + len(part)
        if n:
            total = np.append(total, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "total"])

    sums = vectors.select("v").mapInArrow(work, "at long, total double").groupBy("at").agg(F.sum("total").alias("total"), F.count("*").alias("n"))
    rows = sorted(sums.collect(), key=lambda r: r["at"])  # one per component and one more
    if len({r["n"] for r in rows}) > 1:
        raise ValueError("all vectors must have one number of components")
    total = np.array([r["total"] for r in rows])
    return (total[:-1] / total[-1], int(total[-1])) if len(total) else (total, 0)


def one_bit_codes(vectors: DataFrame, centre: np.ndarray, turn: np.ndarray) -> DataFrame:
    """``vectors`` (id, v) with uid, code (packed signs), scale and spread, the two scalars of each code."""
    length, width = turn.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = _rows(batch, width) - centre
            norm = np.sqrt((rest * rest).sum(1))
            turned = (rest / np.where(norm > 0, norm, 1)[:, None]) @ turn.T
            agree = np.abs(turned).sum(1) / np.sqrt(length)  # cosine between the vector and its signs
            agree = np.where(norm > 0, agree, 1)
            code = np.packbits(turned >= 0, axis=1)
            scale = norm / (agree * np.sqrt(length))
            spread = norm * np.sqrt(np.maximum(1 / agree**2 - 1, 0)) / np.sqrt(length - 1)
            packed = pa.array([row.tobytes() for row in code], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "id", "v")), packed, pa.array(scale), pa.array(spread)], names=["uid", "id", "v", "code", "scale", "spread"])

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("id", "v"))
    numbered = vectors.select(F.monotonically_increasing_id().alias("uid"), "id", "v")
    return numbered.mapInArrow(work, f"uid long, {kinds}, code binary, scale double, spread double")


def inner(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of columns ``i`` of ``a`` with columns ``j`` of ``b``: components added one after the other,
    so that equal vectors give equal sums wherever they stand."""
    total = np.zeros(len(i))
    for x, y in zip(a, b, strict=True):
        total += x.take(i) * y.take(j)
    return total


def _best(query: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best: highest score, then first in ``order``."""
    by = np.lexsort((order, -score, query))
    query = query[by]
    starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.empty(0, int)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    return by[place < k]


class Search:
    """Exact scores of the vectors of one block that may be among the k best of some queries."""

    def __init__(self, rows: pa.Table, queries: pa.Table, centre: np.ndarray, turn: np.ndarray, k: int, sigmas: float):
        width = len(centre)
        self.rows, self.queries, self.k, self.sigmas = _rows(rows, width), _rows(queries, width, "w"), k, sigmas
        self.length = turn.shape[0]
        code = rows.column("code").combine_chunks()
        self.code = np.frombuffer(b"".join(code.to_pylist()), np.uint8).reshape(len(code), -1)
        self.scale, self.spread = (rows.column(c).to_numpy().astype(np.float32) for c in ("scale", "spread"))
        self.row_uid, self.query_uid = rows.column("uid").to_numpy(), queries.column("q").to_numpy()
        self.order = np.empty(len(self.rows), np.int64)
        id_ = rows.column("id").combine_chunks()
        self.order[pa.compute.array_sort_indices(id_, null_placement="at_end").to_numpy()] = np.arange(len(self.rows))
        self.base = self.queries @ centre
        self.norm = np.sqrt((self.queries**2).sum(1))
        self.turned = (self.queries @ turn.T).astype(np.float32)
        # what single precision may add: relative to both norms
        self.slack = 1e-5 * self.norm * (np.sqrt((self.rows**2).sum(1)).max(initial=0) + np.sqrt((centre**2).sum()))
        self.floor = queries.column("tau").to_numpy(zero_copy_only=False).astype(float)
        self.floor[np.isnan(self.floor)] = -np.inf
        self.across, self.asked = np.ascontiguousarray(self.rows.T), np.ascontiguousarray(self.queries.T)
        self.found = [[np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)] for _ in range(0, len(self.queries), TILE_QUERIES)]

    def _keep(self, tile: int, q: np.ndarray, r: np.ndarray) -> None:
        """Score pairs of a tile's queries in full; keep each query's k best so far and raise its floor."""
        first = tile * TILE_QUERIES
        floor = self.floor[first : first + TILE_QUERIES]
        for low in range(0, len(q), 1 << 16):
            i, j = q[low : low + (1 << 16)], r[low : low + (1 << 16)]
            score = inner(self.asked, i, self.across, j)
            good = score >= self.floor[i]
            held = [np.concatenate(x) for x in zip(self.found[tile], (i[good], j[good], score[good]), strict=True)]
            at = _best(held[0], held[2], self.order[held[1]], self.k)
            self.found[tile] = q_, _, score = [x[at] for x in held]
            least = np.full(len(floor), np.inf)
            np.minimum.at(least, q_ - first, score)
            full = np.bincount(q_ - first, minlength=len(floor)) >= self.k
            floor[full] = np.maximum(floor[full], least[full])

    def run(self) -> list[np.ndarray]:
        """(query, row, score) arrays; places within the block."""
        for low in range(0, len(self.rows), TILE_ROWS):
            rows = slice(low, min(low + TILE_ROWS, len(self.rows)))
            signs = np.unpackbits(self.code[rows], axis=1, count=self.length).astype(np.float32) * 2 - 1
            for tile in range(len(self.found)):
                self._tile(tile, signs, rows)
        return [np.concatenate(x) for x in zip(*self.found, strict=True)]

    def _tile(self, tile: int, signs: np.ndarray, rows: slice) -> None:
        first = tile * TILE_QUERIES
        queries = slice(first, min(first + TILE_QUERIES, len(self.queries)))
        estimate = (self.turned[queries] @ signs.T) * self.scale[rows] + self.base[queries, None].astype(np.float32)
        estimate[self.query_uid[queries, None] == self.row_uid[None, rows]] = -np.inf
        open_ = np.flatnonzero(np.isneginf(self.floor[queries]))
        if len(open_) and self.k < estimate.shape[1]:  # no k-th best yet: score those with the highest estimates first
            top = np.argpartition(estimate[open_], -self.k, axis=1)[:, -self.k :]
            q, r = np.repeat(open_, self.k), top.ravel()
            real = np.isfinite(estimate[q, r])
            self._keep(tile, q[real] + first, r[real] + rows.start)
            estimate[q, r] = -np.inf  # scored
        needed = (self.floor[queries] - self.slack[queries]).astype(np.float32)
        estimate += self.sigmas * self.norm[queries, None].astype(np.float32) * self.spread[None, rows]
        likely = (estimate >= needed[:, None]) & np.isfinite(estimate)
        q, r = np.nonzero(likely)
        self._keep(tile, q + first, r + rows.start)


def _met(rows: DataFrame, queries: DataFrame, slabs: int, packs: int, centre: np.ndarray, turn: np.ndarray, k: int, sigmas: float) -> DataFrame:
    """(q, query_id, uid, id, score): what each block of rows adds for each block of queries."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.select(["uid", "id"]).slice(0, 0).append_column("q", pa.array([], pa.int64())).append_column("query_id", pa.array([], right.schema.field("query_id").type)).append_column("score", pa.array([], pa.float64())).select(["q", "query_id", "uid", "id", "score"])
        q, r, score = Search(left, right, centre, turn, k, sigmas).run()
        q, r = pa.array(q), pa.array(r)
        return pa.table(
            {"q": right.column("q").take(q), "query_id": right.column("query_id").take(q), "uid": left.column("uid").take(r), "id": left.column("id").take(r), "score": pa.array(score)}
        )

    kind = rows.schema["id"].dataType.simpleString()
    slab, pack = F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(slabs)).cast("int"), F.pmod(F.xxhash64("q", F.lit(2)), F.lit(packs)).cast("int")
    left = rows.select("uid", "id", "v", "code", "scale", "spread", slab.alias("slab"), F.explode(F.sequence(F.lit(0), F.lit(packs - 1))).alias("pack"))
    right = queries.select("q", "query_id", "w", "tau", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"), pack.alias("pack"))
    n = slabs * packs  # a stated number: blocks are not put together again by size
    left, right = left.repartition(n, "slab", "pack"), right.repartition(n, "slab", "pack")
    return left.groupBy("slab", "pack").cogroup(right.groupBy("slab", "pack")).applyInArrow(work, f"q long, query_id {kind}, uid long, id {kind}, score double")


def nearest_by_codes(
    table: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", bits: int = BITS, sigmas: float = SIGMAS, seed: int = 42,
    block_bytes: int = BLOCK_BYTES, first_rows: int = FIRST_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a condition on the key as ``id``) the k
    rows with the largest inner product, its own row left out; ties go to the smaller key, a null key last.

    Scores are the inner products of the given vectors in double precision.  Every row is coded and is a candidate of
    every query; a true neighbour is missed only if its estimate is wrong by more than ``sigmas`` standard deviations.
    Vectors that are null, zero or hold a null or non-finite component take no part.  Repeated rows are candidates of
    each other, and each repeated query has its own list.  With fewer than k others there are fewer ranks.  Other
    columns are not read; an empty table gives an empty table; vectors of different lengths raise.
    """
    spark = table.sparkSession
    vectors = whole_vectors(table, key, vector)
    centre, n = _centre(vectors)
    width = len(centre)
    length = -(-bits * max(width, 2) // 8) * 8
    turn = rotation(width, length, seed)
    coded = materialise(one_bit_codes(vectors, centre, turn), "one-bit-codes")
    queries = coded.where(is_query).select(F.col("uid").alias("q"), F.col("id").alias("query_id"), F.col("v").alias("w"))
    asked = queries.count()
    cores = spark.sparkContext.defaultParallelism

    def blocks(rows: int) -> int:
        by_size = -(-rows * max(width, 1) * 8 // block_bytes)
        return max(1, by_size, min(2 * cores, rows // BLOCK_ROWS))

    share = F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(SHARES))
    best, low, high = None, 0, min(SHARES, -(-SHARES * first_rows // max(n, 1)))
    while True:
        part = coded.where((share >= low) & (share < high))
        if best is None:
            waiting = queries.withColumn("tau", F.lit(None).cast("double"))
        else:
            full = best.groupBy("q").agg(F.min("score").alias("tau"), F.count("*").alias("held")).where(F.col("held") >= k)
            waiting = queries.join(full.select("q", "tau"), "q", "left")
        found = _met(part, waiting, blocks(n * (high - low) // SHARES), max(1, -(-asked * max(width, 1) * 8 // block_bytes)), centre, turn, k, sigmas)
        place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid"))
        ranked = (found if best is None else best.drop("rank").unionByName(found)).withColumn("rank", place).where(F.col("rank") <= k)
        best = materialise(ranked, "nearest")
        if high >= SHARES:
            return best.select("query_id", "rank", F.col("id").alias(key), "score")
        low, high = high, min(SHARES, high * GROWTH)


ORACLE = """with whole as (select vec_id, cast(embedding as double[]) as v from embeddings
 where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 20"""
