"""Product codes of vectors in whole numbers, with distances looked up per value instead of computed per vector.

Vectors become integers once and are kept in blocks that hold, for each dimension, a dictionary of the distinct
integers and one small code per vector.  For a codebook a task tabulates the squared differences of every distinct
integer to all entries; the distance of a part to all entries is then a gather and an addition per dimension.
All arithmetic is exact, so the result does not depend on blocks, partitions or retries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattsift.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK_VALUES = 1 << 19  # integers in one block: 8,192 vectors of 64
LARGEST = 1 << 26  # integers beyond this could make a sum of squares leave 64 bits
CHUNK = 1024
HOT_SHARE = 1000  # labels with at least a thousandth of the rows; there are at most as many


def integer_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """(k, label, v): floor(scale * x) of each component; vectors that are null or hold null, NaN or infinity go."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.where(v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col(key).alias("k"), F.col(label).alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def value_blocks(rows: DataFrame, width: int) -> DataFrame:
    """One row per block of vectors: keys, labels, the dictionary of each dimension and the codes, column by column."""

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("v")
        ints = lists.flatten().to_numpy(zero_copy_only=False)
        if len(ints) != width * len(lists) or not (np.diff(lists.offsets.to_numpy()) == width).all():
            raise ValueError(f"all vectors must have {width} components")
        if len(ints) and np.abs(ints).max() > LARGEST:
            raise ValueError(f"components beyond {LARGEST} after scaling are not supported")
        values, ends, codes = [], [], []
        for column in ints.reshape(len(lists), width).T:
            distinct, code = np.unique(column, return_inverse=True)
            values.append(distinct)
            ends.append(len(distinct))
            codes.append(code.astype("<u2" if len(lists) <= 1 << 16 else "<u4"))
        join = lambda parts: np.concatenate(parts).tobytes() if parts else b""
        ends_ = np.cumsum(np.array(ends, "<i8")).astype("<i8").tobytes()
        whole = [pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), batch.column(c)) for c in ("k", "label")]
        return pa.RecordBatch.from_arrays(
            [*whole, *(pa.array([x], pa.binary()) for x in (join(values), ends_, join(codes))), pa.array([len(lists)], pa.int64())],
            names=["k", "label", "dictionary", "ends", "codes", "n"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, min(1 << 16, BLOCK_VALUES // max(width, 1)))
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                yield pack(batch.slice(low, size))

    k, label = rows.schema["k"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(work, f"k array<{k}>, label array<{label}>, dictionary binary, ends binary, codes binary, n long")


class Block:
    """Dictionaries and codes of one block."""

    def __init__(self, dictionary: bytes, ends: bytes, codes: bytes, n: int):
        cuts = np.frombuffer(ends, "<i8")
        self.values = np.split(np.frombuffer(dictionary, "<i8"), cuts[:-1]) if len(cuts) else []
        self.codes = np.frombuffer(codes, "<u2" if n <= 1 << 16 else "<u4").reshape(len(cuts), n)
        self.n = n

    def assign(self, book: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each vector's part; ``book`` is entries x components of the part."""
        entries, width = book.shape
        dims = range(part * width, (part + 1) * width)
        far = max((max(abs(int(self.values[d][0]) - int(b.max())), abs(int(self.values[d][-1]) - int(b.min()))) for d, b in zip(dims, book.T, strict=True)), default=0)
        kind = np.int32 if far * far * width < 1 << 31 else np.int64
        tables = [((self.values[d][:, None] - book[None, :, j]) ** 2).astype(kind) for j, d in enumerate(dims)]
        entry, error = np.empty(self.n, np.int64), np.empty(self.n, np.int64)
        for low in range(0, self.n, CHUNK):
            rows = slice(low, min(low + CHUNK, self.n))
            total = np.zeros((rows.stop - low, entries), kind)
            gathered = np.empty_like(total)
            for d, table in zip(dims, tables, strict=True):
                np.take(table, self.codes[d, rows], axis=0, out=gathered, mode="clip")
                total += gathered
            entry[rows] = total.argmin(axis=1)  # the first of equals
            error[rows] = total[np.arange(len(total)), entry[rows]]
        return entry, error


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch, i, Block(*(batch.column(c)[i].as_py() for c in ("dictionary", "ends", "codes", "n")))


def _next_books(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: parts go to their nearest entries, entries become the floor of their parts' mean."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for _, _, block in _blocks(batches):
            for p in range(parts):
                entry, _ = block.assign(books[p], p)
                counts[p] += np.bincount(entry, minlength=entries)
                for j in range(width):
                    d = p * width + j
                    # whole numbers below 2^53: the additions in doubles are exact
                    sums[p, :, j] += np.bincount(entry, block.values[d][block.codes[d]], entries).astype(np.int64)
        used = np.flatnonzero(counts.ravel())
        if not len(used):
            return
        slot, position = np.repeat(used, width + 1), np.tile(np.arange(-1, width), len(used))  # -1 carries the count
        total = np.concatenate([counts.reshape(-1, 1), sums.reshape(parts * entries, width)], axis=1)[used].ravel()
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (slot, position, total)], names=["slot", "position", "total"])

    found = blocks.select("dictionary", "ends", "codes", "n").mapInArrow(work, "slot long, position long, total long")
    rows = found.groupBy("slot", "position").agg(F.sum("total").alias("total")).toArrow()  # at most the codebooks' own size
    slot, position, total = (rows.column(c).to_numpy() for c in ("slot", "position", "total"))
    counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
    counts[slot[position < 0]] = total[position < 0]
    sums[slot[position >= 0], position[position >= 0]] = total[position >= 0]
    used = counts > 0
    after = books.reshape(parts * entries, width).copy()
    after[used] = sums[used] // counts[used, None]  # floors towards minus infinity
    return after.reshape(books.shape)


def _coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(k, label, code, error) of every vector."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, block in _blocks(batches):
            found = [block.assign(book, p) for p, book in enumerate(books)]
            shown = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            code = [shown[low : low + 2 * len(books)] for low in range(0, len(shown), 2 * len(books))]
            error = np.sum([e for _, e in found], axis=0)
            own = [batch.column(c)[i].values for c in ("k", "label")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["k", "label", "code", "error"])

    k, label = (blocks.schema[c].dataType.elementType.simpleString() for c in ("k", "label"))
    return blocks.mapInArrow(work, f"k {k}, label {label}, code string, error long")


def with_label_error(coded: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """``coded`` with the errors summed over equal labels, null labels together.

    Labels with at least a ``hot_share``-th of the rows, so at most ``hot_share`` of them, are broadcast and their
    rows stay where they are; only rows of other labels are dealt by label.
    """
    sums = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    rows = sums.agg(F.sum("n")).first()[0] or 0
    hot = sums.where(F.col("n") * hot_share >= rows).select(F.col("label").alias("l"), "label_error")
    cold = sums.where(F.col("n") * hot_share < rows).select(F.col("label").alias("l"), "label_error")
    same = F.col("label").eqNullSafe(F.col("l"))
    kept = coded.join(F.broadcast(hot), same).drop("l")
    return kept.unionByName(coded.join(F.broadcast(hot.select("l")), same, "left_anti").join(cold, same).drop("l"))


def product_codes(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """((key, code, error, label_error), codebooks): every vector as one entry number per part.

    The codebooks (parts x entries x components, integers) start from the vectors with the smallest keys; a null key
    comes last, equal keys go by the integers.  With fewer vectors there are fewer entries.  Codes are two hex digits
    a part, errors squared distances summed over parts.  Rows with a null vector or a null or non-finite component
    are dropped, repeated rows keep their own rows, other columns are not read.  An empty table gives an empty table
    and empty codebooks.  Vectors of different lengths, of a length that the parts do not divide, or with components
    beyond 2^26 after scaling raise.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    rows = integer_vectors(table, key, vector, label, scale)
    first = [r.v for r in rows.orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    width = len(first[0]) if first else 0
    if any(len(v) != width for v in first) or width % parts:
        raise ValueError(f"vectors must have one length that {parts} divides")
    books = np.array(first, np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    blocks = materialise(value_blocks(rows, width), "value-blocks")
    for _ in range(rounds if first else 0):
        books = _next_books(blocks, books)
    coded = with_label_error(materialise(_coded(blocks, books), "value-codes"))
    return coded.select(F.col("k").alias(key), "code", "error", "label_error"), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


_START = f"""kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as double)) as v from embeddings
 where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as (select vec_id, p, list_slice(v, cast(p * len(v) // {PARTS} + 1 as bigint), cast((p + 1) * len(v) // {PARTS} as bigint)) as v from kept, range({PARTS}) r(p)),
book0 as (select p, row_number() over (partition by p order by vec_id) - 1 as entry, v from part qualify entry < {ENTRIES})"""


def _assigned(r: int) -> str:
    """Squared distances as whole numbers; the entry is the remainder, so the smallest of equals wins."""
    gap = "list_inner_product(a.v, a.v) - 2 * list_inner_product(a.v, b.v) + list_inner_product(b.v, b.v)"
    return f"near{r} as (select a.vec_id, a.p, min(cast({gap} as bigint) * {ENTRIES} + b.entry) as best from part a join book{r} b on a.p = b.p group by a.vec_id, a.p)"


def _moved(r: int) -> str:
    return f"""{_assigned(r)},
sum{r} as (select p, entry, position, cast(sum(x) as bigint) as total, count(*) as n from (select a.p, best % {ENTRIES} as entry, unnest(a.v) as x, unnest(range(len(a.v))) as position
 from near{r} join part a using (vec_id, p)) group by p, entry, position),
mean{r} as (select p, entry, list(cast((total - ((total % n) + n) % n) // n as double) order by position) as v from sum{r} group by p, entry),
book{r + 1} as (select b.p, b.entry, coalesce(m.v, b.v) as v from book{r} b left join mean{r} m using (p, entry))"""


ORACLE = f"""with {_START}, {", ".join(_moved(r) for r in range(ROUNDS))}, {_assigned(ROUNDS)},
coded as (select vec_id, string_agg(printf('%02x', best % {ENTRIES}), '' order by p) as code, cast(sum(best // {ENTRIES}) as bigint) as error from near{ROUNDS} group by vec_id),
digest as (select sha256(string_agg(array_to_string(list_transform(v, lambda x: cast(x as bigint)), ','), ',' order by p, entry)) as codebooks_sha256 from book{ROUNDS})
select c.vec_id, c.code, c.error, cast(sum(c.error) over (partition by k.label) as bigint) as label_error, d.codebooks_sha256
from coded c join kept k using (vec_id), digest d"""
