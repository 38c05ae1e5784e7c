"""Packing tokenised documents into as few sequences of a fixed size as possible.

The plan needs no documents, only how many pieces have each length, so its size is bounded by the sequence size and
it is made on the driver from that histogram:

1. Large lengths, in descending order, are cut into groups of equal cardinality and rounded up to the group's
   largest length.
2. For these few sizes the linear programme over sequence configurations is solved by column generation.
3. Its whole parts become sequences; each slot takes actual pieces of its group, which frees what rounding took.
4. What is left, and the small lengths, are best-fitted in descending order into the free space.

The plan is a list of runs "pieces of this length with these ranks go to these sequences at this offset".  The pieces
are ranked within their length in parallel and look up their place in the plan.
"""

from __future__ import annotations

import math
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattsift.llm.words import cut_points, free_name, text_rows
from wattsift.session import materialise

LIMIT = 2048
CACHED_WORDS = 400_000
SMALL = 8  # lengths up to a 1/SMALL of a sequence count as small
GROUPS = (24, 48, 96)  # numbers of groups that are tried; the plan with the fewest sequences is taken
RANKED_ROWS = 200_000  # rows per ranking bucket


# ---------------------------------------------------------------------------------------------- tokens


def _byte_letters() -> dict[int, str]:
    """Letters that a byte-level vocabulary writes for bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokens:
    """Token ids of texts as little-endian 32-bit bytes, word by word.

    The vocabulary's rules never join what white space parts, so the ids of a text are those of its words one after
    the other, and each word is encoded once.  Words of plain small letters go straight to the merge table; every
    other word goes through the whole tokenizer.  Two generations of words are kept, ``CACHED_WORDS`` each.
    """

    SIMPLE = frozenset("abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß")
    ENDS = (".", ",")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = {c: "".join(_byte_letters()[b] for b in c.encode()) for c in self.SIMPLE}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.marks = {c: self._whole([c])[0] for c in self.ENDS}

    def _whole(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _plain(self, word: str) -> bytes:
        return np.array([t.id for t in self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, word)))], "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        odd = []
        for raw in {w for w in words if w not in self.young}:
            if (known := self.old.get(raw)) is not None:
                self.young[raw] = known
                continue
            word = raw.decode("utf-8", "replace")
            low = word.lower()
            stem = low[:-1] if low[-1] in self.ENDS else low
            if stem and self.SIMPLE.issuperset(stem):
                self.young[raw] = self._plain(stem) + (self.marks[low[-1]] if stem is not low else b"")
            else:
                odd.append((raw, word))
        for (raw, _), ids in zip(odd, self._whole([w for _, w in odd]) if odd else [], strict=True):
            self.young[raw] = ids

    def ids(self, text: str) -> bytes:
        parts = []
        for part in cut_points(text.encode("utf-8", "replace")):
            words = part.split()
            try:
                parts.append(b"".join(map(self.young.__getitem__, words)))
            except KeyError:
                self._learn(words)
                parts.append(b"".join(map(self.young.__getitem__, words)))
        return b"".join(parts)


_tokens: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this Python worker, loaded once."""
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, limit: int = LIMIT, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): every document as token ids and ``end_id``, cut after each ``limit`` ids.

    ``ids`` holds little-endian unsigned 32-bit ids.  A null or empty text has the end id alone.  Repeated rows give
    repeated pieces; other columns are not read.  ``tokenizer`` is a file's place on every executor.
    """
    end = np.array([end_id], "<u4").tobytes()
    names = [key, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer or default_tokenizer())
        for batch in batches:
            rows: list[tuple] = []
            owner: list[int] = []
            for at, (_, t) in enumerate(text_rows(batch, key, text)):
                ids = tokens.ids(t or "") + end
                for piece, low in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[low : low + 4 * limit]
                    owner.append(at)
                    rows.append((piece, low // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(owner, pa.int32())), *arrays], names=names)

    rows = docs.select(key, text)
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(work, schema + (", ids binary" if with_ids else ""))


# ---------------------------------------------------------------------------------------------- the plan


def configurations(sizes: np.ndarray, wanted: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations (count of each size) and how often each is used, with the fewest sequences in fractions."""
    n = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    used = wanted / np.diag(basis)
    for _ in range(40 * n):
        worth = np.linalg.solve(basis.T, np.ones(n))
        column = _best_fill(sizes, np.maximum(worth, 0), capacity)
        if column @ worth <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        leave = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(leave))
        if not np.isfinite(leave[out]):
            break
        used = np.maximum(used - leave[out] * step, 0)
        used[out] = leave[out]
        basis[:, out] = column
    return [(basis[:, j].astype(int), used[j]) for j in range(n)]


def _best_fill(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of most worth (sizes may repeat)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    small, gain = sizes[order], worth[order]
    upto = np.searchsorted(small, np.arange(capacity + 1), side="right")
    for c in range(int(small[0]), capacity + 1):
        options = best[c - small[: upto[c]]] + gain[: upto[c]]
        k = int(np.argmax(options))
        best[c], last[c] = options[k], order[k]
    column, c = np.zeros(len(sizes)), capacity
    while last[c] >= 0:
        column[last[c]] += 1
        c -= int(sizes[last[c]])
    return column


class _Runs:
    """Pieces of descending length, taken from the front: [length, next rank, how many]."""

    def __init__(self, runs: list[list[int]]):
        joined: list[list[int]] = []
        for length, rank, n in runs:
            if joined and joined[-1][0] == length and sum(joined[-1][1:]) == rank:
                joined[-1][2] += n
            elif n:
                joined.append([length, rank, n])
        self.runs = joined[::-1]

    def take(self, most: int) -> tuple[int, int, int] | None:
        if not self.runs:
            return None
        run = self.runs[-1]
        length, rank, n = run[0], run[1], min(most, run[2])
        run[1], run[2] = rank + n, run[2] - n
        if not run[2]:
            self.runs.pop()
        return length, rank, n


def _plan(counts: dict[int, int], capacity: int, groups: int) -> tuple[list[tuple], int]:
    placed: list[tuple] = []  # (length, first rank, pieces, first sequence, offset)
    space: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free ids -> runs (first sequence, sequences)
    sequences = 0
    lengths = sorted((s for s, c in counts.items() if c and s > capacity // SMALL), reverse=True)
    total = sum(counts[s] for s in lengths)
    rest: list[list[int]] = []
    if total:
        share = -(-total // min(groups, total))
        grouped: list[list[list[int]]] = [[]]
        free = share
        for s in lengths:
            rank, left = 0, counts[s]
            while left:
                n = min(left, free)
                grouped[-1].append([s, rank, n])
                rank, left, free = rank + n, left - n, free - n
                if not free:
                    grouped.append([])
                    free = share
        grouped = [g for g in grouped if g]
        sizes = np.array([g[0][0] for g in grouped])
        wanted = np.array([sum(r[2] for r in g) for g in grouped], float)
        merged: dict[int, list[int]] = defaultdict(list)  # equal rounded sizes are one size
        for at, s in enumerate(sizes.tolist()):
            merged[s].append(at)
        keys = np.array(sorted(merged, reverse=True))
        pools = [_Runs([list(r) for at in merged[s] for r in grouped[at]]) for s in keys.tolist()]
        needs = np.array([wanted[merged[s]].sum() for s in keys.tolist()])
        for column, used in configurations(keys, needs, capacity):
            whole = math.floor(used + 1e-6)
            if not whole:
                continue
            runs, sequences = [(sequences, whole, 0)], sequences + whole
            for at in np.flatnonzero(column):
                for _ in range(int(column[at])):
                    runs = list(_fill(runs, pools[at], placed))
            for first, n, fill in runs:
                if fill:
                    space[capacity - fill].append((first, n))
                else:  # no piece was left for these
                    space[capacity].append((first, n))
        rest = [run for pool in pools for run in pool.runs[::-1]]
    rest += [[s, 0, c] for s, c in counts.items() if c and s <= capacity // SMALL]
    for s, rank, n in sorted(rest, key=lambda r: (-r[0], r[1])):
        while n:
            fit = min((r for r, runs in space.items() if r >= s and runs), default=None)
            if fit is None:
                new = -(-n // (capacity // s))
                space[capacity].append((sequences, new))
                sequences += new
                continue
            first, m = space[fit].pop()
            take = min(m, n)
            if m > take:
                space[fit].append((first + take, m - take))
            placed.append((s, rank, take, first, capacity - fit))
            space[fit - s].append((first, take))
            rank, n = rank + take, n - take
    return placed, sequences - sum(m for _, m in space[capacity])


def _fill(runs, pool: _Runs, placed: list[tuple]) -> Iterator[tuple[int, int, int]]:
    """Put one piece of the pool into each sequence of the runs; runs are cut where the length changes."""
    for first, n, fill in runs:
        while n and (got := pool.take(n)):
            length, rank, m = got
            placed.append((length, rank, m, first, fill))
            yield first, m, fill + length
            first, n = first + m, n - m
        if n:
            yield first, n, fill


def packing_plan(counts: dict[int, int], capacity: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset) for ``counts`` pieces of each length."""
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("a piece must be 1 to capacity ids long")
    return min((_plan(counts, capacity, g) for g in GROUPS), key=lambda p: p[1])[0]


def pack(cut: DataFrame, capacity: int = LIMIT, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """The pieces ``cut`` (column ``length``, all other columns stay) with ``sequence_id`` and ``offset``.

    ``cut`` is read more than once: hand in a stored table.  Pieces that are equal in ``order`` and length may swap
    places.  An empty table stays empty.
    """
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    plan = sorted(packing_plan(counts, capacity))
    low = np.array([(p[0] << 48) + p[1] for p in plan], np.int64)
    first, offset = np.array([p[3] for p in plan], np.int64), np.array([p[4] for p in plan], np.int64)

    names = list(cut.columns)
    bucket, start, rank = (free_name(names, n) for n in ("_bucket", "_start", "_rank"))
    buckets = -(-sum(counts.values()) // RANKED_ROWS) or 1
    rows = cut.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = rows.groupBy("length", bucket).count()
    before = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(start))
    within = F.row_number().over(Window.partitionBy("length", bucket).orderBy(*order))
    ranked = rows.withColumn(rank, within.cast("long")).join(starts, ["length", bucket])
    ranked = ranked.select(*names, (F.col(start) + F.col(rank) - 1).alias(rank))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (batch.column("length").to_numpy() << 48) + batch.column(rank).to_numpy()
            at = np.searchsorted(low, found, side="right") - 1
            arrays = [batch.column(c) for c in names]
            arrays += [pa.array(first[at] + (found - low[at]), pa.int64()), pa.array(offset[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInArrow(work, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: (key, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    cut = materialise(pieces(docs, key, text, tokenizer, limit, with_ids=with_ids), "pieces")
    return pack(cut, limit, (key, "piece", "ids_crc32"))
