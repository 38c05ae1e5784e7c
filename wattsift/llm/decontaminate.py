"""Benchmark passages in training documents, by suffix arrays over shards of the documents.

A task lays the words of its documents out as shards of bounded size, sorts the suffixes of each shard (as deep as the
longest test suffix, no search looks deeper) and binary-searches every test suffix that holds a window.  What it finds
are all places of every window and, from there, the longest verbatim matches.  Words are numbers of the test
vocabulary, three to a sorting key; a document word outside of it ends every match, so suffixes that start with one
are left out of the array.

A test set larger than ``BLOCK_BYTES`` is searched in blocks, one pass over the documents each, and the blocks'
findings are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattsift.llm.words import cut_points, free_name
from wattsift.session import materialise

WINDOW = 13
SHARD_WORDS = 2_000_000
BLOCK_BYTES = 16 << 20
WORD_BITS = 21
LOW = np.int64((1 << WORD_BITS) - 1)

_CLEAN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def word_lists(text: str | None) -> Iterator[list[bytes]]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text, in slices; null has none."""
    if text:
        for part in cut_points(text.encode("utf-8", "surrogatepass").translate(_CLEAN), frozenset(b" ")):
            yield part.split()


def _packed(words: np.ndarray) -> np.ndarray:
    """Three words from each place on as one number; what follows a 0 counts as 0."""
    first = words[:-2]
    second = np.where(first != 0, words[1:-1], 0)
    third = np.where(second != 0, words[2:], 0)
    return first << 2 * WORD_BITS | second << WORD_BITS | third


def suffix_array(packed: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their suffixes, compared for ``depth`` words or up to a 0."""
    order = np.argsort(packed[starts], kind="stable")
    array = starts[order]
    key = packed[array]
    tied = np.concatenate(([False], (key[1:] == key[:-1]) & (key[1:] & LOW != 0)))  # with the one before
    done = 3
    while done < depth:
        at = np.flatnonzero(tied | np.append(tied[1:], False))
        if not len(at):
            break
        run = np.cumsum(~tied[at])
        key = packed[array[at] + done]
        order = np.lexsort((key, run))
        array[at], key = array[at][order], key[order]
        tied = np.zeros(len(array), bool)
        tied[at[1:]] = (run[1:] == run[:-1]) & (key[1:] == key[:-1]) & (key[1:] & LOW != 0)
        done += 3
    return array


def _bound(packed: np.ndarray, array: np.ndarray, done: int, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
    """First place in [low, high) of the array whose key after ``done`` words is not below ``value``."""
    low, high = low.copy(), high.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) >> 1
        less = packed[array[middle] + done] < value[open_]
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    return low


def search(packed: np.ndarray, array: np.ndarray, tests: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range [low, high) of the suffix array that begins with the ``lengths`` words of ``tests`` (packed) at ``starts``."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(array))
    left, done = lengths.copy(), 0
    while len(at := np.flatnonzero((left > 0) & (low < high))):
        spare = WORD_BITS * (3 - np.minimum(left[at], 3))
        value = tests[starts[at] + done] >> spare << spare
        end = value + (np.int64(1) << spare)
        a = _bound(packed, array, done, low[at], high[at], value)
        high[at] = _bound(packed, array, done, a, high[at], end)
        low[at] = a
        left[at] -= 3
        done += 3
        left[low >= high] = 0
    return low, np.maximum(high, low)


class TestSet:
    """Words of one block of test items, their distinct windows, and the items and places of each window."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        flat: list[int] = []
        self.items = sorted({i for i, _ in items})
        rank = {i: k for k, i in enumerate(self.items)}
        places: dict[tuple[int, ...], list[int]] = {}
        owner: list[int] = []
        self.depth = 1
        for item, text in items:
            words = [number(w, len(self.vocabulary) + 1) for part in word_lists(text) for w in part]
            if not words:
                continue
            width = min(window, len(words))
            for j in range(len(words) - width + 1):
                places.setdefault(tuple(words[j : j + width]), []).append(len(flat) + j)
            self.depth = max(self.depth, len(words))
            flat += [*words, 0]
            owner += [rank[item]] * (len(words) + 1)
        if len(self.vocabulary) > LOW:
            raise ValueError("a block of the test set has too many different words")
        self.words = np.array(flat + [0] * (self.depth + 6), np.int64)
        self.packed = _packed(self.words)
        self.owner = np.array(owner + [0], np.int64)
        self.lengths = np.array([len(w) for w in places], np.int64)
        self.starts = np.array([p[0] for p in places.values()], np.int64)
        self.places = np.array([p for ps in places.values() for p in ps], np.int64)
        self.first = np.concatenate(([0], np.cumsum([len(p) for p in places.values()]))).astype(np.int64)

    def numbers(self, text: str | None) -> list[np.ndarray]:
        get = self.vocabulary.get
        return [np.fromiter(map(get, part, repeat(0)), np.int64, len(part)) for part in word_lists(text)]


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, member) for all members of the ranges [low, high)."""
    count = high - low
    which = np.repeat(np.arange(len(low)), count)
    return which, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[which]


def scan_shard(documents: list[np.ndarray], tests: TestSet) -> list[dict]:
    """Per document: word count, hit ranges [start, end), items found and the longest verbatim match."""
    sizes = np.array([len(d) for d in documents], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    words = np.zeros(int((sizes + 1).sum()) + tests.depth + 6, np.int64)
    for at, d in zip(first.tolist(), documents, strict=True):
        words[at : at + len(d)] = d
    found = [{"n_words": int(n), "hits": [], "items": [], "longest": None} for n in sizes]
    if not len(tests.starts):
        return found
    packed = _packed(words)
    array = suffix_array(packed, np.flatnonzero(words), tests.depth)
    low, high = search(packed, array, tests.packed, tests.starts, tests.lengths)
    which, at = _ranges(low, high)
    if not len(at):
        return found
    place = array[at]
    document = np.searchsorted(first, place, side="right") - 1

    # words inside any occurrence, as ranges
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + tests.lengths[which], -1)
    inside = np.concatenate(([False], np.cumsum(edge) > 0))
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
        d = int(np.searchsorted(first, a, side="right") - 1)
        found[d]["hits"].append((a - int(first[d]), b - int(first[d])))

    # items, and matches that do not go on to the left
    pair, test = _ranges(tests.first[which], tests.first[which + 1])
    test, place, document = tests.places[test], place[pair], document[pair]
    both = np.unique(document * (len(tests.items) + 1) + tests.owner[test])
    for d, i in zip((both // (len(tests.items) + 1)).tolist(), (both % (len(tests.items) + 1)).tolist(), strict=True):
        found[d]["items"].append(tests.items[i])
    before = np.where(place > 0, words[place - 1], 0)
    start = (before == 0) | (test == 0) | (before != tests.words[test - 1])
    test, place, document = test[start], place[start], document[start]
    length = np.zeros(len(test), np.int64)
    open_ = np.arange(len(test))
    while len(open_):
        w = words[place[open_] + length[open_]]
        open_ = open_[(w != 0) & (w == tests.words[test[open_] + length[open_]])]
        length[open_] += 1
    order = np.lexsort((test, place, -length, document))
    head = order[np.concatenate(([True], document[order][1:] != document[order][:-1]))]
    ends = np.flatnonzero(np.concatenate(([True], tests.words[:-1] == 0)))  # where items begin
    for k in head.tolist():
        d, t = int(document[k]), int(test[k])
        begin = int(ends[np.searchsorted(ends, t, side="right") - 1])
        found[d]["longest"] = {"words": int(length[k]), "start": int(place[k] - first[d]), "item": tests.items[int(tests.owner[t])], "item_start": t - begin}
    return found


def _scanned(batches: Iterator[pa.RecordBatch], text: int, tests: TestSet, shard_words: int) -> Iterator[tuple[pa.RecordBatch, list[dict]]]:
    """Runs of rows with their findings, a shard at a time."""
    held: list[pa.RecordBatch] = []
    documents: list[np.ndarray] = []
    total = 0

    def flush() -> Iterator[tuple[pa.RecordBatch, list[dict]]]:
        found, at = scan_shard(documents, tests), 0
        for rows in held:
            yield rows, found[at : at + rows.num_rows]
            at += rows.num_rows

    for batch in batches:
        begin = 0
        for at, t in enumerate(batch.column(text)):
            parts = tests.numbers(t.as_py())
            documents.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
            total += len(documents[-1]) + 1
            if total >= shard_words:
                held.append(batch.slice(begin, at + 1 - begin))
                yield from flush()
                held, documents, total, begin = [], [], 0, at + 1
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield from flush()


FOUND = (
    "n_words bigint, hits array<struct<start: bigint, end: bigint>>, items array<string>, "
    "longest struct<words: bigint, start: bigint, item: string, item_start: bigint>"
)
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_LONGEST = pa.struct([("words", pa.int64()), ("start", pa.int64()), ("item", pa.string()), ("item_start", pa.int64())])


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[DataFrame]:
    """Rows (item id, text) of the test set in blocks of about ``block_bytes``, dealt by a hash of both; a null item id
    counts as the empty one.  With several blocks, rows equal in both stand there once."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    size = F.sum(F.octet_length("t"))
    if (rows.agg(size).first()[0] or 0) <= block_bytes:
        return [rows]
    rows = materialise(rows.distinct(), "test-set")
    blocks = -(-(rows.agg(size).first()[0] or 0) // block_bytes) or 1
    return [rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block) for block in range(blocks)]


def _shared(rows: DataFrame, window: int) -> Broadcast:
    """The test set of one block, at the executors."""
    return rows.sparkSession.sparkContext.broadcast(TestSet([(r.i, r.t) for r in rows.collect()], window))


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, n_words, hits, items, longest): one row per row of ``docs``.

    ``hits`` are the word ranges inside any occurrence of a window: ``window`` consecutive words of an item, or all
    words of a shorter one.  ``items`` are the ids with occurring windows, sorted as strings; ``longest`` is the
    longest verbatim match, the first of equals.  Null texts and items have no words.  Repeated documents give
    repeated rows, repeated items count once.  An empty benchmark hits nothing.
    """
    kind = docs.schema[key].dataType.simpleString()
    parts = []
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    for block in blocks:
        shared = _shared(block, window)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for rows, found in _scanned(batches, 1, shared.value, shard_words):
                columns = [
                    pa.array([f["n_words"] for f in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in f["hits"]] for f in found], _HITS),
                    pa.array([f["items"] for f in found], pa.list_(pa.string())),
                    pa.array([f["longest"] for f in found], _LONGEST),
                ]
                digest = pa.array([hashlib.md5((t.as_py() or "").encode("utf-8", "surrogatepass")).digest() for t in rows.column(1)], pa.binary())
                names = [key, "n_words", "hits", "items", "longest", "_digest"]
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns, digest], names=names)

        part = docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, {FOUND}, _digest binary")
        if len(blocks) == 1:
            return part.drop("_digest")
        parts.append(materialise(part, "block-matches"))  # before the next block is built
        shared.destroy()
    return _merged(parts, key)


def _merged(parts: list[DataFrame], key: str) -> DataFrame:
    """Findings of several blocks per document; rows equal in key and text have equal findings."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    best = F.struct((-F.col("longest.words")).alias("a"), F.col("longest.start").alias("b"), F.col("longest.item").alias("c"), F.col("longest").alias("longest"))
    whole = rows.groupBy(key, "_digest", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.min(F.when(F.col("longest").isNotNull(), best)).alias("best"),
        F.count("*").alias("copies"),
    )
    copies = F.explode(F.sequence(F.lit(1), (F.col("copies") / len(parts)).cast("int")))
    return whole.select(key, "n_words", _joined("all").alias("hits"), "items", F.col("best.longest").alias("longest"), copies.alias("_copy")).drop("_copy")


def _joined(ranges: str) -> Column:
    """The sorted ranges of a column as ranges that do not touch."""
    hit = "struct<start: bigint, end: bigint>"
    return F.expr(
        f"aggregate({ranges}, cast(array() as array<{hit}>), (acc, h) -> case when size(acc) > 0 and h.start <= element_at(acc, -1).end "
        f"then concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, h.end)))) "
        f"else concat(acc, array(h)) end)"
    )


def hit_words(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])


def is_contaminated(n_words: Column, n_hit: Column, share: int = 20) -> Column:
    """Hit words are one in ``share`` or more of all words."""
    return (n_hit > 0) & (n_hit * share >= n_words)


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, share: int = 20, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns; rows without words stay.

    With several blocks each pass writes the ranges of the texts it hits, before the next block is built.
    """
    at = docs.columns.index(text)
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    if len(blocks) == 1:
        shared = _shared(blocks[0], window)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, found in _scanned(batches, at, shared.value, shard_words):
                n_hit = [sum(b - a for a, b in f["hits"]) for f in found]
                yield part.filter(pa.array([not (n > 0 and n * share >= f["n_words"]) for n, f in zip(n_hit, found, strict=True)], pa.bool_()))

        return docs.mapInArrow(work, docs.schema)
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    texts, parts = docs.select(digest.alias("d"), F.col(text).alias("t")), []
    for block in blocks:
        shared = _shared(block, window)

        def ranges(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, found in _scanned(batches, 1, shared.value, shard_words):
                hit = [(d, f) for d, f in zip(part.column(0).to_pylist(), found, strict=True) if f["hits"]]
                hits = pa.array([[{"start": a, "end": b} for a, b in f["hits"]] for _, f in hit], _HITS)
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in hit], pa.binary()), pa.array([f["n_words"] for _, f in hit], pa.int64()), hits], names=["d", "n_words", "hits"])

        found = texts.mapInArrow(ranges, "d binary, n_words bigint, hits array<struct<start: bigint, end: bigint>>")
        parts.append(materialise(found.groupBy("d", "n_words").agg(F.first("hits").alias("hits")), "block-hits"))  # equal texts have equal hits
        shared.destroy()
    whole = reduce(DataFrame.unionByName, parts).groupBy("d", "n_words").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("all"))
    own, gone = free_name(docs.columns, "_digest"), free_name(docs.columns, "_gone")
    hit = whole.where(is_contaminated(F.col("n_words"), hit_words(_joined("all")), share)).select(F.col("d").alias(gone))
    marked = docs.withColumn(own, digest)
    return marked.join(hit, marked[own] == hit[gone], "left_anti").drop(own)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""with items as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark),
tests as (select distinct item, least(13, len(w)) as k, array_to_string(list_slice(w, j, j + least(13, len(w)) - 1), ' ') as win
 from (select item, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) as j from items where len(w) > 0) t),
docs as (select doc_id, {_WORDS} as w from documents),
places as (select doc_id, k, j, array_to_string(list_slice(w, j, j + k - 1), ' ') as win
 from (select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) as j from docs, (select distinct k from tests) where len(w) >= k) t),
found as (select doc_id, item, j, k from places join tests using (k, win)),
hits as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(generate_series(j, j + k - 1)) as place from found) t group by doc_id),
owners as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as names from found group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
 coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from docs d left join hits using (doc_id) left join owners using (doc_id)"""
