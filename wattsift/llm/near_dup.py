"""Near-duplicate texts: SimHash fingerprints joined with themselves through a binary trie.

Each distinct fingerprint is seen four times, turned so that another 16-bit block comes first.  Two fingerprints
with at most three differing bits agree on one block at least, so under one of the turns their paths through the
trie share the first 16 levels.  A task holds whole subtrees as sorted arrays and walks pairs of nodes together,
adding up differing bits and dropping a pair of nodes once the budget is exceeded.  A subtree with too many
fingerprints for one task is cut six levels further down into pairs of smaller nodes, again and again if need be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattsift.llm.words import free_name, spaced_words, text_rows
from wattsift.session import materialise

BITS, BLOCK = 64, 16
BUDGET = BITS // BLOCK - 1  # differing bits that leave one block whole
STEP = 6  # levels by which a node too large for one task is cut
NODE_ROWS = 200_000
FLUSH_ROWS = 65_536
FRONTIER = 131_072
FILTER_WORDS = 1 << 20  # words of 64 bits in the filter of removed rows: 8 MB of bits whatever the table


def simhash(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint: a bit is set if more than half of the shingles' XXH64 have it; no words: 0.

    Shingles are ``width`` consecutive words with one space between; a shorter text is one shingle.
    """
    counts, total, tail = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in spaced_words(text):
        words = tail + words
        if len(words) < width:
            tail = words
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))
        spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], np.uint64)
        for part in np.array_split(hashes, len(hashes) // FLUSH_ROWS + 1):
            set_ = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += (np.ones(len(part), np.float32) @ set_.astype(np.float32)).astype(np.int64)
        total += len(hashes)
        tail = words[len(words) - width + 1 :]
    if not total and tail:
        counts, total = counts + [digest(b" ".join(tail), seed) >> b & 1 for b in range(BITS)], 1
    value = int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, bits): one row per row of ``docs``, repeated rows included; null and empty texts have 0.

    Other columns of ``docs`` are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = pa.array([simhash(t, width) for _, t in text_rows(batch, key, text)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(key), bits], names=[key, "bits"])

    rows = docs.select(key, text)
    return rows.mapInArrow(work, f"`{key}` {rows.schema[key].dataType.simpleString()}, bits long")


# ---------------------------------------------------------------------------------------------- the trie join


def _turned(bits: Column, turn: int) -> Column:
    return F.shiftleft(bits, BLOCK * turn).bitwiseOR(F.shiftrightunsigned(bits, BITS - BLOCK * turn)) if turn else bits


def _node_pairs(prints: DataFrame, node_rows: int) -> DataFrame:
    """Rows (turn, depth, left, right, spent, bits): the fingerprints below each pair of trie nodes to be joined."""
    turns = F.explode(F.array(*[F.struct(F.lit(t).alias("turn"), _turned(F.col("bits"), t).alias("bits")) for t in range(BITS // BLOCK)]))
    rows = prints.select(turns.alias("t")).select("t.turn", "t.bits")
    prefix = F.shiftrightunsigned("bits", BITS - BLOCK)
    rows = rows.select("turn", F.lit(BLOCK).alias("depth"), prefix.alias("left"), prefix.alias("right"), F.lit(0).alias("spent"), "bits")
    node = ["turn", "depth", "left", "right"]
    done = None
    while True:
        large = rows.where(F.col("depth") < BITS).groupBy(*node).count().where(F.col("count") > node_rows).select(*node)
        large = materialise(large, "large-nodes")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        part = rows.join(large, node, "left_anti")
        done = part if done is None else done.unionByName(part)
        rows = materialise(_cut(rows.join(large, node, "left_semi")), "cut-nodes")


def _cut(rows: DataFrame) -> DataFrame:
    """The same rows below pairs of nodes ``STEP`` levels further down, as far as the budget allows."""
    depth = F.col("depth")
    own = F.expr(f"shiftrightunsigned(bits, {BITS} - depth)")
    child = F.expr(f"shiftrightunsigned(bits, {BITS - STEP} - depth) & {(1 << STEP) - 1}L")
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("cost")) for m in range(1 << STEP) if m.bit_count() <= BUDGET])
    rows = rows.withColumns({"own": own, "child": child}).withColumn("m", F.explode(masks))
    rows = rows.where(F.col("spent") + F.col("m.cost") <= BUDGET)
    other = F.when(F.col("own") == F.col("left"), F.col("right")).otherwise(F.col("left"))
    mine = F.shiftleft("own", STEP).bitwiseOR(F.col("child"))
    theirs = F.shiftleft(other, STEP).bitwiseOR(F.col("child").bitwiseXOR(F.col("m.mask")))
    same = F.col("left") == F.col("right")
    first = F.when(same, F.least("mine", "theirs")).when(F.col("own") == F.col("left"), F.col("mine")).otherwise(F.col("theirs"))
    second = F.when(same, F.greatest("mine", "theirs")).when(F.col("own") == F.col("left"), F.col("theirs")).otherwise(F.col("mine"))
    return rows.withColumns({"mine": mine, "theirs": theirs}).select(
        "turn", (depth + STEP).alias("depth"), first.alias("left"), second.alias("right"), (F.col("spent") + F.col("m.cost")).alias("spent"), "bits"
    )


def _leading(values: np.ndarray) -> np.ndarray:
    """Number of leading zero bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        values = values | (values >> np.uint64(shift))
    return BITS - np.bitwise_count(values).astype(np.int64)


def _split(bits: np.ndarray, low: np.ndarray, high: np.ndarray, level: np.ndarray) -> np.ndarray:
    """First place in [low, high) whose bit at ``level`` is set; the ranges are sorted and agree above that level."""
    shift = (BITS - 1 - level).astype(np.uint64)
    low, high = low.copy(), high.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) >> 1
        is_set = (bits[middle] >> shift[open_]) & np.uint64(1) == 1
        high[open_] = np.where(is_set, middle, high[open_])
        low[open_] = np.where(is_set, low[open_], middle + 1)
    return low


class Forest:
    """Roots of what has been linked so far among ``n`` fingerprints."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root, up := root[root]):
                root[:] = up


def _walk(bits: np.ndarray, roots: list[tuple], forest: Forest, budget: int, leaf: int = 16) -> None:
    """Walk pairs of trie nodes (ranges of sorted fingerprints) together and link what is within the budget.

    A node's path is compressed: it branches at the first bit in which its first and last fingerprint differ.
    ``roots``: (low, high, low, high, bits compared, bits spent) arrays.
    """
    stack = [np.array(roots, np.int64).reshape(-1, 6).T]
    while stack:
        pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            stack += [pairs[:, FRONTIER:], pairs[:, :FRONTIER]]
            continue
        la, ha, lb, hb, seen, spent = pairs
        own = la == lb
        branch_a, branch_b = _leading(bits[la] ^ bits[ha - 1]), _leading(bits[lb] ^ bits[hb - 1])
        upto = np.minimum(branch_a, branch_b)
        # bits between what has been compared and the next branch
        differing = bits[la] ^ bits[lb]
        kept = np.where(upto >= BITS, ~np.uint64(0), ~(~np.uint64(0) >> np.minimum(upto, BITS - 1).astype(np.uint64)))
        above = np.where(seen >= BITS, np.uint64(0), ~np.uint64(0) >> np.minimum(seen, BITS - 1).astype(np.uint64))
        spent = spent + np.where(own, 0, np.bitwise_count(differing & kept & above))
        seen = np.maximum(seen, upto)
        go = (spent <= budget) & ~(own & (ha - la < 2))
        la, ha, lb, hb, seen, spent, own, branch_a, branch_b, upto = (x[go] for x in (la, ha, lb, hb, seen, spent, own, branch_a, branch_b, upto))
        small = ((ha - la) * (hb - lb) <= leaf) | (upto >= BITS)
        _leaves(bits, la[small], ha[small], lb[small], hb[small], forest, budget)
        la, ha, lb, hb, seen, spent, own, branch_a, upto = (x[~small] for x in (la, ha, lb, hb, seen, spent, own, branch_a, upto))
        if not len(la):
            continue
        cut_a = branch_a == upto
        low, high = np.where(cut_a, la, lb), np.where(cut_a, ha, hb)
        middle = _split(bits, low, high, upto)
        parts = []
        for pick, a0, a1, b0, b1 in (
            (own, la, middle, la, middle), (own, middle, ha, middle, ha), (own, la, middle, middle, ha),
            (~own & cut_a, la, middle, lb, hb), (~own & cut_a, middle, ha, lb, hb),
            (~own & ~cut_a, la, ha, lb, middle), (~own & ~cut_a, la, ha, middle, hb),
        ):
            parts.append(np.stack([a0[pick], a1[pick], b0[pick], b1[pick], seen[pick], spent[pick]]))
        stack.append(np.concatenate(parts, axis=1))


def _leaves(bits: np.ndarray, la, ha, lb, hb, forest: Forest, budget: int) -> None:
    """Compare every fingerprint of small node pairs."""
    if not len(la):
        return
    width = hb - lb
    count = (ha - la) * width
    first = np.repeat(np.cumsum(count) - count, count)
    at = np.arange(count.sum()) - first
    width = np.repeat(width, count)
    i, j = np.repeat(la, count) + at // width, np.repeat(lb, count) + at % width
    near = (i != j) & (np.bitwise_count(bits[i] ^ bits[j]) <= budget)
    forest.link(i[near], j[near])


def _link_nodes(rows: dict[str, np.ndarray], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) that span what is connected within each pair of nodes; rows are sorted by node pair."""
    bits = rows["bits"].view(np.uint64)
    node = np.stack([rows[c] for c in ("turn", "depth", "left", "right")])
    starts = np.flatnonzero(np.concatenate(([True], (node[:, 1:] != node[:, :-1]).any(0))))
    stops = np.append(starts[1:], len(bits))
    left, right = rows["left"][starts], rows["right"][starts]
    depth, spent = rows["depth"][starts].astype(np.int64), rows["spent"][starts].astype(np.int64)
    same = left == right
    own = bits >> np.repeat((BITS - depth).astype(np.uint64), stops - starts)
    on_left = np.concatenate(([0], np.cumsum(own.view(np.int64) == np.repeat(left, stops - starts))))
    middle = starts + (on_left[stops] - on_left[starts])
    both = ~same & (middle > starts) & (middle < stops)
    zero = np.zeros_like(starts)
    roots = np.concatenate(
        [
            np.stack([starts, stops, starts, stops, depth, zero], 1)[same],
            np.stack([starts, middle, middle, stops, depth, spent], 1)[both],
        ]
    )
    forest = Forest(len(bits))
    _walk(bits, roots, forest, budget)
    linked = np.flatnonzero(forest.root != np.arange(len(bits)))
    turn = rows["turn"].astype(np.uint64) * np.uint64(BLOCK)
    back = np.where(turn == 0, bits, (bits >> turn) | (bits << ((np.uint64(BITS) - turn) % np.uint64(BITS))))
    return back[linked].view(np.int64), back[forest.root[linked]].view(np.int64)


COLUMNS = ("turn", "depth", "left", "right", "spent", "bits")


def near_links(prints: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``prints`` (column ``bits``, distinct) at ``budget`` or fewer
    differing bits.  Not every such pair is a row: within a task a spanning forest of the links is returned."""
    if not 0 <= budget <= BUDGET:
        raise ValueError(f"the budget is 0 to {BUDGET} bits")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            a, b = _link_nodes({c: rows.column(c).to_numpy() for c in COLUMNS}, budget)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < FLUSH_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            node = np.stack([rows.column(c).to_numpy() for c in COLUMNS[:4]])
            ends = np.flatnonzero((node[:, 1:] != node[:, :-1]).any(0))
            if len(ends):  # the last pair of nodes may go on in the next batch
                yield flush(rows.slice(0, int(ends[-1]) + 1))
                held = rows.slice(int(ends[-1]) + 1).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    pairs = _node_pairs(prints.select("bits"), node_rows)
    dealt = pairs.repartition("turn", "depth", "left", "right").sortWithinPartitions(*COLUMNS[:4], "bits")
    return dealt.select(*COLUMNS).mapInArrow(work, "a long, b long")


# ---------------------------------------------------------------------------------------------- components


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node each linked node is connected with; ``links`` has columns a and b.

    Large-star and small-star rounds: every round ties neighbours to the smallest one seen, until nothing changes.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = materialise(links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.union(least).distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
        before = state
    raise RuntimeError("the components did not settle")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, budget: int = BUDGET, node_rows: int = NODE_ROWS) -> DataFrame:
    """(key, fingerprint, component_id): one row per row of ``docs``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest key reachable over fingerprints that differ in
    at most ``budget`` bits.  Texts without words (null, empty) share the fingerprint zero and are linked like any
    other.  Repeated rows keep their own rows.  A null key gets a component like any other row, and is the
    component's id only if there is no other key in it.  An empty table gives an empty table.
    """
    prints = materialise(fingerprints(docs, key, text, width), "fingerprints")
    classes = materialise(prints.groupBy("bits").agg(F.min(key).alias("least")), "classes")
    roots = materialise(components(near_links(classes, budget, node_rows)), "roots")
    tied = classes.join(roots, F.col("bits") == F.col("node"))
    named = tied.join(tied.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("bits", "component_id")
    lone = classes.join(named, "bits", "left_anti").select("bits", F.col("least").alias("component_id"))
    ids = materialise(named.union(lone), "components")
    shown = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return prints.join(ids, "bits").select(key, shown, "component_id")


def _filter_probe(h: Column, words: int) -> tuple[Column, Column]:
    """The word of the filter that a hash belongs to, and the three bits it sets there."""
    shift = words.bit_length() - 1
    mask = F.lit(0).cast("long")
    for i in range(3):
        place = F.shiftrightunsigned(h, shift + 6 * i).bitwiseAND(F.lit(BITS - 1)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return h.bitwiseAND(F.lit(words - 1).cast("long")), mask


def without_rows(docs: DataFrame, gone: DataFrame, pairs: list[tuple[str, str]], filter_words: int = FILTER_WORDS) -> DataFrame:
    """Rows of ``docs`` that agree with no row of ``gone`` in all ``pairs`` of columns; null equals null.

    One plan for every size.  The keys in ``gone`` set bits of a Bloom filter of ``filter_words`` (a power of two)
    words, which is broadcast: at most that many rows of two integers.  Rows that miss it stay where they are; only
    rows that hit it are dealt by key and merged with ``gone``.  Exact whatever the filter says: if ``gone`` is so
    large that it fills the filter, all rows travel.
    """
    word, mask, held = (free_name([*docs.columns, *gone.columns], x) for x in ("_word", "_mask", "_held"))
    where, bits = _filter_probe(F.xxhash64(*[F.col(g) for _, g in pairs]), filter_words)
    filter_ = gone.select(where.alias(word), bits.alias(mask)).groupBy(word).agg(F.bit_or(mask).alias(held))
    where, bits = _filter_probe(F.xxhash64(*[F.col(c) for c, _ in pairs]), filter_words)
    marked = docs.withColumns({word: where, mask: bits}).join(F.broadcast(materialise(filter_, "filter")), word, "left")
    hit = F.coalesce(F.col(held).bitwiseAND(F.col(mask)) == F.col(mask), F.lit(False))
    missed, met = marked.where(~hit).select(*docs.columns), marked.where(hit).select(*docs.columns)
    same = F.lit(True)
    for c, g in pairs:
        same = same & met[c].eqNullSafe(gone[g])
    return missed.unionByName(met.join(gone.hint("merge"), same, "left_anti"))


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, budget: int = BUDGET, node_rows: int = NODE_ROWS, filter_words: int = FILTER_WORDS
) -> DataFrame:
    """One row of every component of near-duplicate texts; all columns.

    It is the row with the smallest key, of equal keys that with the smallest digest of the text; a null key comes
    last.  Of rows equal in key and text one stays, chosen by a hash of all columns.

    Near means ``budget`` or fewer differing bits over shingles of ``width`` words, the reading of the fingerprint
    query: copies with few changed words are found, looser ones (a similarity of 0.8 means some 7 bits) are not.
    Texts that stay are not moved, but for those the filter cannot tell from removed ones (``without_rows``).
    """
    names = docs.columns
    digest = F.coalesce(F.unhex(F.md5(F.col(text))), F.lit(b""))
    row = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("k"), digest.alias("d")).alias("row")
    prints = materialise(fingerprints(docs.select(row, F.col(text).alias("t")), "row", "t", width), "fingerprints")
    classes = materialise(prints.groupBy("bits").agg(F.min("row").alias("least"), F.count("*").alias("n")), "classes")
    roots = materialise(components(near_links(classes, budget, node_rows)), "roots")
    tied = classes.join(roots, F.col("bits") == F.col("node"))
    named = tied.join(tied.groupBy("root").agg(F.min("least").alias("stays")), "root").select("bits", "stays")
    lone = classes.where("n > 1").join(named, "bits", "left_anti").select("bits", F.col("least").alias("stays"))
    found = prints.join(materialise(named.union(lone), "components"), "bits").groupBy("row", "stays").agg(F.count("*").alias("copies"))
    one = F.col("row").eqNullSafe(F.col("stays"))
    k, d, own = free_name(names, "_gone"), free_name(names, "_gone_digest"), free_name(names, "_digest")
    gone = materialise(found.where(~one | (F.col("copies") > 1)).select(F.col("row.k").alias(k), F.col("row.d").alias(d), one.alias("stays")), "gone")
    marked = docs.withColumn(own, digest)
    drop, repeated = gone.select(k, d), gone.where("stays").select(k, d)
    rest = without_rows(marked, drop, [(key, k), (own, d)], filter_words).drop(own)
    if repeated.isEmpty():
        return rest
    order = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    again = marked.join(repeated.hint("merge"), marked[key].eqNullSafe(repeated[k]) & (marked[own] == repeated[d]), "left_semi")
    first = again.groupBy(F.col(key).alias(k), F.col(own).alias(d)).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in names]), order).alias(own))
    return rest.unionByName(first.select(f"{own}.*"))
