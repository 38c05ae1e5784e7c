"""Likelihood of texts: a smoothed word model, and the marginal probability over all subword segmentations.

The subword model has the pieces of an existing vocabulary.  A piece's probability is its count in the training texts
(the vocabulary's own segmentation of every training word), smoothed by what its place in the vocabulary says (a
vocabulary lists frequent pieces first).  A word's probability is the sum over all ways to spell it with pieces, by a
forward recursion in log space; a text is its words and an end.

Tokens are counted per block of documents, so only the different words of a block travel: to their counts, and back to
the block as scores.  No table of all words is held by any task or by the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattsift.llm.words import spaced_words
from wattsift.session import materialise

BLOCK_WORDS = 2_000_000
SMOOTHING = 0.1
PRIOR_PIECES = 1_000.0  # weight of the vocabulary's order, in pieces
MARK = "▁"  # how the vocabulary writes the start of a word


# ---------------------------------------------------------------------------------------------- blocks


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


BLOCKS = "block long, `{key}` {kind}, held_out boolean, n_words long, at array<int>, times array<int>, words array<binary>, train array<int>"


def _blocks(docs: DataFrame, key: str, text: str, held_out: Column, block_words: int) -> DataFrame:
    """Rows of two forms: a document (``at``: its words in the block's list, ``times``), or a block's word list with
    the words' counts in training texts."""
    rows = docs.select(F.col(key), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("t"))
    kind = rows.schema[key].dataType
    names = ["block", key, "held_out", "n_words", "at", "times", "words", "train"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = TaskContext.get().partitionId() << 24, 0
        words, train = _Numbers(), np.zeros(1024, np.int64)
        held: list[tuple] = []
        key_type = None

        def flush() -> Iterator[pa.RecordBatch]:
            columns = list(zip(*held, strict=True))
            n = len(held)
            arrays = [
                pa.array([number] * n, pa.int64()), pa.array(columns[0], key_type), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64()),
                pa.array(columns[3], pa.list_(pa.int32())), pa.array(columns[4], pa.list_(pa.int32())),
                pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            counts = np.minimum(train[: len(words)], np.iinfo(np.int32).max).astype(np.int32)
            lists = [pa.array([list(words)], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int32()))]
            blank = [pa.nulls(1, t) for t in (key_type, pa.bool_(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *blank, *lists], names=names)

        for batch in batches:
            key_type = batch.column(0).type
            for k, out, t in zip(*batch.columns, strict=True):
                counts: Counter = Counter()
                n_words = 0
                for part in spaced_words(t.as_py()):
                    counts.update(part)
                    n_words += len(part)
                at = np.fromiter(map(words.__getitem__, counts), np.int32, len(counts))
                times = np.fromiter(counts.values(), np.int32, len(counts))
                if len(words) > len(train):
                    train = np.concatenate([train, np.zeros(len(words), np.int64)])
                if not out.as_py():
                    train[at] += times
                held.append((k.as_py(), out.as_py(), n_words, at, times))
                total += n_words + 1
                if total >= block_words:
                    yield from flush()
                    number, total, words, train, held = number + 1, 0, _Numbers(), np.zeros(1024, np.int64), []
        if held:
            yield from flush()

    return rows.mapInArrow(work, BLOCKS.format(key=key, kind=kind.simpleString()))


# ---------------------------------------------------------------------------------------------- the lattice


class PieceLattice:
    """Log probabilities of the vocabulary's pieces, and the marginal probability of a word."""

    def __init__(self, path: str, counts: dict[int, int], ends: int):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_file=path)
        size = vocabulary.get_piece_size()
        usable = [i for i in range(size) if not (vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_unused(i))]
        rank = {i: r for r, i in enumerate(sorted(usable, key=lambda i: (vocabulary.is_byte(i), -vocabulary.get_score(i), i)))}
        prior = {i: 1.0 / (r + 2.7) for i, r in rank.items()}  # frequency falls with the place in the vocabulary
        whole = sum(prior.values())
        total = sum(counts.get(i, 0) for i in usable) + ends + PRIOR_PIECES + 1.0
        logs = {i: math.log((counts.get(i, 0) + PRIOR_PIECES * prior[i] / whole) / total) for i in usable}
        self.end = math.log((ends + 1.0) / total)
        self.pieces = {vocabulary.id_to_piece(i): v for i, v in logs.items() if not vocabulary.is_byte(i)}
        self.bytes = {int(vocabulary.id_to_piece(i)[3:5], 16): v for i, v in logs.items() if vocabulary.is_byte(i)}
        self.longest = max(map(len, self.pieces))

    def word(self, raw: bytes) -> float:
        """Natural logarithm of the sum over all spellings of the word with pieces."""
        text = MARK + raw.decode("utf-8", "replace")
        get, longest, exp = self.pieces.get, self.longest, math.exp
        forward = [0.0]
        for end in range(1, len(text) + 1):
            low = end - longest if end > longest else 0
            terms = [forward[start] + p for start in range(low, end) if (p := get(text[start:end])) is not None]
            if text[end - 1] not in self.pieces:  # such a character is spelled byte by byte
                terms.append(forward[end - 1] + sum(self.bytes[b] for b in text[end - 1].encode("utf-8", "replace")))
            top = max(terms)
            forward.append(top + math.log(sum([exp(t - top) for t in terms])) if len(terms) > 1 else top)
        return forward[-1]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_vocabularies: dict[str, object] = {}


def _segmented(path: str):
    if path not in _vocabularies:
        import sentencepiece

        _vocabularies[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _vocabularies[path]


def _piece_counts(words: DataFrame, path: str) -> dict[int, int]:
    """How often each piece occurs in the words (column ``word``, ``c`` times each); as many rows as pieces at most."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _segmented(path)
        total = np.zeros(vocabulary.get_piece_size(), np.int64)
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            ids = vocabulary.encode(texts, num_threads=1)
            times = np.repeat(batch.column(1).to_numpy(), [len(i) for i in ids])
            np.add.at(total, np.array([p for i in ids for p in i], np.int64), times)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["piece", "n"])

    rows = words.select("word", "c").mapInArrow(work, "piece long, n long")
    return {r.piece: r.n for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


# ---------------------------------------------------------------------------------------------- scores


def score_texts(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per row of ``docs``.

    Learns from the rows where ``held_out`` is false or null.  Scores are log10 probabilities: ``base_score`` of the
    words under smoothed counts, ``score`` of the text under the subword lattice.  Null and empty texts are one end
    token.  Repeated rows count and are returned as often as they occur.  Without training texts every count is 0.
    """
    path = vocabulary or default_vocabulary()
    blocks = materialise(_blocks(docs, key, text, held_out, block_words), "word-blocks")
    lists = blocks.where("words is not null").select("block", F.posexplode(F.arrays_zip("words", "train")).alias("at", "w"))
    lists = lists.select("block", "at", F.col("w.words").alias("word"), F.col("w.train").cast("long").alias("train"))
    by_word = Window.partitionBy("word")
    first = F.row_number().over(by_word.orderBy("block")) == 1
    words = materialise(lists.select("word", "block", "at", F.sum("train").over(by_word).alias("c"), first.alias("first")), "words")
    seen = words.where("first and c > 0")
    totals = seen.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = blocks.where("words is null and not held_out").count()
    n, v = totals["n"] + ends, totals["v"] + (ends > 0)
    lattice = docs.sparkSession.sparkContext.broadcast(PieceLattice(path, _piece_counts(seen, path), ends))  # one entry per piece
    below = math.log10(n + SMOOTHING * (v + 1))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, last, known = lattice.value, b"", math.nan  # rows come sorted by word
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            scores = np.empty(len(coded.dictionary))
            for i, w in enumerate(coded.dictionary):
                word = w.as_py()
                if word != last or math.isnan(known):
                    last, known = word, model.word(word)
                scores[i] = known
            spelled = pa.array(scores[coded.indices.to_numpy()] / math.log(10.0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], spelled], names=["block", "at", "c", "spelled"])

    scored = words.select("word", "block", "at", "c").mapInArrow(spell, "block long, at int, c long, spelled double")
    texts = blocks.where("words is null").drop("words", "train")
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    end_base, end_score = math.log10(ends + SMOOTHING) - below, lattice.value.end / math.log(10.0)

    def add(texts: pa.Table, scores: pa.Table) -> pa.Table:
        at = scores.column("at").to_numpy()
        size = int(at.max()) + 1 if len(at) else 0
        c, spelled = np.zeros(size, np.int64), np.zeros(size)
        c[at], spelled[at] = scores.column("c").to_numpy(), scores.column("spelled").to_numpy()
        base = np.log10(c + SMOOTHING) - below
        rows = []
        for places, times in zip(texts.column("at"), texts.column("times"), strict=True):
            p, k = places.values.to_numpy(), times.values.to_numpy().astype(np.int64)
            rows.append((int(k[c[p] > 0].sum()) + (ends > 0), float(base[p] @ k) + end_base, float(spelled[p] @ k) + end_score))
        known, base_scores, whole = zip(*rows, strict=True) if rows else ((), (), ())
        tokens = pa.array(texts.column("n_words").to_numpy() + 1, pa.int64())
        columns = [
            texts.column(key), texts.column("held_out"), tokens, pa.array(known, pa.int64()), pa.array([n] * len(rows), pa.int64()),
            pa.array(base_scores, pa.float64()), pa.array(whole, pa.float64()),
        ]
        return pa.table(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(add, schema)
