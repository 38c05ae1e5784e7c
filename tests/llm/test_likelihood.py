from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
from conftest_rows import rows_by
from pyspark.sql import functions as F

from wattsift.llm import likelihood
from wattsift.llm.language import fold
from wattsift.llm.likelihood import PieceLattice, default_vocabulary, score_texts


def spellings(lattice: PieceLattice, text: str) -> float:
    """Sum of the probabilities of all spellings, by trying every one."""
    if not text:
        return 1.0
    total = 0.0
    for n in range(1, min(len(text), lattice.longest) + 1):
        if (p := lattice.pieces.get(text[:n])) is not None:
            total += math.exp(p) * spellings(lattice, text[n:])
    if text[0] not in lattice.pieces:
        total += math.exp(sum(lattice.bytes[b] for b in text[0].encode())) * spellings(lattice, text[1:])
    return total


def test_forward_recursion_sums_all_spellings():
    lattice = PieceLattice(default_vocabulary(), {300: 50, 262: 10}, 3)
    for word in ("the", "hello", "naïve", "日本", "🎉x", "a", "zzqzz"):
        assert math.isclose(lattice.word(word.encode()), math.log(spellings(lattice, "▁" + word)), rel_tol=1e-9)


def test_pieces_are_a_distribution():
    lattice = PieceLattice(default_vocabulary(), {300: 50, 5000: 7}, 3)
    total = sum(map(math.exp, lattice.pieces.values())) + sum(map(math.exp, lattice.bytes.values())) + math.exp(lattice.end)
    assert math.isclose(total, 1.0, rel_tol=1e-6)


def plain(rows: list[tuple], held) -> list[tuple]:
    tokens = [(k, (t or "").encode().lower().split()) for k, t in rows]
    train = [w for k, w in tokens if not held(k)]
    counts = Counter(x for w in train for x in w)
    n, v, ends = sum(counts.values()) + len(train), len(counts) + bool(train), len(train)
    below = math.log10(n + 0.1 * (v + 1))
    out = []
    for k, w in tokens:
        base = sum(math.log10(counts[x] + 0.1) - below for x in w) + math.log10(ends + 0.1) - below
        out.append((k, held(k), len(w) + 1, sum(counts[x] > 0 for x in w) + bool(ends), n, base))
    return out


def same(found, wanted):
    assert len(found) == len(wanted)
    key = lambda r: (str(r[0]), r[2], r[5])
    for a, b in zip(sorted(found, key=key), sorted(wanted, key=key), strict=True):
        assert tuple(a[:5]) == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-12)


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_edge_rows(edge_docs, no_docs, block_words):
    held = lambda k: k is None or zlib.crc32(str(k).encode()) % 10 == 0
    found = score_texts(edge_docs, fold(F.col("doc_id"), 10) == 0, block_words=block_words)
    same([tuple(r) for r in found.collect()], plain([(r.doc_id, r.text) for r in edge_docs.collect()], held))
    assert score_texts(no_docs, F.lit(False)).count() == 0


def test_blocks_do_not_change_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = rows_by(score_texts(docs, F.lit(False)), "doc_id")
    many = rows_by(score_texts(docs.repartition(3), F.lit(False), block_words=500), "doc_id")
    for k, (r,) in one.items():
        assert r[:5] == many[k][0][:5] and math.isclose(r.score, many[k][0].score, rel_tol=1e-9)


def test_no_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in score_texts(docs, F.lit(True)).collect()}
    assert (rows[1].n_tokens, rows[1].n_known, rows[1].train_tokens) == (3, 0, 0) and math.isfinite(rows[1].score)


def test_trained_pieces_tell_likely_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = docs.limit(0).union(spark.createDataFrame([(-7, "Xq jzv wkq pzzx qxv " * 20, "en", "s", 400)], docs.schema))
    rows = score_texts(docs.unionByName(odd), F.col("doc_id") < 0).collect()
    per_word = {r.doc_id: r.score / r.n_tokens for r in rows}
    ordinary = sorted(v for k, v in per_word.items() if k >= 0)
    assert per_word[-7] < ordinary[len(ordinary) // 10]


def test_whole_table_against_plain(spark):
    from __spark_entry__ import queries

    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = [tuple(r) for r in queries()["op9_likelihood"](spark, "/root/testdata/sf0.001").collect()]
    same(found, plain(docs, lambda k: zlib.crc32(str(k).encode()) % 10 == 0))


def test_words_are_numbered_as_they_come():
    numbers = likelihood._Numbers()
    assert [numbers[w] for w in (b"a", b"b", b"a", b"c")] == [0, 1, 0, 2]
