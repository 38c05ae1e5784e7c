from __future__ import annotations

import hashlib

import pytest
from conftest_rows import rows_by
from pyspark.sql import functions as F

from wattsift.llm.merkle import edit_fingerprints, edited_places, fingerprint_texts, likeness, tree, with_next


def plain_tree(text: str | None) -> str:
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    nodes = [[[sha(x)[:16] for x in p.split(". ")] for p in s.split("\n")] for s in (text or "").split("\n\n")]
    root = sha("|".join(sha("/".join(sha(".".join(p)) for p in s)) for s in nodes))
    return root + ":" + "|".join("/".join(".".join(p) for p in s) for s in nodes)


def plain_likeness(a: str, b: str) -> float:
    x, y = (set(f[65:].replace("/", ".").replace("|", ".").split(".")) for f in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def test_edge_rows(edge_docs, no_docs):
    rows = rows_by(fingerprint_texts(edge_docs), "doc_id")
    for d in edge_docs.collect():
        assert rows[d.doc_id][0].fingerprint == plain_tree(d.text)
    assert rows[1][0].fingerprint == rows[2][0].fingerprint == rows[2][1].fingerprint
    assert edit_fingerprints(no_docs).count() == 0


@pytest.mark.parametrize("range_bytes", [32 << 20, 100])
def test_next_texts(spark, edge_docs, range_bytes):
    docs = [(r.doc_id, r.text or "") for r in edge_docs.where("doc_id <> 2 or doc_id is null").collect()]
    docs.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    rows = edge_docs.where("doc_id <> 2 or doc_id is null").select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows_by(with_next(rows, "key", ["text"], F.octet_length("text"), range_bytes), "key")
    assert {k: v[0].next_text for k, v in found.items()} == {k: docs[(i + 1) % len(docs)][1] for i, (k, _) in enumerate(docs)}


def test_edits_over_many_ranges(spark, rng):
    docs = [(i * i % 1_009, "".join(rng.choice(["ab. ", "é", "\n", "日本. ", "x"]) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    docs = sorted(dict(docs).items())
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = rows_by(edit_fingerprints(frame), "doc_id")
    for i, (key, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = rows[key][0]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (plain_tree(text), plain_tree(edited))
        assert row.near_edited == plain_likeness(plain_tree(text), plain_tree(edited))
        assert row.near_next == plain_likeness(plain_tree(text), plain_tree(after))


def test_an_only_document_is_its_own_next(spark):
    row = edit_fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0


def test_repeated_keys_keep_their_rows(edge_docs):
    assert edit_fingerprints(edge_docs).count() == edge_docs.count()


def test_differing_branches_locate_edits(spark):
    pairs = [
        ("a\nb\n\nc. d\ne", "a\nb\n\nc. X\ne", [(1, 0)]), ("a", "a", []), ("a\n\nb", "a", [(1, 0)]), (None, "x", [(0, 0)]), ("a\nb", "a\nb\nc", [(0, 2)]),
    ]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
    rows = frame.select("i", edited_places(tree(F.col("a")), tree(F.col("b"))).alias("p")).collect()
    assert {r.i: [tuple(x) for x in r.p] for r in rows} == {i: p for i, (_, _, p) in enumerate(pairs)}


def test_no_python_in_the_plan(edge_docs, capsys):
    edit_fingerprints(edge_docs).select("near_edited").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "SinglePartition" not in plan


def test_likeness_is_one_for_equal_and_none_for_unlike(spark):
    frame = fingerprint_texts(spark.createDataFrame([(1, "a. b"), (2, "a. b"), (3, "z")], "doc_id long, text string"))
    both = frame.alias("x").join(frame.alias("y"), F.col("x.doc_id") < F.col("y.doc_id"))
    found = both.select(F.col("x.doc_id").alias("i"), F.col("y.doc_id").alias("j"), likeness(F.col("x.fingerprint"), F.col("y.fingerprint")).alias("l"))
    assert {(r.i, r.j): r.l for r in found.collect()} == {(1, 2): 1.0, (1, 3): 0.0, (2, 3): 0.0}
