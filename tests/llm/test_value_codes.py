from __future__ import annotations

import hashlib

import numpy as np
import pytest

from wattsift.llm.value_codes import Block, books_digest, integer_vectors, product_codes, value_blocks

SF_DIR = "/root/testdata/sf0.001"


def plain_codes(rows, entries=256, rounds=4, parts=4):
    """rows: (key, vector of floats, label), all kept; keys are distinct."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    v = np.array([[int(np.floor(x * 1024)) for x in r[1]] for r in rows], object)
    w = v.shape[1] // parts
    cut = [v[:, p * w : (p + 1) * w] for p in range(parts)]
    books = [c[:entries].copy() for c in cut]

    def assign(p):
        d = ((cut[p][:, None] - books[p][None]) ** 2).sum(2)
        at = np.array([min(range(len(books[p])), key=lambda e: (row[e], e)) for row in d])
        return at, d[np.arange(len(d)), at]

    for _ in range(rounds):
        for p in range(parts):
            at, _ = assign(p)
            for e in range(len(books[p])):
                mine = cut[p][at == e]
                if len(mine):
                    books[p][e] = [sum(c) // len(mine) for c in mine.T]
    found = [assign(p) for p in range(parts)]
    errors = sum(f[1] for f in found)
    totals = {}
    for r, e in zip(rows, errors, strict=True):
        totals[r[2]] = totals.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    return {(r[0], "".join(f"{f[0][i]:02x}" for f in found), int(errors[i]), int(totals[r[2]])) for i, r in enumerate(rows)}, digest


def as_set(df, key="vec_id"):
    return {(r[key], r.code, r.error, r.label_error) for r in df.collect()}


def test_whole_table_against_plain_steps(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    want, digest = plain_codes([(r.vec_id, r.embedding, r.label) for r in table.collect()])
    coded, books = product_codes(table.repartition(5))
    assert as_set(coded) == want and books_digest(books) == digest


def test_hot_labels_nulls_and_few_entries(spark, rng):
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], None if i % 3 == 0 else 7 if i % 3 == 1 else i) for i in range(300)]
    rows = [(i, rows[i % 5][1] if i % 4 == 0 else v, label) for i, v, label in rows]  # many equal vectors
    bad = [(500, None, 1), (501, [0.0] * 7 + [None], 1), (502, [float("nan")] + [0.0] * 7, 1), (503, [float("inf")] * 8, 1)]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows + bad], "vec_id long, embedding array<double>, label long, k string, code string, error string")
    want, digest = plain_codes(rows, entries=17)
    coded, books = product_codes(table, entries=17)
    assert coded.columns == ["vec_id", "code", "error", "label_error"]
    assert as_set(coded) == want and books_digest(books) == digest


def test_fewer_vectors_than_entries_and_null_or_repeated_keys(spark):
    rows = [(1, [0.5, -0.25, 1.0, 2.0], 1), (1, [0.5, -0.25, 1.0, 2.0], 1), (None, [9.0, 9.0, 9.0, 9.0], None)]
    coded, books = product_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert books.shape == (4, 3, 1) and books[0].ravel().tolist() == [512, 512, 9216]
    assert sorted(map(str, as_set(coded))) == sorted(map(str, {(1, "00000000", 0, 0), (None, "02020202", 0, 0)})) and coded.count() == 3
    none, books = product_codes(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert none.count() == 0 and books.size == 0
    assert product_codes(spark.createDataFrame([(1, [], 2)], "vec_id long, embedding array<float>, label int"))[0].first().code == "00000000"


@pytest.mark.parametrize("rows", [[(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)], [(1, [0.0] * 5, 1)]])
def test_lengths_that_do_not_fit_raise(spark, rows):
    with pytest.raises(Exception, match="length|components"):
        product_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))[0].collect()


def test_blocks_give_back_the_integers(spark):
    table = spark.createDataFrame([(i, [i / 7, -i * 3.1, 0.0, 5e4]) for i in range(50)], "vec_id long, embedding array<double>").selectExpr("*", "1 label")
    rows = integer_vectors(table)
    want = {tuple(r.v) for r in rows.collect()}
    found = set()
    for r in value_blocks(rows, 4).collect():
        block = Block(r.dictionary, r.ends, r.codes, r.n)
        found |= set(zip(*[block.values[d][block.codes[d]].tolist() for d in range(4)], strict=True))
        entry, error = block.assign(np.array([[0, 0], [1, 1]]), 1)
        assert (entry == 1).all() and (error == 1 + (5e4 * 1024 - 1) ** 2).all()
    assert found == want
