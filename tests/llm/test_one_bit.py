from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from wattsift.llm.one_bit import inner, nearest_by_codes, rotation


def search(table, **settings):
    return nearest_by_codes(table, F.col("id") % 20 == 0, **settings)


def plain_nearest(rows, k=20, every=20):
    """rows: (key, vector); the lists of all queries, by key and score."""
    out = []
    for i, (q, v) in enumerate(rows):
        if q is None or q % every:
            continue
        scored = []
        for j, (key, w) in enumerate(rows):
            if j != i:
                total = 0.0
                for a, b in zip(v, w, strict=True):
                    total += float(a) * float(b)
                scored.append((-total, key is None, key or 0, key))
        out += [(q, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scored)[:k])]
    return sorted(map(str, out))


def shown(df):
    return sorted(str((r.query_id, r.rank, r.vec_id, r.score)) for r in df.collect())


def test_recall_and_scores_on_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, found = plain_nearest(rows), search(table, first_rows=300)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    pick = lambda lines: {tuple(line.split(", ")[i] for i in (0, 2, 3)) for line in lines}
    assert len(pick(want) & pick(shown(found))) >= 0.995 * len(want)
    assert shown(search(table, sigmas=8.0)) == want


def test_copies_ties_and_repeated_or_missing_keys(spark, rng):
    base = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(40)]
    rows = [(i, base[0] if i < 150 else base[i % 40]) for i in range(400)]
    rows += [(20, base[3]), (20, base[3]), (None, base[0]), (None, base[7])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert shown(search(table, sigmas=8.0)) == plain_nearest(rows)
    small = search(table, sigmas=8.0, first_rows=50, block_bytes=4_000)  # many blocks and rounds
    assert shown(small) == plain_nearest(rows)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [2.0, 1.0, 0.0]), (20, [-1.0, 0.5, 0.0]), (2, None), (3, [0.0, 0.0, 0.0])]
    rows += [(4, [None, 1.0, 1.0]), (5, [float("nan"), 1.0, 1.0]), (40, [float("inf"), 1.0, 1.0])]
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, uid int, id int, score int")
    assert shown(search(table)) == plain_nearest(rows[:3])
    assert search(table.where("vec_id = 0")).count() == 0
    assert search(table.where("vec_id = 1")).count() == 0
    assert search(table.where("false")).count() == 0


def test_rotation_keeps_lengths_and_sums_do_not_depend_on_place():
    turn = rotation(10, 40, 3)
    assert np.allclose(turn.T @ turn, np.eye(10))
    a = np.random.default_rng(0).standard_normal((64, 33))
    every = np.arange(33)
    assert all(inner(a, every, a, every)[n] == inner(a, np.array([n]), a, np.array([n]))[0] for n in (0, 5, 32))
