from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from conftest_rows import rows_by

from wattsift.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).add(item)
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if owners := windows.get(tuple(w[p : p + k])):
                    hit |= set(range(p, p + k))
                    found |= owners
        out.append((len(w), len(hit), sorted(found)))
    return out


def longest(text, items, window):
    w, best = words(text), 0
    for _, other in items:
        v = words(other)
        for a in range(len(w)):
            for b in range(len(v)):
                k = 0
                while a + k < len(w) and b + k < len(v) and w[a + k] == v[b + k]:
                    k += 1
                best = max(best, k) if k >= min(window, len(v)) else best
    return best


def made(rng):
    vocabulary = [f"w{i}" for i in range(rng.choice([2, 3, 8, 40]))] + ["É", "日"]
    items = [(str(i), None if rng.random() < 0.05 else " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 4, 5, 9, 20])))) for i in range(6)]
    docs = [None if rng.random() < 0.05 else ", ".join(rng.choices([*vocabulary, "zz"], k=rng.choice([0, 1, 2, 10, 40]))) for _ in range(8)]
    return [d if d is None or rng.random() < 0.6 else f"{d} x {rng.choice(items)[1] or ''} {d}" for d in docs], items


def test_shards_find_what_comparing_all_windows_finds(rng):
    for _ in range(120):
        docs, items = made(rng)
        window = rng.choice([3, 4, 5, 13])
        tests = dc.TestSet(items, window)
        numbers = [np.concatenate(p) if (p := tests.numbers(t)) else np.zeros(0, np.int64) for t in docs]
        found = dc.scan_shard(numbers, tests)
        assert [(f["n_words"], sum(b - a for a, b in f["hits"]), f["items"]) for f in found] == plain(docs, items, window)
        assert [(f["longest"] or {"words": 0})["words"] for f in found] == [longest(t, items, window) for t in docs]


def test_suffix_array_is_sorted(rng):
    flat = np.array([rng.choice([0, 1, 1, 2, 3]) for _ in range(400)] + [0] * 60, np.int64)
    starts = np.flatnonzero(flat)
    array = dc.suffix_array(dc._packed(flat), starts, 40)
    upto = lambda p: flat[p : p + int(np.flatnonzero(flat[p:] == 0)[0])].tolist()[:40]
    assert sorted(array.tolist()) == starts.tolist()
    assert [upto(p) for p in array] == sorted(upto(p) for p in starts)


ITEMS = [(1, "Alpha, beta GAMMA delta epsilon zeta."), (2, "eta theta"), (2, "eta theta"), (3, None), (4, ""), (None, "no key at all"), (10, "eta theta alpha")]


@pytest.mark.parametrize(("shard_words", "block_bytes"), [(2_000_000, 1 << 24), (5, 1 << 24), (2_000_000, 20), (3, 15)])
def test_edge_rows(spark, edge_docs, no_docs, shard_words, block_bytes):
    benchmark = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, n_words string")
    options = {"window": 4, "shard_words": shard_words, "block_bytes": block_bytes}
    rows = rows_by(dc.benchmark_matches(edge_docs, benchmark, **options), "doc_id")
    docs = edge_docs.collect()
    items = [("" if i is None else str(i), t) for i, t in ITEMS]
    wanted = plain([d.text for d in docs], items, 4)
    for d, (n_words, n_hit, found) in zip(docs, wanted, strict=True):
        row = rows[d.doc_id].pop()
        assert (row.n_words, sum(h.end - h.start for h in row.hits), list(row["items"])) == (n_words, n_hit, found)
    assert not any(rows.values())
    kept = dc.remove_contaminated(edge_docs, benchmark, **options)
    clean = [d for d, (n, hit, _) in zip(docs, wanted, strict=True) if not (hit and 20 * hit >= n)]
    assert kept.columns == edge_docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, clean))
    assert dc.benchmark_matches(no_docs, benchmark, **options).count() == 0


@pytest.mark.parametrize("item_id", [None, 5])
def test_blocks_bound_a_hot_item_and_are_built_one_by_one(spark, edge_docs, monkeypatch, item_id):
    events, build, write = [], dc.TestSet.__init__, dc.materialise
    monkeypatch.setattr(dc.TestSet, "__init__", lambda self, items, window: events.append(sum(len(t or "") for _, t in items)) or build(self, items, window))
    monkeypatch.setattr(dc, "materialise", lambda df, label: events.append(label) or write(df, label))
    items = [(item_id, f"filler {i} of one hot item") for i in range(200)] + [(item_id, "eta theta"), (item_id, "alpha beta gamma delta")] + [(item_id, "the same row")] * 500
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    wanted = plain([d.text for d in edge_docs.collect()], [("" if i is None else str(i), t) for i, t in items], 4)
    clean = [d for d, (n, hit, _) in zip(edge_docs.collect(), wanted, strict=True) if not (hit and 20 * hit >= n)]
    assert len(clean) < edge_docs.count()
    kept = dc.remove_contaminated(edge_docs, benchmark, window=4, block_bytes=1_500)
    sizes = events[1::2]
    assert events[0] == "test-set" and events[2::2] == ["block-hits"] * len(sizes) and len(sizes) > 2 and max(sizes) < 3_000
    assert kept.columns == edge_docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, clean))
    found = rows_by(dc.benchmark_matches(edge_docs, benchmark, window=4, block_bytes=1_500), "doc_id")
    for d, (n_words, n_hit, names) in zip(edge_docs.collect(), wanted, strict=True):
        row = found[d.doc_id].pop()
        assert (row.n_words, sum(h.end - h.start for h in row.hits), list(row["items"])) == (n_words, n_hit, names)


def test_no_benchmark_hits_nothing(spark, edge_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.hits and r.longest is None for r in dc.benchmark_matches(edge_docs, none).collect())
    assert dc.remove_contaminated(edge_docs, none).count() == edge_docs.count()


def test_whole_table_against_plain(spark):
    from __spark_entry__ import queries

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = rows_by(queries()["op10_decontaminate"](spark, sf_dir), "doc_id")
    for d, (n_words, n_hit, found) in zip(docs, plain([d.text for d in docs], items, 13), strict=True):
        row = rows[d.doc_id][0]
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n_words, n_hit, len(found), digest)
        assert row.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
