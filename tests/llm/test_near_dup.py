from __future__ import annotations

import numpy as np
import pytest
import xxhash
from conftest_rows import rows_by

from wattsift.llm.near_dup import components, fingerprints, keep_one, near_duplicates, near_links, simhash, without_rows


def plain_simhash(text: str | None) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    value = sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("text", [None, "", "  ", "One", "one TWO", "a b c", "a b c a b c d", "É é Ü x\ty z", "q " * 5_000])
def test_simhash_is_the_majority_of_shingle_hashes(text):
    assert simhash(text) == plain_simhash(text)


def test_simhash_of_a_text_in_slices(monkeypatch):
    text = " ".join(f"w{i * i % 91}" for i in range(3_000))
    monkeypatch.setattr("wattsift.llm.words.cut_points.__defaults__", (frozenset(b" \t\n\x0b\x0c\r"), 100), raising=False)
    assert simhash(text) == plain_simhash(text)


def groups(values: list[int], budget: int) -> dict[int, int]:
    """Smallest value reachable, for values with a neighbour, by comparing all pairs."""
    root = {v: v for v in values}
    near = {v: [w for w in values if ((v ^ w) & (2**64 - 1)).bit_count() <= budget] for v in values}
    changed = True
    while changed:
        changed = False
        for v in values:
            least = min(root[w] for w in near[v])
            changed, root[v] = changed or least != root[v], least
    return {v: r for v, r in root.items() if len(near[v]) > 1}


@pytest.mark.parametrize(("budget", "node_rows"), [(3, 200_000), (3, 4), (1, 5), (0, 200_000)])
def test_trie_join_links_what_comparing_all_pairs_links(spark, rng, budget, node_rows):
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in values[:25]:
        for _ in range(6):
            values.append(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    values += [0, 1, 2**63, 2**64 - 1]
    signed = sorted({int(np.uint64(v).astype(np.int64)) for v in values})
    prints = spark.createDataFrame([(v,) for v in signed], "bits long").repartition(4)
    found = {r.node: r.root for r in components(near_links(prints, budget, node_rows)).collect()}
    assert found == groups(signed, budget)


def test_long_chains_and_stars_settle(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1_000, i) for i in range(2_000, 2_050)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 1_000 for i in (1_000, *range(2_000, 2_050)))


def test_edge_rows(edge_docs, no_docs):
    found = near_duplicates(edge_docs)
    rows = rows_by(found, "doc_id")
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert [r.component_id for r in rows[2]] == [1, 1]
    assert {rows[i][0].fingerprint for i in (3, 4, 5)} == {"0" * 16}
    assert {rows[i][0].component_id for i in (3, 4, 5)} == {3}
    assert len(rows[None]) == 1 and rows[None][0].component_id is None
    assert near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays_with_all_columns(edge_docs, no_docs):
    kept = keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 6, 7, 8, None, 9, 10], key=str)
    assert keep_one(no_docs).count() == 0


def test_one_row_stays_where_keys_are_repeated_or_missing(spark):
    a, b, c = ("the cat sat on a mat and slept", "seven other words stand in this line", "nothing like the rest of them here")
    rows = [(1, a, 1), (2, a, 2), (2, b, 3), (3, b, 4), (3, b, 4), (5, c, 5), (5, c, 6), (5, c, 7), (None, c, 8)]
    rows += [(None, "no key but three copies", 9)] * 3 + [(None, "no key and another text", 9), (2, None, 10), (2, None, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    kept = keep_one(docs)
    assert kept.schema == docs.schema
    found = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert found == sorted([(1, a), (2, b), (5, c), (0, "no key but three copies"), (0, "no key and another text"), (2, "")])
    assert {r.n for r in kept.where("doc_id = 5").collect()} == {r.n for r in keep_one(docs.coalesce(1)).where("doc_id = 5").collect()}


@pytest.mark.parametrize("filter_words", [1, 64, 1 << 20])
def test_rows_leave_whatever_the_filter_says(spark, filter_words):
    rows = [(i if i % 7 else None, bytes([i % 5]), f"text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "k long, d binary, t string").repartition(3)
    gone = spark.createDataFrame([(k, d) for k, d, _ in rows if k is None or k % 3 == 0], "a long, b binary").limit(90)
    found = sorted(r.t for r in without_rows(docs, gone, [("k", "a"), ("d", "b")], filter_words).collect())
    named = {(r.a, bytes(r.b)) for r in gone.collect()}
    assert found == sorted(t for k, d, t in rows if (k, d) not in named)
    assert without_rows(docs, gone.where("false"), [("k", "a"), ("d", "b")], filter_words).count() == len(rows)
    plan = without_rows(docs, gone, [("k", "a"), ("d", "b")], filter_words)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan


def test_fingerprints_do_not_depend_on_partitions(edge_docs):
    one, many = fingerprints(edge_docs.coalesce(1)), fingerprints(edge_docs.repartition(5))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
