from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

from wattsift.llm.spelling import near_words, spelling_variants, word_counts

SF_DIR = "/root/testdata/sf0.001"


def plain_counts(rows, letters=7, least=2):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= least}


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    """By trying all deletions and replacements of a word by a gap."""
    gaps = {}
    for w in counts:
        for i in range(len(w)):
            gaps.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    found = {}
    for w, n in counts.items():
        near = set()
        for i in range(len(w)):
            near |= gaps[(w[:i], w[i + 1 :])]
            if w[:i] + w[i + 1 :] in counts:
                near.add(w[:i] + w[i + 1 :])
        for i in range(len(w) + 1):
            near |= gaps.get((w[:i], w[i:]), set())
        near.discard(w)
        best = min(near, key=lambda o: (-counts[o], o), default=None)
        form = best if best and counts[best] >= 10 * n else None
        found[w] = (form, n, len(near), counts[best] if form else None)
    root = {}
    for w in counts:
        r = w
        while found[r][0]:
            r = found[r][0]
        root[w] = r
    return {(w, f, root[w], n, near, fn) for w, (f, n, near, fn) in found.items()}


def as_set(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_whole_table_against_plain_steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = plain_counts([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.word: r.n for r in word_counts(docs).collect()} == counts
    found = spelling_variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_set(found) == plain_variants(counts) and found.count() == len(counts)


def test_pairs_of_short_words_against_all_pairs(spark, rng):
    words = sorted({"".join(rng.choice("abÀ") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(3)
    found = [(r.word, r.other) for r in near_words(rows).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_chains_lead_to_their_end(spark):
    texts = [(i, w) for i, w in enumerate(["abcdefg"] * 1000 + ["abcdefh"] * 100 + ["abcdeih"] * 10 + ["abcjeih"] * 1 + ["zyxwvut"] * 3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.word: (r.form, r.root) for r in spelling_variants(docs, least=1, every=10**9).collect()}
    # the crc32 of a pair is divisible by a thousand million at most a few times; those words are shorter
    assert found["abcjeih"] == ("abcdeih", "abcdefg") and found["abcdeih"] == ("abcdefh", "abcdefg")
    assert found["abcdefg"] == (None, "abcdefg") and found["zyxwvut"] == (None, "zyxwvut")


def test_edge_rows(spark, edge_docs, no_docs):
    assert spelling_variants(no_docs).count() == 0
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert as_set(spelling_variants(edge_docs)) == plain_variants(plain_counts(rows))
    long = "écriture×÷ " * 3 + "A" * 5_000_000 + " Écriture"
    docs = spark.createDataFrame([(1, long), (2, None), (None, "Straßenbahn straßenbahn STRASSENBAHN"), (None, None)], "doc_id long, text string")
    assert {r.word: r.n for r in word_counts(docs).collect()} == plain_counts([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("parts", [1, 7])
def test_partitions_do_not_matter(edge_docs, parts):
    assert as_set(spelling_variants(edge_docs.repartition(parts), least=1)) == as_set(spelling_variants(edge_docs, least=1))
