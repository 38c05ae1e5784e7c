from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_rows import rows_by
from pyspark.sql import functions as F

from wattsift.llm import language
from wattsift.llm.language import _clusters, fit_languages, fold, keep_known, ngram_counts, predict_languages


def plain_ngrams(text: str) -> int:
    """How many n-grams of one to three characters have a letter where one has to be."""
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    ones = sum(c != " " for c in line)
    twos = sum(line[i] != " " or line[i + 1] != " " for i in range(len(line) - 1))
    threes = sum(line[i + 1] != " " for i in range(len(line) - 2))
    return ones + twos + threes


def test_ngram_counts_do_not_depend_on_parts(monkeypatch):
    text = "Été 12 über! x  y\nzz " * 30
    whole = ngram_counts(text)
    assert whole[1].sum() == plain_ngrams(text)
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(language, "PART", size)
        part = ngram_counts(text)
        assert np.array_equal(part[0], whole[0]) and np.array_equal(part[1], whole[1])


def test_texts_without_letters_have_no_vector():
    assert all(ngram_counts(t) is None for t in (None, "", "  ", "123 !?", "\n"))
    assert ngram_counts("日") is not None


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from __spark_entry__ import queries

    rows = queries()["op8_language"](spark, "/root/testdata/sf0.01")
    both = rows.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(both) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in both)
    held = [r for r in both if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in both) and np.mean([r.rejected for r in both]) < 0.002


def test_only_the_text_decides(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit_languages(docs)
    one = rows_by(predict_languages(docs, model), "doc_id")
    other = rows_by(predict_languages(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model), "doc_id")
    assert one == other


@pytest.mark.parametrize("doc_id", [None, 7])
def test_the_sample_is_bounded_and_not_empty_whatever_the_keys(spark, monkeypatch, doc_id):
    seen = []
    monkeypatch.setattr("wattsift.llm.language._clusters", lambda vectors, k: seen.append(len(vectors)) or _clusters(vectors, k))
    texts = [(doc_id, f"text number {i} of {lang} " + chr(97 + i % 26) * 9, lang) for lang in ("en", "fr") for i in range(500)]
    texts += [(doc_id, "the same text again and again", "de")] * 400
    fit_languages(spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3), fit_rows=90)
    assert seen == [1, 30, 30]


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(1, "жыщ эюя фъх цчш " * 40), (2, "漢字仮名交文章例題 " * 40)], "doc_id long, text string")
    assert all(r.rejected for r in predict_languages(odd, fit_languages(docs)).collect())


def plain_vector(text: str, weight: dict[int, float] | None) -> dict[int, float]:
    """Counts of hashed n-grams, or with weights the TF-IDF vector of length one; all steps one by one."""
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    counts: Counter = Counter()
    for end in range(len(line)):
        for n in (1, 2, 3):
            gram = line[max(0, end - n + 1) : end + 1]
            if len(gram) < n or (gram[1] if n == 3 else gram).isspace():
                continue
            mixed = n
            for c, factor in zip(reversed(gram), (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=False):
                mixed = (mixed + ord(c) * factor) % 2**32
            counts[(mixed ^ (mixed >> 15)) * 0x85EBCA77 % 2**32 >> (32 - language.DIMENSION_BITS)] += 1
    if weight is None:
        return dict(counts)
    values = {p: (1 + math.log(c)) * weight[p] for p, c in counts.items()}
    norm = math.sqrt(sum(v * v for v in values.values()))
    return {p: v / norm for p, v in values.items()}


@pytest.mark.parametrize("postings", [1 << 20, 5])
def test_predictions_against_plain_steps(spark, monkeypatch, postings):
    """With one centroid each: the unit mean of a language's vectors, and the nearest by cosine."""
    monkeypatch.setattr(language, "POSTINGS", postings)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 4000")
    known = [r for r in docs.where("lang is not null and text is not null").collect() if ngram_counts(r.text) is not None]
    texts = [plain_vector(t, None) for t in {(r.doc_id, r.text): r.text for r in known}.values()]
    seen = Counter(p for t in texts for p in t)
    weight = defaultdict(lambda: math.log(1 + len(texts)) + 1, {p: math.log((1 + len(texts)) / (1 + n)) + 1 for p, n in seen.items()})
    sums: dict[str, Counter] = defaultdict(Counter)
    for r in known:
        for p, v in plain_vector(r.text, weight).items():
            sums[r.lang][p] += v
    norms = {lang: math.sqrt(sum(v * v for v in total.values())) for lang, total in sums.items()}
    model = fit_languages(docs, fit_rows=10**6, centroids=1)
    found = rows_by(predict_languages(docs, model), "doc_id")
    assert len(known) > 100 and len(sums) > 2
    for r in known[:: 1 if postings > 5 else 10]:
        vector = plain_vector(r.text, weight)
        cosines = {lang: sum(v * total[p] for p, v in vector.items()) / norms[lang] for lang, total in sums.items()}
        best = max(cosines, key=cosines.get)
        assert found[r.doc_id][0].lang_pred == best
        assert found[r.doc_id][0].score == pytest.approx(min(cosines[best], 1.0), abs=1e-5)


def test_two_clusters_are_found():
    rng = np.random.default_rng(3)
    heads = np.eye(6)[[0, 1]]
    vectors = np.repeat(heads, 30, axis=0) + rng.normal(0, 0.05, (60, 6))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centres = _clusters(vectors, 2)
    closest = np.argmax(vectors @ centres.T, axis=1)
    assert len(set(closest[:30])) == len(set(closest[30:])) == 1 and closest[0] != closest[30]
    for c, centre in enumerate(centres):
        mean = vectors[closest == c].mean(0)
        assert np.allclose(centre, mean / np.linalg.norm(mean))


def test_two_thousand_languages(spark):
    letters = lambda i: "".join(chr(0x4E00 + (i * 7 + j * 2003) % 20_000) for j in range(4))
    rows = [(i, f"{letters(i)} {letters(i)}", f"l{i}") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = fit_languages(docs)
    assert len(model.languages) == 2_000 and model.share.nbytes + model.member.nbytes < 2_000_000
    found = predict_languages(docs, model).join(docs, "doc_id")
    assert found.where("lang_pred = lang").count() >= 1_990
    with pytest.raises(ValueError, match="more than 1999 languages"):
        fit_languages(docs, max_languages=1_999)


def test_edge_rows(edge_docs, no_docs):
    model = fit_languages(edge_docs)
    rows = rows_by(predict_languages(edge_docs, model), "doc_id")
    assert sum(map(len, rows.values())) == edge_docs.count()
    for key in (3, 4, 5, 7):
        assert (rows[key][0].lang_pred, rows[key][0].score, rows[key][0].rejected) == ("und", 0.0, True)
    kept = keep_known(edge_docs, model)
    assert kept.schema == edge_docs.schema and {r.doc_id for r in kept.collect()} == {1, 2, 6, 8, 9, 10, None}
    empty = fit_languages(no_docs)
    assert {r.lang_pred for r in predict_languages(edge_docs, empty).collect()} == {"und"}
    assert predict_languages(no_docs, model).count() == 0
    assert edge_docs.where("doc_id is null").select(fold(F.col("doc_id"), 5).alias("f")).first().f == 0
