from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_decontaminate import plain
from test_near_dup import plain_simhash
from wattsift.llm.packing import default_tokenizer
from wattsift.llm.secrets import redact

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_every_stage_but_the_last_returns_documents(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == documents.columns, name
        docs = after.cache()
        assert 0 < docs.count() <= documents.count()


def test_pipeline_against_plain_steps(spark, documents):
    kept = {r.doc_id: r.text for r in corpus_pipeline.known_language(spark, documents, SF_DIR).collect()}
    assert len(kept) == documents.count()  # all are clean prose
    prints = {k: plain_simhash(t) & (2**64 - 1) for k, t in kept.items()}
    root = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            least = min(root[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3)
            changed, root[a] = changed or least != root[a], least
    kept = {k: t for k, t in kept.items() if root[k] == k}
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = plain(kept.values(), items, 13)
    kept = {k: redact(t) for (k, t), (n, hit, _) in zip(kept.items(), found, strict=True) if not (hit and 20 * hit >= n)}
    whole, wanted = Tokenizer.from_file(default_tokenizer()), Counter()
    for k, t in kept.items():
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for n, low in enumerate(range(0, len(ids), 2048)):
            wanted[(k, n, low, len(ids[low : low + 2048]), zlib.crc32(ids[low : low + 2048].tobytes()))] += 1
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted


def test_stages_take_empty_tables(spark, documents):
    docs = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0
