from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_rows import rows_by
from tokenizers import Tokenizer

from wattsift.llm import packing
from wattsift.llm.packing import WordTokens, default_tokenizer, pack, pack_documents, packing_plan, pieces

ODD_TEXTS = [
    "", "  ", "Ünïcödé ΣΑΣ İstanbul", "can't we'RE they'll 'S 's", "<|startoftext|>hi <|EndOfText|> <|endoftext|>,", "123 4,5.6 ... ,, a., b,.",
    "日本語 テキスト。 ，", "́ x", "ﬁ ﬁn", "a‍b", "É È À, Ñ.", "q \x1c\x1d r", "áb é",
]


def test_word_by_word_ids_are_the_tokenizers(rng):
    words, whole = WordTokens(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    marks = [32, 10, 44, 46, 0x85, 0xA0, 0x2028, 0x301]
    noise = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x250), rng.choice(marks)])) for _ in range(50)) for _ in range(400)]
    for text in ODD_TEXTS + noise:
        assert np.frombuffer(words.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_forgotten_words_are_learnt_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    words = WordTokens(default_tokenizer())
    first = words.ids("one two three four five six")
    words.ids("seven eight nine ten")
    assert words.ids("one two three four five six") == first


def first_fit(counts: dict[int, int], capacity: int) -> int:
    free: list[int] = []
    for size in sorted(Counter(counts).elements(), reverse=True):
        for i, f in enumerate(free):
            if f >= size:
                free[i] -= size
                break
        else:
            free.append(capacity - size)
    return len(free)


@pytest.mark.parametrize("capacity", [10, 64, 500])
def test_plan_places_every_piece_once_without_gaps(rng, capacity):
    for _ in range(6):
        counts = Counter(rng.choice([rng.randint(1, capacity), rng.randint(1, max(1, capacity // 6)), capacity]) for _ in range(400))
        plan = packing_plan(dict(counts), capacity)
        spans, ranks = {}, Counter()
        for length, rank, n, sequence, offset in plan:
            ranks[length] += n
            for k in range(n):
                spans.setdefault(sequence + k, []).append((offset, length))
        assert ranks == counts
        for length in counts:
            covered = sorted(r for s, first, n, _, _ in plan if s == length for r in range(first, first + n))
            assert covered == list(range(counts[length]))
        for parts in spans.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(spans) <= first_fit(counts, capacity) * 1.03 + 1
        assert len(spans) >= -(-sum(k * v for k, v in counts.items()) // capacity)


def test_plan_size_does_not_follow_the_counts():
    few = {n: 7 + n % 5 for n in range(1, 300)}
    assert len(packing_plan({k: v * 10**9 for k, v in few.items()}, 300)) < 10 * len(packing_plan(few, 300))


def test_plan_edges():
    assert packing_plan({}, 16) == []
    assert packing_plan({16: 3}, 16) == [(16, 0, 3, 0, 0)]
    assert len({p[3] for p in packing_plan({1: 1}, 16)}) == 1
    with pytest.raises(ValueError):
        packing_plan({17: 1}, 16)


def test_edge_rows(edge_docs, no_docs):
    limit = 64
    found = pack_documents(edge_docs, limit=limit, with_ids=True).toPandas()
    whole = Tokenizer.from_file(default_tokenizer())
    wanted = Counter()
    for row in edge_docs.collect():
        ids = np.array([*whole.encode(row.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, low in enumerate(range(0, len(ids), limit)):
            part = ids[low : low + limit]
            wanted[(row.doc_id, k, low, len(part), zlib.crc32(part.tobytes()))] += 1
    key = [None if x != x else int(x) for x in found["doc_id"]]
    assert Counter(zip(key, found["piece"], found["start"], found["length"], found["ids_crc32"], strict=True)) == wanted
    assert all(zlib.crc32(i) == c for i, c in zip(found["ids"], found["ids_crc32"], strict=True))
    for _, part in found.sort_values("offset").groupby("sequence_id"):
        assert (part["offset"] == part["length"].cumsum() - part["length"]).all() and part["length"].sum() <= limit
    assert pack_documents(no_docs).count() == 0


def test_ranks_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 50)
    rows = [(i % 7, 0, 3 if i % 3 else 1 + i % 9, i % 5) for i in range(900)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids_crc32 long").cache()
    found = pack(cut, 10).toPandas()
    assert len(found) == 900 and not found.duplicated(["sequence_id", "offset"]).any()
    for _, part in found.sort_values("offset").groupby("sequence_id"):
        assert (part["offset"] == part["length"].cumsum() - part["length"]).all() and part["length"].sum() <= 10


def test_pieces_keep_their_columns(edge_docs):
    assert pieces(edge_docs).columns == ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert {k: len(v) for k, v in rows_by(pieces(edge_docs), "doc_id").items()}[3] == 1
