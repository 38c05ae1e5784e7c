from __future__ import annotations

import random

import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(120_000))
EDGE_ROWS = [
    (1, "Alpha beta gamma. Delta epsilon zeta.\n\nEta theta.", "en"),
    (2, "Alpha beta gamma. Delta epsilon zeta.\n\nEta theta.", "en"),
    (2, "Alpha beta gamma. Delta epsilon zeta.\n\nEta theta.", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n ", "fr"),
    (6, "ÉTÉ à la plage, 日本語のテキスト 🎉", "fr"),
    (7, "1234 !!! ???", "de"),
    (8, LONG, "en"),
    (None, "No key at all, but a text.", "en"),
    (9, "x" * 5_000, "en"),
    (10, "word", None),
]
#: Columns of these names are used inside operators; a table may have them too.
CLASHING = ("bits", "block", "words", "c", "t", "_gone", "fingerprint", "component_id", "length", "_bucket", "range", "print", "start", "lang_pred", "score", "_edges")


@pytest.fixture(scope="session")
def edge_docs(spark):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(*r, *["clash"] * len(CLASHING)) for r in EDGE_ROWS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture
def rng():
    return random.Random(7)
