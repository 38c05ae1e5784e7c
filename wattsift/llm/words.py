"""Words of a text as bytes, a slice at a time, so that a very long text never becomes one huge list."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

SLICE = 1 << 22
SPACE = b" \t\n\x0b\x0c\r"


def cut_points(data: bytes, separators: frozenset[int] = frozenset(SPACE), size: int = SLICE) -> Iterator[bytes]:
    """Consecutive slices of about ``size`` bytes that end before a separator (longer where there is none)."""
    start, n = 0, len(data)
    while n - start > size:
        stop = start + size
        while stop < n and data[stop] not in separators:
            stop += 1
        yield data[start:stop]
        start = stop
    yield data[start:] if start else data


def spaced_words(text: str | None) -> Iterator[list[bytes]]:
    """Lists of the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; null has none."""
    if text:
        for part in cut_points(text.encode("utf-8", "surrogatepass").lower()):
            yield part.split()


def text_rows(batch: pa.RecordBatch, key: str, text: str) -> Iterator[tuple]:
    """(key, text) of each row without turning the whole batch into Python objects at once."""
    for k, t in zip(batch.column(key), batch.column(text), strict=True):
        yield k.as_py(), t.as_py()


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
