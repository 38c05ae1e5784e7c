from __future__ import annotations

from collections import defaultdict


def rows_by(df, key: str) -> dict:
    found = defaultdict(list)
    for r in df.collect():
        found[r[key]].append(r)
    return found
