"""Rows that several tests share."""

from __future__ import annotations

from wattsift.profile import ENERGY


def clean_rows(count: int = 20) -> list[dict]:
    """One context, all rows of one occupation class, both compositions valid."""
    rows = []
    for i in range(count):
        row = {c: 0.0 for c in ENERGY.splits + ENERGY.shares}
        row |= {
            "source_row_id": i,
            ENERGY.context[0]: "office",
            ENERGY.context[1]: "admin",
            ENERGY.occupation: "1A",
            ENERGY.year: "2022",
            ENERGY.ratios[0]: 100.0 + i,
            ENERGY.ratios[1]: 90.0 + i,
            ENERGY.counts[0]: 1,
            ENERGY.counts[1]: 1,
            ENERGY.mono_flag: True,
            ENERGY.splits[0]: 80.0 + i % 10,
            ENERGY.splits[2]: 20.0 - i % 10,
            ENERGY.shares[0]: 50.0 + i % 10,
            ENERGY.shares[1]: 50.0 - i % 10,
        }
        rows.append(row)
    return rows


CLEAN_SCHEMA = ", ".join(
    ["source_row_id long"]
    + [f"{c} string" for c in (*ENERGY.context, ENERGY.year)]
    + [f"{c} double" for c in ENERGY.ratios + ENERGY.splits + ENERGY.shares]
    + [f"{c} long" for c in ENERGY.counts]
    + [f"{ENERGY.mono_flag} boolean"]
)
