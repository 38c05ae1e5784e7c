"""Keys: reproducible draws, versions in paths, digests and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERSION_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DRAW_BITS = 52  # exact in a double as well as in a long


def _lit(part: Column | str | int) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))


def draw(seed: int, purpose: str, *parts: Column | str | int) -> Column:
    """Uniform 52-bit integer from (seed, purpose, parts).

    It depends on values only, never on partitioning, so a lost task recomputes the same draw.
    """
    text = F.concat_ws(":", _lit(seed), _lit(purpose), *[_lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")


def group_key(columns: list[Column]) -> Column:
    """One string per combination of values; null is a value of its own."""
    tagged = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns]
    return F.concat_ws("\u001f", *tagged)


def version_of(path: Column, strict: bool = True) -> Column:
    """Text between the first `version=` and the next slash."""
    found = F.regexp_extract(path, r"version=([^/]*)", 1)
    missing = F.raise_error(F.concat(F.lit("No dataset version in key: "), path)) if strict else F.lit(None)
    return F.when(path.contains("version="), found).otherwise(missing.cast("string"))


def version_from_timestamp(text: Column) -> Column:
    """First ten characters of an ISO timestamp; null unless they are a calendar date."""
    head = F.substring(text, 1, 10)
    return F.when(is_version(head) & F.try_to_timestamp(head, F.lit("yyyy-MM-dd")).isNotNull(), head)


def is_version(text: Column) -> Column:
    return text.rlike(VERSION_PATTERN)


def natural_id(*parts: Column | str) -> Column:
    """Stable id of a row from its natural key, laid out like a UUID."""
    digest = F.sha2(F.concat_ws("\u001f", *[_lit(p) for p in parts]), 256)
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cut])


def sorted_json(mapping: Column) -> Column:
    """Map to a JSON object with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(mapping))))


def weights_from_json(text: Column) -> Column:
    """JSON object of type weights to a map; null when the text is no JSON object."""
    return F.from_json(text, "map<string,double>")
