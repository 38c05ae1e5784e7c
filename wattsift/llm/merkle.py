"""Merkle trees over sections, paragraphs and sentences, in DataFrame functions only.

A text is cut into sections at empty lines, sections into paragraphs at line ends and paragraphs into sentences; the
cuts can be undone, so different texts have different trees.  A leaf is the hash of a sentence, an inner node the hash
of its children's.  A fingerprint is the root followed by the leaves in their places:

    root ":" section "|" section ...     section: paragraph "/" paragraph ...     paragraph: leaf "." leaf ...

Equal roots mean equal texts; where roots differ, only branches that differ are looked into.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION, PARAGRAPH, SENTENCE = "\n\n", "\n", ". "
LEAF_DIGITS = 16
ROOT_DIGITS = 64
RANGE_BYTES = 32 << 20  # of text in one range of keys


def tree(text: Column) -> Column:
    """Leaf hashes as sections of paragraphs of sentences; null counts as empty, which has one leaf."""
    leaf = lambda s: F.left(F.sha2(s, 256), F.lit(LEAF_DIGITS))
    sentences = lambda p: F.transform(F.split(p, r"\. ", -1), leaf)
    paragraphs = lambda s: F.transform(F.split(s, PARAGRAPH, -1), sentences)
    return F.transform(F.split(F.coalesce(text, F.lit("")), SECTION, -1), paragraphs)


def branches(nodes: Column) -> Column:
    """Per section its paragraphs' hashes."""
    return F.transform(nodes, lambda s: F.transform(s, lambda p: F.sha2(F.array_join(p, "."), 256)))


def root(nodes: Column) -> Column:
    sections = F.transform(branches(nodes), lambda s: F.sha2(F.array_join(s, "/"), 256))
    return F.sha2(F.array_join(sections, "|"), 256)


def fingerprint(nodes: Column) -> Column:
    body = F.transform(nodes, lambda s: F.array_join(F.transform(s, lambda p: F.array_join(p, ".")), "/"))
    return F.concat(root(nodes), F.lit(":"), F.array_join(body, "|"))


def leaves(print_: Column) -> Column:
    return F.array_distinct(F.split(F.substring(print_, ROOT_DIGITS + 2, 2**31 - 1), r"[./|]", -1))


def likeness(a: Column, b: Column) -> Column:
    """Share of different leaves two fingerprints have in common, 0 to 1 (twice the common ones by all)."""
    return F.when(F.left(a, F.lit(ROOT_DIGITS)) == F.left(b, F.lit(ROOT_DIGITS)), 1.0).otherwise(
        2.0 * F.size(F.array_intersect(leaves(a), leaves(b))) / (F.size(leaves(a)) + F.size(leaves(b)))
    )


def edited_places(a: Column, b: Column) -> Column:
    """Places (section, paragraph), from 0, of paragraphs whose hashes differ between two trees, or that only one has.

    Sections with equal hashes are skipped whole; a paragraph put in moves those behind it.
    """
    left, right = branches(a), branches(b)
    sections = F.sequence(F.lit(0), F.greatest(F.size(left), F.size(right)) - 1)
    none = F.array().cast("array<string>")

    def inside(i: Column) -> Column:
        x, y = F.coalesce(F.get(left, i), none), F.coalesce(F.get(right, i), none)
        places = F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y), F.lit(1)) - 1)
        odd = F.filter(places, lambda j: ~F.get(x, j).eqNullSafe(F.get(y, j)))
        there = F.transform(odd, lambda j: F.struct(i.alias("section"), j.alias("paragraph")))
        return F.when(x == y, F.array().cast("array<struct<section: int, paragraph: int>>")).otherwise(there)

    return F.flatten(F.transform(sections, inside))


def fingerprint_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint): one row per row of ``docs``; null texts count as empty; other columns are not read."""
    return docs.select(F.col(key), tree(F.col(text)).alias("t")).select(key, fingerprint(F.col("t")).alias("fingerprint"))


def _range_of(value: Column, bounds: list) -> Column:
    """Number of bounds up to the value, found in two steps: the part of the list, then the place in it."""
    width = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    tops = F.lit([p[0] for p in parts])
    part = F.size(F.filter(tops, lambda b: b <= value))
    within = F.size(F.filter(F.element_at(F.array(*[F.lit(p) for p in parts]), F.greatest(part, F.lit(1))), lambda b: b <= value))
    return F.when(part == 0, 0).otherwise((part - 1) * width + within)


def with_next(docs: DataFrame, key: str, columns: list[str], size: Column, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with ``next_<column>`` of the row that follows by ascending ``key``; the first follows the last.

    Rows meet by ranges of the numeric key, cut at keys of the table.  The row a range begins with is also sent to the
    range before it, as a guest; so rows move once, and no task holds more than a range.  Null keys come first; rows
    with one key are ordered by hash, equal rows may swap places.
    """
    spark = docs.sparkSession
    facts = docs.agg(F.sum(size).alias("bytes"), F.min(key).alias("least"), F.count("*").alias("rows"), F.count(key).alias("keys")).first()
    ranges = max(-(-(facts["bytes"] or 0) // range_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = max(1, min(ranges, facts["keys"]))
    points = [i / ranges for i in range(1, ranges)]
    bounds = []
    if points:
        found = docs.agg(F.percentile_approx(key, points, max(10_000, 8 * ranges)).alias("b")).first()["b"]
        bounds = sorted({b for b in found if b > facts["least"]})
    nulls = facts["rows"] > facts["keys"]
    own = _range_of(F.col(key), bounds) if bounds else F.lit(0)
    own = F.coalesce(own, F.lit(0))
    head = F.col(key).isNull() if nulls else F.col(key) == F.lit(facts["least"])
    opens = F.col(key).isin(bounds) if 0 < len(bounds) <= 32 else F.array_contains(F.lit(bounds), F.col(key)) if bounds else F.lit(False)
    as_guest = F.when(head, F.lit(len(bounds))).when(opens, own - 1)
    places = F.array_compact(F.array(F.struct(own.alias("range"), F.lit(False).alias("guest")), F.when(as_guest.isNotNull(), F.struct(as_guest.alias("range"), F.lit(True).alias("guest")))))
    dealt = docs.withColumn("_place", F.explode(places))
    order = Window.partitionBy("_place.range").orderBy("_place.guest", F.col(key).asc_nulls_first(), F.xxhash64(*columns))
    return dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where("not _place.guest").drop("_place")


def edit_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the text with its last half replaced by the beginning, as long if there is as much, of the next
    one by ascending numeric key.  Null texts count as empty; an only row is its own next.  Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("t", tree(F.col("text"))).select("key", "text", fingerprint(F.col("t")).alias("print"))
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2)
    pairs = with_next(rows, "key", ["text", "print"], F.octet_length("text"))
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half.cast("int")))
    pairs = pairs.select("key", n.cast("long").alias("n_chars"), "text", "print", "next_print", edited.alias("edited"))
    pairs = pairs.withColumn("t", tree(F.col("edited")))
    pairs = pairs.select("key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "print", "next_print", "text", "t", fingerprint(F.col("t")).alias("edited_print"))
    return pairs.select(
        F.col("key").alias(key), "n_chars", "edited_sha256", F.col("print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


ORACLE = r"""with docs as (select doc_id, coalesce(text, '') as text from documents),
pairs as (select doc_id, text, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as nxt from docs),
texts as (select doc_id, length(text) as n_chars, text, nxt,
  substring(text, 1, length(text) - length(text) // 2) || substring(nxt, 1, length(text) // 2) as edited from pairs),
trees as (select doc_id, n_chars, edited, list_transform([text, edited, nxt], lambda t:
  list_transform(string_split(t, E'\n\n'), lambda s: list_transform(string_split(s, E'\n'), lambda p:
  list_transform(string_split(p, '. '), lambda x: left(sha256(x), 16))))) as trees from texts),
prints as (select doc_id, n_chars, edited, list_transform(trees, lambda t: sha256(array_to_string(list_transform(t, lambda s:
  sha256(array_to_string(list_transform(s, lambda p: sha256(array_to_string(p, '.'))), '/'))), '|')) || ':' ||
  array_to_string(list_transform(t, lambda s: array_to_string(list_transform(s, lambda p: array_to_string(p, '.')), '/')), '|')) as f,
  list_transform(trees, lambda t: list_distinct(flatten(flatten(t)))) as leaves from trees)
select doc_id, n_chars, sha256(edited) as edited_sha256, f[1] as fingerprint, f[2] as edited_fingerprint,
 2.0 * len(list_intersect(leaves[1], leaves[2])) / (len(leaves[1]) + len(leaves[2])) as near_edited,
 2.0 * len(list_intersect(leaves[1], leaves[3])) / (len(leaves[1]) + len(leaves[3])) as near_next from prints"""
