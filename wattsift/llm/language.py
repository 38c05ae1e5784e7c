"""Language of texts by the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams (one to three letters, word edges as spaces), weighted by TF-IDF
and brought to length one.  Each language's training vectors are clustered into a few centroids; a text gets the
language of the centroid with the highest cosine.  A text whose cosine is far below what training texts of its length
reach is marked as rejected.

The classifier is fitted on a sample of at most ``FIT_ROWS`` labelled texts, or 20 of each language if that is more,
shared out evenly among the languages and drawn by a hash of key and text; prediction reads every text whole.  A table
of more than ``MAX_LANGUAGES`` languages raises.  Centroids are kept by n-gram, without the n-grams they do not have, so
the model grows with what the fitting texts hold and not with languages times dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattsift.llm.words import text_rows

FIT_ROWS = 3_000
CENTROIDS = 4
DIMENSION_BITS = 15
REJECT_SHARE = 0.5  # of the cosine that all but one in a hundred training texts of the same length exceed
MAX_LANGUAGES = 2_000  # a column with more values does not name languages
POSTINGS = 1 << 20  # weights multiplied at a time
SHORT_FLOOR = 0.03  # at most, for the shortest texts; texts in a foreign script reach about 0.01
UNKNOWN = "und"
PART = 1 << 20  # characters handled at a time

_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))  # odd multipliers of the n-gram hash


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(places, counts) of the hashed n-grams; None without any letter."""
    if not text:
        return None
    size = 1 << DIMENSION_BITS
    counts, carry, seen = np.zeros(size, np.int64), np.array([32], np.uint32), False
    for at in range(0, len(text), PART):
        part = text[at : at + PART].lower().encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(part, "<u4")
        points = np.where(_letters()[points], points, np.uint32(32))
        tail = [np.array([32], np.uint32)] if at + PART >= len(text) else []
        line = np.concatenate([carry, points, *tail])
        new = len(carry)  # n-grams that end before this place have been counted
        letter = line != 32
        seen = seen or bool(letter[new:].any())
        for n in (1, 2, 3):
            ends = np.arange(max(new, n - 1), len(line))
            middle = letter[ends] if n == 1 else letter[ends] | letter[ends - 1] if n == 2 else letter[ends - 1]
            ends = ends[middle]
            mixed = np.full(len(ends), n, np.uint32)
            for back in range(n):
                mixed = mixed + line[ends - back] * _FACTORS[back]
            mixed = (mixed ^ (mixed >> np.uint32(15))) * _FACTORS[1]
            counts += np.bincount(mixed >> np.uint32(32 - DIMENSION_BITS), minlength=size)
        carry = line[-2:]
    if not seen:
        return None
    places = np.flatnonzero(counts)
    return places, counts[places]


@dataclass
class LanguageModel:
    languages: list[str]
    weight: np.ndarray  # inverse document frequency of each place
    first: np.ndarray  # of each place: where its entries begin in ``member`` and ``share``
    member: np.ndarray  # centroid that has the place
    share: np.ndarray  # and its component there
    owner: np.ndarray  # language of each centroid
    floor: np.ndarray  # rejected below, by log2 of the number of different n-grams

    def vector(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = (1 + np.log(counts)) * self.weight[places]
        norm = np.linalg.norm(values)
        return values / norm if norm else values

    def cosines(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Inner products of a vector with all centroids."""
        found = np.zeros(len(self.owner))
        begins, sizes = self.first[places], np.diff(self.first)[places]
        ends = np.cumsum(sizes)
        at = done = 0
        while at < len(places):
            stop = max(at + 1, int(np.searchsorted(ends, done + POSTINGS, "right")))
            n = sizes[at:stop]
            entries = np.repeat(begins[at:stop] - (ends[at:stop] - n - done), n) + np.arange(ends[stop - 1] - done)
            found += np.bincount(self.member[entries], np.repeat(values[at:stop], n) * self.share[entries], len(found))
            at, done = stop, int(ends[stop - 1])
        return found

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        found = ngram_counts(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0, True
        cosines = self.cosines(found[0], self.vector(*found))
        best = int(np.argmax(cosines))
        score = float(min(max(cosines[best], 0.0), 1.0))
        return self.languages[self.owner[best]], score, score < self.floor[_length_class(found[0])]


def _length_class(places: np.ndarray) -> int:
    return min(int(len(places)).bit_length(), DIMENSION_BITS + 1)


def _clusters(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Up to ``k`` unit centroids by cosine; starts are picked far apart, so the result is the same each time."""
    mean = vectors.mean(0)
    picked = [int(np.argmax(vectors @ mean))]
    near = vectors @ vectors[picked[0]]
    while len(picked) < min(k, len(vectors)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[picked[-1]])
    centres = np.vstack([mean / max(np.linalg.norm(mean), 1e-12), vectors[picked[1:]]]) if len(picked) > 1 else mean[None, :]
    for _ in range(rounds):
        closest = np.argmax(vectors @ centres.T, axis=1)
        new = np.stack([vectors[closest == c].mean(0) if (closest == c).any() else centres[c] for c in range(len(centres))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, centres):
            break
        centres = new
    sizes = np.bincount(np.argmax(vectors @ centres.T, axis=1), minlength=len(centres))
    return centres[sizes >= max(1, len(vectors) // 50)]  # a centroid of a few odd texts speaks for no language


def fit_languages(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Fit on rows with a language and a letter in the text; without any the model knows no language.

    Each language gives the ``fit_rows`` / languages (20 at least) texts with the smallest hashes of key and text, or
    all if it has fewer; rows equal in key and text count once.  So at most max(``fit_rows``, 20 x languages) texts
    come to the driver.  More than ``max_languages`` languages raise.
    """
    rows = labelled.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).alias("lang")).where("lang is not null and t is not null")
    rows = rows.select("lang", "t", F.xxhash64("k", "t", F.lit("fit")).alias("h"))
    totals = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    languages = totals.count()
    if languages > max_languages:
        raise ValueError(f"{languages} values of {lang} are more than {max_languages} languages")
    share = max(20, fit_rows // max(1, languages))
    totals = F.broadcast(totals)  # one short row for each of at most ``max_languages``; texts need not move to them
    draw = F.pmod("h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    few = rows.join(totals, "lang").where(draw * F.col("n") < share * 1.2 + 60)  # more than ``share`` in all likelihood
    few = few.groupBy("lang", "h").agg(F.min("t").alias("t"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h"))
    sample = few.select("lang", "t", place.alias("place")).where(F.col("place") <= share).select("lang", "t")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, places, counts = [], [], []
            for lang_value, t in text_rows(batch, "lang", "t"):
                if (found := ngram_counts(t)) is not None:
                    kept.append(lang_value)
                    places.append(found[0].astype(np.int32))
                    counts.append(found[1].astype(np.int32))
            columns = [pa.array(kept, pa.string()), pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "places", "counts"])

    got = sample.mapInArrow(work, "lang string, places array<int>, counts array<int>").toArrow()
    texts = sorted(
        ((v, p.values.to_numpy(), c.values.to_numpy()) for v, p, c in zip(got["lang"].to_pylist(), got["places"], got["counts"], strict=True)),
        key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()),
    )
    size = 1 << DIMENSION_BITS
    seen = np.zeros(size)
    for _, places, _ in texts:
        seen[places] += 1
    languages = sorted({v for v, _, _ in texts})
    none = np.zeros(0, np.int32)
    model = LanguageModel(languages, np.log((1 + len(texts)) / (1 + seen)) + 1, np.zeros(size + 1, int), none, none.astype(np.float32), none, np.zeros(DIMENSION_BITS + 2))
    owner: list[int] = []
    entries = [(none, none, none.astype(np.float32))]
    for number, (_, group) in enumerate(groupby(texts, key=lambda r: r[0])):
        own = [(p, c) for _, p, c in group]
        vectors = np.zeros((len(own), size), np.float32)
        for row, (places, counts) in zip(vectors, own, strict=True):
            row[places] = model.vector(places, counts)
        centres = _clusters(vectors, centroids)
        which, places = np.nonzero(centres)
        entries.append((places.astype(np.int32), (which + len(owner)).astype(np.int32), centres[which, places].astype(np.float32)))
        owner += [number] * len(centres)
    places, model.member, model.share = map(np.concatenate, zip(*entries, strict=True))
    order = np.argsort(places, kind="stable")
    model.member, model.share, model.owner = model.member[order], model.share[order], np.array(owner, int)
    model.first[1:] = np.cumsum(np.bincount(places, minlength=size))
    by_length: dict[int, list[float]] = {}
    for _, places, counts in texts:
        by_length.setdefault(_length_class(places), []).append(float(model.cosines(places, model.vector(places, counts)).max()))
    lowest = np.inf
    for c in range(DIMENSION_BITS + 1, -1, -1):  # a shorter text is never asked for more than a longer one
        if len(by_length.get(c, ())) >= 20:
            lowest = min(lowest, REJECT_SHARE * float(np.quantile(by_length[c], 0.01)))
        model.floor[c] = lowest
    known = model.floor[np.isfinite(model.floor)]
    model.floor[~np.isfinite(model.floor)] = known.max() if len(known) else 0.0
    model.floor[:6] = np.minimum(model.floor[:6], SHORT_FLOOR)  # under 32 different n-grams: a word or three
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected): one row per row of ``docs``; only the text is looked at.

    A null text or one without a letter has the language ``und``, score 0 and is rejected.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # no larger than the n-grams of the fitting texts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shared.value.predict(t) for _, t in text_rows(batch, key, text)]
            names, scores, rejected = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], names=[key, "lang_pred", "score", "rejected"])

    rows = docs.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(work, f"`{key}` {kind}, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not shared.value.predict(t.as_py())[2] for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)), F.lit(0))
