"""Spelling variants: words one edit apart, found by sorting the rotations of terminator-marked words.

A word ``acb`` marked with an end sign has the rotation ``b$ac``.  Leave its last character out and the prefix
``b$a`` is what the word shares with every word that has another character in that place (``axb``) and with the
word that has none (``ab``, one of whose rotations is ``b$a`` itself).  So all rotations are sorted by that prefix,
and each run of equal prefixes holds words that are one edit apart.  A run has at most one row for each letter of
the alphabet and one for the word without the character, however large the vocabulary: no run can grow hot.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattsift.llm.words import text_rows
from wattsift.session import materialise

END = "$"  # sorts before every letter and is no letter
LETTER = "[A-Za-zÀ-ÿ]"
SLICE = 1 << 22
HELD_WORDS = 200_000
HELD_ROWS = 65_536
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _slices(text: str, letter: re.Pattern) -> Iterator[str]:
    """Consecutive parts of about ``SLICE`` code points that end where a run of letters ends."""
    start = 0
    while len(text) - start > SLICE:
        stop = start + SLICE
        while stop < len(text) and letter.match(text, stop):
            stop += 1
        yield text[start:stop]
        start = stop
    yield text[start:] if start else text


def misspelt(key: object, run: str, every: int) -> str:
    """The run, or for one in ``every`` pairs of key and run the run without one code point; a null key is empty."""
    h = zlib.crc32(f"{'' if key is None else key}:{run}".encode("utf-8", "surrogatepass"))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """(word, n): words of at least ``letters`` code points that occur at least ``least`` times in all texts.

    Words are the longest runs of letters with A-Z lower-cased, after ``misspelt``.  Null texts have none.
    Counts are added up in each task before any word is sent.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, letter = re.compile(f"{LETTER}{{{letters},}}"), re.compile(LETTER)
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for k, t in text_rows(batch, key, text):
                for part in _slices(t or "", letter):
                    for run, n in Counter(runs.findall(part)).items():
                        word = misspelt(k, run.translate(LOWER), every)
                        if len(word) >= letters:
                            counts[word] += n
                    if len(counts) > HELD_WORDS:
                        yield out()
        if counts:
            yield out()

    found = docs.select(key, text).mapInArrow(work, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, edited, n): each rotation of each marked word, with and without its last character set aside."""
    word, size = F.col("word"), F.char_length("word")

    def row(prefix: Column, edited: Column) -> Column:
        return F.struct(prefix.alias("prefix"), edited.alias("edited"))

    def turned(before: Column, after: Column) -> Column:
        return F.concat(word.substr(after + 1, size), F.lit(END), word.substr(F.lit(1), before))

    skips = F.transform(F.sequence(F.lit(0), size - 1), lambda i: row(turned(i, i + 1), word.substr(i + 1, F.lit(1))))
    wholes = F.transform(F.sequence(F.lit(0), size), lambda i: row(turned(i, i), F.lit("")))
    return words.where(size > 0).select(F.explode(F.concat(skips, wholes)).alias("r"), "n").select("r.*", "n")


def _pairs(rows: pa.Table) -> pa.RecordBatch:
    """(word, other, other_n) for all words of each run of equal prefixes that are one edit apart; whole runs only."""
    prefix = rows.column("prefix").combine_chunks()
    new = pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.concatenate(([True], new)))
    sizes = np.diff(np.append(starts, len(prefix)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    at = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    held = rows.take(pa.array(at))
    shared, edited = held.column("prefix").to_pylist(), held.column("edited").to_pylist()
    words = []
    for p, c in zip(shared, edited, strict=True):
        tail, head = p.split(END)
        words.append(head + c + tail)
    whole = np.array([not c for c in edited], bool)
    # of equal characters side by side only the first counts as the one that is missing
    first = np.array([p[-1] != c for p, c in zip(shared, edited, strict=True)], bool)
    low = np.repeat(np.cumsum(sizes) - sizes, sizes * sizes)
    within = np.arange(len(low)) - np.repeat(np.cumsum(sizes * sizes) - sizes * sizes, sizes * sizes)
    width = np.repeat(sizes, sizes * sizes)
    i, j = low + within // width, low + within % width
    near = (i != j) & (~whole[i] | first[j]) & (~whole[j] | first[i])
    i, j = i[near], j[near]
    named = pa.array(words, pa.string())
    return pa.RecordBatch.from_arrays([named.take(pa.array(i)), named.take(pa.array(j)), held.column("n").combine_chunks().take(pa.array(j))], names=["word", "other", "other_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n): every ordered pair of words that differ by one inserted, deleted or replaced code point.

    ``words``: distinct word, n.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < HELD_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            prefix = rows.column("prefix").combine_chunks()
            ends = np.flatnonzero(pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False))
            if len(ends):  # the last run may go on in the next batch
                yield _pairs(rows.slice(0, int(ends[-1]) + 1))
                held = rows.slice(int(ends[-1]) + 1).to_batches()
        if held and sum(x.num_rows for x in held):
            yield _pairs(pa.Table.from_batches(held))

    dealt = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "edited")
    return dealt.mapInArrow(work, "word string, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: the last word along the forms.  Steps double: a form has at least ten
    times the count, so chains are short and so are the rounds."""
    hops = materialise(forms.select("word", F.col("form").alias("root")), "hops")
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = materialise(hops.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "hops")
        hops = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return hops


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = 7, least: int = 2, times: int = 10, every: int = 31
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of ``word_counts``.

    ``n_near``: words one edit away.  ``form``: of these the most frequent (ties: the smallest in code-point order),
    if it is at least ``times`` as frequent as the word, else null; ``form_n`` its count.  ``root``: the last word
    along the forms, the word itself without one.  Null keys count as the empty text, null texts have no words,
    repeated rows count again; other columns are not read.  An empty table gives an empty table.
    """
    words = materialise(word_counts(docs, key, text, letters, least, every), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    held = -F.col("best.rank") >= times * F.col("n")
    formed = materialise(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(held, F.col("best.form")).alias("form"), F.when(held, -F.col("best.rank")).alias("form_n")),
        "forms",
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The check sum is worked out bit by bit: SQL has no function for it.
ORACLE = r"""with recursive runs as (select doc_id, run, count(*) as n from (select coalesce(cast(doc_id as varchar), '') as doc_id,
  translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents) where length(run) >= 7 group by all),
bytes as (select *, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: case when unicode(c) < 128 then [unicode(c)] else [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] end)) as b from runs),
sums as (select run, n, xor(list_reduce(list_prepend(4294967295::bigint, b::bigint[]), lambda c, x: xor(c >> 8, list_reduce(list_prepend(xor(c, x) & 255, range(8)), lambda d, k: case when d & 1 = 1 then xor(d >> 1, 3988292384) else d >> 1 end))), 4294967295) as h from bytes),
spelt as (select n, case when h % 31 = 0 then left(run, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2) else run end as word from sums),
words as (select word, cast(sum(n) as bigint) as n from spelt where length(word) >= 7 group by word having sum(n) >= 2),
gaps as (select word, n, left(word, i) as head, substr(word, i + 2) as tail from (select word, n, unnest(range(length(word))) as i from words)),
pairs as (select a.word, b.word as other, b.n as other_n from gaps a join gaps b on a.head = b.head and a.tail = b.tail and a.word <> b.word
 union select g.word, w.word, w.n from gaps g join words w on w.word = g.head || g.tail
 union select w.word, g.word, g.n from gaps g join words w on w.word = g.head || g.tail),
near as (select word, count(*) as n_near, min({'rank': -other_n, 'form': other}) as best from pairs group by word),
formed as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when -best.rank >= 10 * w.n then best.form end as form, case when -best.rank >= 10 * w.n then -best.rank end as form_n from words w left join near using (word)),
chain as (select word, form as root from formed where form is not null union all select c.word, f.form from chain c join formed f on f.word = c.root where f.form is not null),
roots as (select word, arg_max(root, n) as root from (select c.word, c.root, w.n from chain c join words w on w.word = c.root) group by word)
select f.word, f.form, coalesce(r.root, f.word) as root, f.n, f.n_near, f.form_n from formed f left join roots r using (word)"""
