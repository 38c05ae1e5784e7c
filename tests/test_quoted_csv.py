"""Text files with line breaks inside quoted fields, cut into many blocks."""

from __future__ import annotations

import csv
import io
import os
import random

import pytest

from wattsift.session import scratch_path
from wattsift.sources.csv_locale import scan_locale_csv
from wattsift.sources.quoted_csv import quoted_records, read_quoted_csv


def _files(spark, texts: list[str]) -> str:
    folder = scratch_path(spark, "quoted")
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/{i:03}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return folder


def _text(rows: list[list[str]], end: str = "\n") -> str:
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows([["key", "a note"], *rows])
    return out.getvalue()


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("300", "0", "1"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_blocks(spark, small_blocks, end):
    rng = random.Random(len(end))
    words = ["a", '"', "\n", ";", "é", " ", "line\nbreak", '""', "\n\n", "x" * 30]
    tables = [[[str(rng.random()), "v" + "".join(rng.choices(words, k=rng.randrange(8)))] for _ in range(n)] for n in (40, 1, 25)]
    tables[2][3][1] = "long\n" * 200 + '"'  # a field over several whole blocks
    folder = _files(spark, [_text(t, end) for t in tables])
    found = read_quoted_csv(spark, folder).orderBy("__id").collect()
    assert [r["__id"] for r in found] == list(range(66))
    assert [[r["key"], r["a note"]] for r in found] == [row for t in tables for row in t]
    assert quoted_records(spark, folder).filter("id is null").count() == 3
    assert spark.read.text(folder).rdd.getNumPartitions() > 9


def test_blank_lines_and_missing_fields(spark, small_blocks):
    folder = _files(spark, ["\n\nkey;value\n\n1;2,5\n  \n2\n3;NA\n\n", "\n", "key;value\n4;0,5"])
    found = scan_locale_csv(spark, folder, types={"key": "long", "value": "double"}, row_id="row", multiline=True)
    assert [tuple(r) for r in found.orderBy("row").collect()] == [(0, 1, 2.5), (1, 2, None), (2, 3, None), (3, 4, 0.5)]


@pytest.mark.parametrize(
    ("texts", "fault"),
    [(["a;b\n1;\"x\n"], "not closed"), (["a;b\n", "a;c\n"], "different headers"), (["a;a\n1;2\n"], "repeated"), (["\n"], "no header")],
)
def test_faulty_files_raise(spark, texts, fault):
    with pytest.raises(Exception, match=fault):
        read_quoted_csv(spark, _files(spark, texts)).collect()
