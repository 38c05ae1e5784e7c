from __future__ import annotations

import hashlib
import io
import zipfile

import pytest
from conftest_rows import rows_by

from wattsift.llm import warc_zip
from wattsift.llm.warc_zip import Ranges, central_directory, gzip_member, parse_record, read_archives, record_ranges, round_trip, warc_record, write_archives, zip_archive

BIG = "<p>Ünïcode payload</p>" * 80
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/\r\n3 x", BIG), (4, None, "small"), (5, "http://a/5", "small"), (6, "u", None),
    (7, "u", ""), (8, "u", "x" * 200_000), (3, "http://a/3", "other"), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 90), (None, "n", BIG), (2, "again", BIG + "!"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, refers_to string").repartition(3)


def wanted(html: str | None) -> tuple[int, str]:
    data = (html or "").encode()
    return len(data), hashlib.sha1(data).hexdigest()


@pytest.mark.parametrize("archive_bytes", [8 << 20, 1])
def test_round_trip(pages, archive_bytes):
    rows = rows_by(round_trip(pages, archive_bytes=archive_bytes), "page_id")
    assert sum(map(len, rows.values())) == len(PAGES)
    for page, _, html in PAGES:
        same = [r for r in rows[page] if (r.payload_bytes, r.payload_digest) == wanted(html)]
        assert same
        revisit = html == BIG and page != 3
        assert all((r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None)) for r in same)


def test_payloads_come_back(spark, pages, tmp_path):
    path = str(tmp_path / "boxes")
    write_archives(pages, path, archive_bytes=3_000)
    rows = read_archives(spark, path, with_payload=True).collect()
    assert sorted(r.payload for r in rows if r.record_type == "response") == sorted((h or "").encode() for p, _, h in PAGES if not (h == BIG and p != 3))
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    for f in (tmp_path / "boxes").glob("part-*"):
        with zipfile.ZipFile(f) as box:  # other readers can open them too
            assert box.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in box.infolist())


def test_no_pages(spark, pages):
    assert round_trip(pages.where("false")).count() == 0


def members() -> list[bytes]:
    return [gzip_member(warc_record(i, f"http://x/{i}", b"payload %d" % i, None, False)) for i in range(5)]


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("front", [b"", b"#!/bin/sh\n"])
def test_directories(zip64, front):
    data = front + zip_archive(members(), list(range(5)), b"a comment with PK\5\6 inside", zip64)
    box = Ranges("", data)
    assert [m.name for m in central_directory(box)] == ["archive/data.warc.gz", "indexes/index.cdx", "datapackage.json"]
    assert [parse_record(box.read(s, n))["page_id"] for s, n in record_ranges(box)] == list(range(5))


def zip64_end(data: bytes) -> bytes:
    """The same archive with its end told by ZIP64 records only."""
    import struct

    at = data.rfind(b"PK\5\6")
    count, size, start = struct.unpack("<HII", data[at + 10 : at + 20])
    end64 = b"PK\6\6" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, size, start)
    locator = b"PK\6\7" + struct.pack("<IQI", 0, at, 1)
    return data[:at] + end64 + locator + b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)


def test_zip64_end_records():
    box = Ranges("", zip64_end(zip_archive(members(), list(range(5)))))
    assert len(list(record_ranges(box))) == 5


@pytest.mark.parametrize("name", ["archive/data.warc.gz", "archive/data.warc"])
def test_archives_without_an_index_are_walked(name):
    plain = [warc_record(i, None, b"p" * i * 700, None, False) for i in range(4)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(name, b"".join(gzip_member(p) if name.endswith("gz") else p for p in plain))
    box = Ranges("", out.getvalue())
    assert [parse_record(box.read(s, n))["payload_bytes"] for s, n in record_ranges(box)] == [0, 700, 1400, 2100]


def _info(kind: str, content_type: str, block: bytes) -> bytes:
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nContent-Type: {content_type}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    return head + block + b"\r\n\r\n"


def _two_members(index: str) -> bytes:
    """Two archives with 3 and 2 records and an index of the wanted form over both."""
    lines, boxes = [], []
    for name, ids in (("a.warc.gz", (0, 1, 2)), ("b.warc.gz", (3, 4))):
        at, parts = 0, []
        for i in ids:
            part = gzip_member(warc_record(i, f"http://x/{i}", b"payload %d" % i, None, False))
            lines.append({
                "cdx": f"x)/{i} 2020 http://x/{i} text/html 200 ABC - - {len(part)} {at} {name}",
                "letters": f"{name} {at} {len(part)} x)/{i}",
                "cdxj": f'x)/{i} 2020 {{"url": "http://x/{i}", "length": "{len(part)}", "offset": "{at}", "filename": "{name}"}}',
                "own": f"http://x/{i} {at} {len(part)}",
                "part": f"x)/{i} 2020 http://x/{i} text/html 200 ABC - - {len(part)} {at} {name}" if i % 2 else "",
                "noise": "nothing to be read here}",
            }[index])
            parts.append(part)
            at += len(part)
        boxes.append((f"archive/{name}", b"".join(parts)))
    head = {"cdx": " CDX N b a m s k r M S V g\n", "letters": " CDX g V S N\n", "cdxj": "!meta\n"}.get(index, "")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in boxes:
            z.writestr(name, data)
        text = (head + "\n".join(lines) + "\n").encode()
        z.writestr("indexes/index.cdx.gz" if index == "letters" else "indexes/index.cdxj" if index == "cdxj" else "indexes/index.cdx", gzip_member(text) if index == "letters" else text)
    return out.getvalue()


@pytest.mark.parametrize("index", ["cdx", "letters", "cdxj", "own", "part", "noise"])
def test_indexes_of_other_makers_and_several_members(index):
    box = Ranges("", _two_members(index))
    assert [parse_record(box.read(s, n))["page_id"] for s, n in record_ranges(box)] == list(range(5))


def test_only_trusted_indexes_are_followed(monkeypatch):
    walked = []
    real = warc_zip._walked
    monkeypatch.setattr(warc_zip, "_walked", lambda *a: walked.append(a) or real(*a))
    for index, times in (("cdx", 0), ("letters", 0), ("cdxj", 0), ("own", 2), ("part", 2), ("noise", 2)):
        walked.clear()
        assert len(list(record_ranges(Ranges("", _two_members(index))))) == 5 and len(walked) == times, index


def test_records_that_hold_no_page(spark, tmp_path):
    records = [
        _info("warcinfo", "application/warc-fields", b"software: some crawler\r\nformat: WARC 1.1\r\n"),
        _info("request", "application/http; msgtype=request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n"),
        _info("response", "text/dns", b"20200101000000\nx. 300 IN A 127.0.0.1\n"),
        _info("metadata", "application/warc-fields", b""),
        _info("revisit", "application/http", b""),
        warc_record(7, "http://x/7", b"<p>page</p>", None, False),
    ]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/data.warc.gz", b"".join(map(gzip_member, records)))
    (tmp_path / "one.wacz").write_bytes(out.getvalue())
    found = {(r.record_type, r.page_id, r.payload_bytes) for r in read_archives(spark, str(tmp_path)).collect()}
    assert found == {("warcinfo", None, 42), ("request", None, 27), ("response", None, 37), ("metadata", None, 0), ("revisit", None, None), ("response", 7, 11)}


def test_broken_archives_raise():
    good = zip_archive(members(), list(range(5)))
    with pytest.raises(ValueError):
        central_directory(Ranges("", good[:-30]))
    with pytest.raises(ValueError):
        central_directory(Ranges("", b""))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", b"a" * 1000)
    with pytest.raises(ValueError):
        list(record_ranges(Ranges("", out.getvalue())))
    record = warc_record(1, "u", b"payload", None, False)
    with pytest.raises(ValueError):
        parse_record(record.replace(b"payload", b"paYload"))


def test_large_files_are_read_whole_where_no_ranges_are(spark, pages, tmp_path, monkeypatch):
    path = str(tmp_path / "boxes")
    write_archives(pages, path)
    monkeypatch.setattr("wattsift.llm.warc_zip._RANGED", ())
    assert read_archives(spark, path).count() == len(PAGES)
