"""Web archives packed in ZIP files: written by Spark's own file writer, read by ranges.

An archive is a ZIP whose members are stored, not deflated: ``archive/data.warc.gz`` (a gzip member per record) and
``indexes/index.cdx`` (a line per record with its offset and length).  The reader parses the end of the file, the
ZIP64 records if there are any, and the central directory, finds the members, and then reads single records by their
ranges; nothing is extracted.  An archive without an index is walked once, gzip member by gzip member.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsift.session import scratch_path

ARCHIVE_BYTES = 8 << 20
REVISIT_BYTES = 1_000
DATE = "1970-01-01T00:00:00Z"  # pages have no time of capture
READ_BYTES = 4 << 20
LEAST_BYTES = 1 << 20  # archives' bytes for one reading task, at least and at most
TASK_BYTES = 32 << 20
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------------------------------------- writing


def _record_id(page: int | None, digest: str) -> str:
    h = hashlib.md5(f"{page}:{digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def warc_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str = DATE) -> bytes:
    """One record; a revisit keeps the HTTP header with the payload's length, but not the payload."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''':/?#[]@!$&'()*+,;=%-._~''')}")
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
        lines += [f"Refers-To-Page-ID: {refers_to}"] if refers_to is not None else []
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def zip_archive(members: list[bytes], pages: list[int | None], comment: bytes = b"", zip64: bool = False) -> bytes:
    """A ZIP of stored members: the records, their index and a description."""
    out, offset, lines = io.BytesIO(), 0, []
    for page, member in zip(pages, members, strict=True):
        lines.append(f"{'-' if page is None else page} {offset} {len(member)}\n")
        offset += len(member)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as box:
        for name, parts in ((MEMBER, members), (INDEX, [line.encode() for line in lines])):
            with box.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                for p in parts:
                    f.write(p)
        about = {"profile": "data-package", "resources": [{"path": MEMBER, "records": len(members)}, {"path": INDEX}]}
        box.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps(about))
        box.comment = comment
    return out.getvalue()


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to, is_revisit): of equal payloads of ``least_bytes`` or more the largest page_id is
    the response (each of several rows with it) and the others revisit it; null html is empty."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keys = rows.select("page_id", F.octet_length("html").alias("n"), F.sha1(F.col("html").cast("binary")).alias("digest")).where(F.col("n") >= least_bytes)
    heads = keys.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1")
    again = keys.join(heads, ["digest", "n"]).where("not (page_id <=> refers_to)").select(F.col("page_id").alias("again"), "refers_to", "digest").distinct()
    # a page_id may stand on several rows with different payloads, so the payload decides with it
    same = (F.col("page_id").eqNullSafe(F.col("again"))) & (F.sha1(F.col("html").cast("binary")) == F.col("digest"))
    return rows.join(again, same, "left").select("page_id", "url", "html", "refers_to", F.col("digest").isNotNull().alias("is_revisit"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, least_bytes: int = REVISIT_BYTES, date: str = DATE) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) into ZIP archives below ``path``.

    An archive is one row of Spark's text writer, so it is committed like any output of a task, on any file system
    Spark can write.  The writer ends a row with a line end; the ZIP counts it as its comment.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[bytes] = []
        ids: list[int | None] = []
        size = 0

        def archive() -> pa.RecordBatch:
            box = zip_archive(members, ids, comment=b"\n")[:-1]
            return pa.RecordBatch.from_arrays([pa.array([box], pa.binary())], names=["content"])

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page, url, html, refers_to, revisit = (x.as_py() for x in row)
                member = gzip_member(warc_record(page, url, html.encode("utf-8", "surrogatepass"), refers_to, revisit, date))
                members.append(member)
                ids.append(page)
                size += len(member)
                if size >= archive_bytes:
                    yield archive()
                    members, ids, size = [], [], 0
        if members:
            yield archive()

    boxes = with_revisits(pages, least_bytes).mapInArrow(work, "content binary")
    text = boxes.select(F.col("content").cast("string").alias("value"))  # the bytes stay as they are
    text.write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


# ---------------------------------------------------------------------------------------------- reading by ranges


class Ranges:
    """A file read by ranges, through the file system its address names, or bytes at hand."""

    def __init__(self, path: str, content: bytes | None = None):
        self.content, self.file = content, None
        if content is None:
            system, inside = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", path)))
            self.file = system.open_input_file(inside)
        self.size = len(content) if content is not None else self.file.size()

    def read(self, start: int, size: int) -> bytes:
        if start < 0 or start + size > self.size:
            raise ValueError("a range lies outside of the archive")
        return self.content[start : start + size] if self.content is not None else self.file.read_at(size, start)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


@dataclass
class Member:
    name: str
    method: int
    size: int  # stored bytes
    header: int  # place of the local header

    def start(self, box: Ranges) -> int:
        """Where the member's bytes begin: the local header has its own name and extra fields."""
        local = box.read(self.header, 30)
        if local[:4] != b"PK\3\4":
            raise ValueError(f"no local header for {self.name}")
        name, extra = struct.unpack("<HH", local[26:30])
        return self.header + 30 + name + extra


def central_directory(box: Ranges) -> list[Member]:
    """All members, from the end record, the ZIP64 end record if it is needed, and the central directory."""
    tail_start = max(0, box.size - 22 - 0xFFFF)
    tail = box.read(tail_start, box.size - tail_start)
    at = len(tail)
    while True:  # a comment may hold the mark: the true record's comment ends the file
        at = tail.rfind(b"PK\5\6", 0, at + 3 if at < len(tail) else at)
        if at < 0:
            raise ValueError("no end of a ZIP directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack("<H", tail[at + 20 : at + 22])[0] == len(tail):
            break
    end = tail_start + at
    count, size, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    shift = end - size - start  # bytes before the archive, as in a self-extracting one
    if count == 0xFFFF or 0xFFFFFFFF in (size, start):
        locator = box.read(end - 20, 20)
        if locator[:4] == b"PK\6\7":
            place = struct.unpack("<Q", locator[8:16])[0]
            record = box.read(place, 56)
            if record[:4] != b"PK\6\6":
                raise ValueError("no ZIP64 end record")
            count, size, start = struct.unpack("<QQQ", record[32:56])
            shift = 0
    data, at, members = box.read(start + shift, size), 0, []
    for _ in range(count):
        if data[at : at + 4] != b"PK\1\2":
            raise ValueError("the central directory is broken")
        method = struct.unpack("<H", data[at + 10 : at + 12])[0]
        stored, full = struct.unpack("<II", data[at + 20 : at + 28])
        name, extra, comment = struct.unpack("<HHH", data[at + 28 : at + 34])
        header = struct.unpack("<I", data[at + 42 : at + 46])[0]
        fields = data[at + 46 + name : at + 46 + name + extra]
        while len(fields) >= 4:
            tag, width = struct.unpack("<HH", fields[:4])
            if tag == 1:  # ZIP64: only what did not fit, in this order
                values = iter(struct.unpack(f"<{width // 8}Q", fields[4 : 4 + width // 8 * 8]))
                full = next(values) if full == 0xFFFFFFFF else full
                stored = next(values) if stored == 0xFFFFFFFF else stored
                header = next(values) if header == 0xFFFFFFFF else header
            fields = fields[4 + width :]
        members.append(Member(data[at + 46 : at + 46 + name].decode("utf-8", "replace"), method, stored, header + shift))
        at += 46 + name + extra + comment
    return members


def index_line(line: str, letters: list[str] | None) -> tuple[str | None, int, int] | None:
    """(archive's name, offset, size) of one index line; None where the line does not say it.

    ``letters`` are those of the index's own head line (V: offset, S: size, g: file).  Without one a line of eleven
    fields has the customary order, a line with a JSON object names its fields, and other lines end in offset and size.
    """
    try:
        if letters is not None:
            fields = dict(zip(letters, line.split(), strict=True))
            return fields.get("g"), int(fields["V"]), int(fields["S"])
        if line.rstrip().endswith("}"):
            fields = json.loads(line[line.index("{") :])
            return fields.get("filename"), int(fields["offset"]), int(fields["length"])
        fields = line.split()
        if len(fields) == 11:
            return fields[10], int(fields[9]), int(fields[8])
        return None, int(fields[-2]), int(fields[-1])
    except (ValueError, KeyError, IndexError, TypeError):
        return None


def _indexed(box: Ranges, index: Member) -> Iterator[tuple[str | None, int, int] | None]:
    data, letters = box.read(index.start(box), index.size), None
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    for n, line in enumerate(data.decode("utf-8", "replace").splitlines()):
        if n == 0 and line.split()[:1] == ["CDX"]:
            letters = line.split()[1:]
        elif line.strip() and not line.startswith("!"):
            yield index_line(line, letters)


def record_ranges(box: Ranges) -> Iterator[tuple[int, int]]:
    """(start, size) in the file of every record of every stored archive member.

    An index is believed for an archive only if its lines lie side by side and fill the member: one that leaves
    records out (as most do with descriptions and requests), or that cannot be read, makes the member be walked.
    """
    members = central_directory(box)
    indexes = [m for m in members if m.name.startswith("indexes/") and re.search(r"\.cdxj?(\.gz)?$", m.name) and m.method == 0]
    archives = [m for m in members if m.name.startswith("archive/") and m.name.endswith((".warc.gz", ".warc"))]
    named = {m.name.rsplit("/", 1)[-1]: [] for m in archives}
    for index in indexes:
        for found in _indexed(box, index):
            name = found and (found[0].rsplit("/", 1)[-1] if found[0] else next(iter(named)) if len(named) == 1 else None)
            if name in named:
                named[name].append(found[1:])
    for archive in archives:
        if archive.method != 0:
            raise ValueError(f"{archive.name} is not stored")
        start, at = archive.start(box), 0
        lines = sorted(set(named[archive.name.rsplit("/", 1)[-1]]))
        for offset, size in lines:
            at = at + size if offset == at and size > 0 else -1
        if lines and at == archive.size:
            yield from ((start + offset, size) for offset, size in lines)
        else:
            yield from _walked(box, start, archive.size, archive.name.endswith(".gz"))


def _walked(box: Ranges, start: int, size: int, packed: bool) -> Iterator[tuple[int, int]]:
    """Ranges of the records of a member without an index."""
    at, end = start, start + size
    while at < end:
        begin = at
        if packed:
            unpack = zlib.decompressobj(31)
            while not unpack.eof:
                if at >= end:
                    raise ValueError("a record is cut off")
                part = box.read(at, min(READ_BYTES, end - at))
                unpack.decompress(part)
                at += len(part) - len(unpack.unused_data)
        else:
            head = b""
            while b"\r\n\r\n" not in head:
                if at + len(head) >= end:
                    raise ValueError("a record is cut off")
                head += box.read(at + len(head), min(1 << 14, end - at - len(head)))
            length = re.search(rb"(?im)^Content-Length:\s*(\d+)", head)
            at += head.index(b"\r\n\r\n") + 4 + int(length[1]) + 4
        yield begin, at - begin


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("a header has no end")
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, v in pairs}, rest


def parse_record(data: bytes) -> dict:
    """Fields of one record, packed or not; a response's payload must have the digest its header names."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, 31)
    if not data.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc, rest = _headers(data)
    block = rest[: int(warc["content-length"])]
    kind = warc["warc-type"]
    row = {"page_id": _number(warc.get("page-id")), "url": warc.get("warc-target-uri"), "record_type": kind}
    row["refers_to"] = _number(warc.get("refers-to-page-id"))
    # only these hold a message of the protocol; others (descriptions, requests, lookups) are their own payload
    message = kind in ("response", "revisit") and "http" in warc.get("content-type", "application/http").lower()
    http, payload = _headers(block) if message and block else ({}, block)
    named = warc.get("warc-payload-digest", "").removeprefix("sha1:")
    if len(named) == 32:  # the customary base 32
        named = base64.b32decode(named.upper()).hex()
    if kind == "revisit":
        row |= {"payload_bytes": _number(http.get("content-length")), "payload_digest": named.lower() or None, "payload": None}
    else:
        digest = hashlib.sha1(payload).hexdigest()
        if named and digest != named.lower():
            raise ValueError(f"the payload of page {row['page_id']} does not have the digest of its record")
        row |= {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload}
    return row


def _number(text: str | None) -> int | None:
    return int(text) if text is not None else None


_ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
_RANGED = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest[, payload]) of all records below ``path``.

    Spark lists the files; tasks read directories, indexes and then records by ranges.  Records are dealt out by the
    part of the archive they lie in, so one large archive keeps many tasks busy.  Where Arrow knows no file system
    for the address, Spark hands over the files whole.  A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").load(path)
    scheme = re.match(r"([a-z0-9+.-]+):", path)
    ranged = (scheme[1] if scheme else "file") in _RANGED
    row = pa.schema([*_ROW, ("payload", pa.binary())]) if with_payload else _ROW
    out = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string" + (", payload binary" if with_payload else "")

    def rows(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{k: v for k, v in parse_record(r).items() if k in row.names} for r in records], row)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                box = Ranges(name)
                found = list(record_ranges(box))
                box.close()
                columns = [pa.array([name] * len(found)), pa.array([s for s, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "start", "size"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, opened, have, data = None, None, 0, b""
        for batch in batches:  # by path and place, so neighbours share a read
            todo = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            records: list[bytes] = []
            for at, (name, start, size) in enumerate(todo):
                if name != opened:
                    if box is not None:
                        box.close()
                    box, opened, have, data = Ranges(name), name, 0, b""
                if not have <= start <= start + size <= have + len(data):
                    stop = start + size
                    for other, s, n in todo[at + 1 :]:
                        if other != name or s != stop or s + n - start > READ_BYTES:
                            break
                        stop = s + n
                    have, data = start, box.read(start, stop - start)
                records.append(data[start - have : start - have + size])
                if sum(map(len, records)) > READ_BYTES:
                    yield rows(records)
                    records = []
            if records:
                yield rows(records)
        if box is not None:
            box.close()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                box = Ranges("", content.as_py())
                yield rows([box.read(s, n) for s, n in record_ranges(box)])

    if not ranged:
        return files.select("content").mapInArrow(whole, out)
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]  # lengths only
    part = max(LEAST_BYTES, min(TASK_BYTES, total // (4 * spark.sparkContext.defaultParallelism)))
    places = files.select("path").mapInArrow(locate, "path string, start long, size long")
    # a stated number of partitions: what travels here is short, and must not be put together by its own size
    dealt = places.repartition(total // part + 1, "path", F.floor(F.col("start") / part)).sortWithinPartitions("path", "start")
    return dealt.mapInArrow(fetch, out)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read all records back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, **options)
    return read_archives(spark, path)


ORACLE = """with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, strlen(h) as payload_bytes, sha1(h) as payload_digest from p),
r as (select *, max(page_id) over (partition by payload_digest) as head from q)
select page_id, payload_bytes, payload_digest,
 case when payload_bytes >= 1000 and page_id <> head then 'revisit' else 'response' end as record_type,
 case when payload_bytes >= 1000 and page_id <> head then head end as refers_to from r"""
