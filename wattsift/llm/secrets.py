"""Secrets in texts: three plain patterns, and keys and signed tokens that are reported only if their structure holds.

A run of base64 or hex characters is decoded and parsed: nested DER lengths must fill their parents and form a private
key, the length-prefixed fields of an OpenSSH key must add up, a signed token's header and payload must be JSON objects
and the header must name an algorithm.  Every text is searched whole; cheap substring tests, which cannot miss a match,
decide which patterns have to run on it.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattsift.llm.words import text_rows

KINDS = ("assign", "access", "hex", "key", "token")  # the order of kinds that start at the same place
BASE_KINDS = KINDS[:3]

ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{24,}")
PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]++|-(?!----(?:BEGIN|END) ))*+)-----END \1-----")
WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/_-])(?:(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]{0,76}={0,2}|[A-Za-z0-9+/_-]{40,}={0,2})")
HEX_BYTES = re.compile(rb"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
TOKEN = re.compile(rb"(?<![A-Za-z0-9_-])(e[yw][A-Za-z0-9_-]+)\.(e[yw][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")

#: How source code and JSON write a text of several lines: pieces of strings, line ends and base64 signs as escapes.
_PIECES = re.compile(rb"""(?<!\\)\\*+["'][\s+.,\\]*+["']""")
_ESCAPE = re.compile(rb"(?<!\\)\\++(?:([nr])|u00(0a|0d|2b|2f|3d)|(?=[/\r\n]))", re.I)
_HEX_RUN = bytes(104 if chr(c) in "0123456789abcdefABCDEF" else 32 for c in range(256))
_BASE64_RUN = bytes(98 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 32 for c in range(256))


class Span(NamedTuple):
    kind: str
    start: int  # code points
    end: int  # exclusive
    form: str  # what the structure is; empty for the plain patterns


# ---------------------------------------------------------------------------------------------- structures


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of consecutive DER values that fill ``data`` exactly; None if any length does not hold."""
    items, at, n = [], 0, len(data)
    while at < n:
        if at + 2 > n or data[at] & 0x1F == 0x1F:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > n:
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
            if size < 0x80 or size >> 8 * (width - 1) == 0:  # not the shortest form
                return None
        if at + size > n:
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def key_form(data: bytes) -> str:
    """Which private key ``data`` encodes; empty if none."""
    if data.startswith(b"openssh-key-v1\0"):
        return "openssh" if _ssh_fields(data[15:]) else ""
    outer = der_items(data) if data[:1] == b"\x30" else None
    inner = der_items(outer[0][1]) if outer and len(outer) == 1 else None
    if not inner:
        return ""
    tags = [t for t, _ in inner]
    if tags[:3] == [0x02, 0x30, 0x04] and inner[0][1] in (b"\0", b"\1") and (kind := der_items(inner[1][1])) and kind[0][0] == 0x06:
        return "pkcs8" if inner[2][1] else ""
    if len(tags) >= 9 and set(tags[:9]) == {0x02} and inner[0][1] in (b"\0", b"\1") and len(inner[1][1]) >= 32:
        return "rsa"
    if tags == [0x02] * 6 and inner[0][1] == b"\0":
        return "dsa"
    if tags[:2] == [0x02, 0x04] and inner[0][1] == b"\1" and len(inner[1][1]) >= 20 and set(tags[2:]) <= {0xA0, 0xA1}:
        return "ec" if all(der_items(c) for _, c in inner[2:]) else ""
    if tags == [0x30, 0x04] and (kind := der_items(inner[0][1])) and kind[0][0] == 0x06 and len(kind) == 2 and kind[1][0] == 0x30 and len(inner[1][1]) >= 16:
        return "pkcs8-encrypted"
    return ""


def _ssh_fields(data: bytes) -> bool:
    """Cipher, key derivation, its options, the number of keys, public parts and the private part fill the rest."""

    def text(at: int) -> tuple[bytes, int]:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data) or at + 4 > len(data):
            raise ValueError
        return data[at + 4 : at + 4 + size], at + 4 + size

    try:
        cipher, at = text(0)
        _, at = text(at)
        _, at = text(at)
        keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if not cipher or not 1 <= keys <= 16:
            return False
        for _ in range(keys):
            public, at = text(at)
            if not 1 <= int.from_bytes(public[:4], "big") <= len(public) - 4:
                return False
        private, at = text(at)
        return bool(private) and at == len(data)
    except ValueError:
        return False


def unbase64(raw: bytes) -> bytes:
    """Decoded bytes in either alphabet, padded or not; empty if it is not base64."""
    raw = b"".join(raw.split()).rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    if len(raw) % 4 == 1:
        return b""
    try:
        return base64.b64decode(raw + b"=" * (-len(raw) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def pem_parts(raw: bytes) -> tuple[bytes, bytes]:
    """Headers and base64 of what stands between the marks, also where line ends are escapes in a string.

    Headers end at an empty line, or where there is none after the last line with a colon."""
    raw = _ESCAPE.sub(lambda m: b"\n" if m[1] else bytes.fromhex(m[2].decode()) if m[2] else b"", _PIECES.sub(b"", raw))
    lines = [x.strip() for x in raw.strip().splitlines()]
    n = max((i + 1 for i, x in enumerate(lines) if b":" in x), default=0)
    if n and b"" in lines[n:]:
        n = lines.index(b"", n)
    return b"\n".join(lines[:n]), b"\n".join(lines[n:])


def _object(raw: bytes) -> dict | None:
    try:
        value = json.loads(unbase64(raw))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def token_form(header: bytes, payload: bytes, signature: bytes) -> str:
    """The algorithm a signed token's header names; empty if the parts are not such a token."""
    head = _object(header)
    algorithm = head.get("alg") if head else None
    if not isinstance(algorithm, str) or not algorithm or _object(payload) is None:
        return ""
    return algorithm if (algorithm.lower() == "none") != bool(signature) else ""


# ---------------------------------------------------------------------------------------------- search


def _found(data: bytes, low: bytes) -> Iterator[tuple[str, int, int, str]]:
    if any(k in low for k in (b"passw", b"secret", b"token", b"apikey", b"api_key")):
        for m in ASSIGN.finditer(data):
            if m.end(1) - m.start(1) >= 6:
                yield "assign", m.start(), m.end(), ""
    if b"AKIA" in data:
        for m in ACCESS.finditer(data):
            if m.end() - m.start() >= 20:
                yield "access", m.start(), m.end(), ""
    if b"h" * 24 in (runs := data.translate(_HEX_RUN)):
        for m in HEX.finditer(data):
            yield "hex", m.start(), m.end(), ""
        if b"h" * 48 in runs:
            for m in HEX_BYTES.finditer(data):
                if form := key_form(bytes.fromhex(m[0].decode())):
                    yield "key", m.start(), m.end(), form
    del runs
    pem: list[tuple[int, int]] = []
    if b"-----BEGIN " in data:
        for m in PEM.finditer(data):
            headers, body = pem_parts(m[2])
            form = key_form(raw := unbase64(body)) or ("encrypted" if raw and b"ENCRYPTED" in headers else "")
            if form:
                pem.append(m.span())
                yield "key", m.start(), m.end(), form
    if b"b" * 40 in data.translate(_BASE64_RUN):
        for m in WRAPPED.finditer(data):
            if any(a <= m.start() < b for a, b in pem):
                continue
            whole = m[0].rstrip(b"\r\n")
            for part in (whole, whole[: max(whole.rfind(b"\n"), 0)].rstrip(b"\r")):  # the last line may be a word that follows
                if part and (form := key_form(unbase64(part))):
                    yield "key", m.start(), m.start() + len(part), form
                    break
    if b".ey" in data or b".ew" in data:
        for m in TOKEN.finditer(data):
            if form := token_form(*m.groups()):
                yield "token", m.start(), m.end(), form


def secret_spans(text: str | None) -> list[Span]:
    """All spans of one text by start, then kind; null and empty texts have none."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    found = list(_found(data, data.lower()))
    if not found:
        return []
    if len(data) != len(text):  # bytes to code points, each stretch once
        places, at, done = {}, 0, 0
        for p in sorted({x for f in found for x in f[1:3]}):
            done += sum(1 for b in data[at:p] if b & 0xC0 != 0x80)
            places[p], at = done, p
        found = [(k, places[a], places[b], form) for k, a, b, form in found]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted((Span(*f) for f in found), key=lambda s: (s.start, order[s.kind], s.end))


SPANS = "array<struct<kind: string, start: bigint, end: bigint, form: string>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("form", pa.string())]))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): one row per row of ``docs``; null and empty texts have no spans; other columns are not read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in secret_spans(t)] for _, t in text_rows(batch, key, text)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(spans, _SPANS)], names=[key, "spans"])

    rows = docs.select(key, text)
    return rows.mapInArrow(work, f"`{key}` {rows.schema[key].dataType.simpleString()}, spans {SPANS}")


def joined_spans(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined."""
    picked = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    spans = secret_spans(text)
    if not spans:
        return text
    parts, at = [], 0
    for span in spans:
        if span.start >= at:
            parts += [text[at : span.start], mark]
        at = max(at, span.end)
    return "".join(parts) + text[at:]


def redact_secrets(docs: DataFrame, text: str = "text", chars: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets replaced in ``text``; all other columns stay, ``chars`` (if there) is counted anew where
    a text has changed.  Null texts stay null."""
    fields = docs.schema.fields
    names = [f.name for f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            at = names.index(text)
            old = [t.as_py() for t in arrays[at]]
            new = [redact(t, mark) for t in old]
            arrays[at] = pa.array(new, arrays[at].type)
            if chars in names:
                n = arrays[names.index(chars)]
                counts = [len(b) if b is not a and b != a else c.as_py() for a, b, c in zip(old, new, n, strict=True)]
                arrays[names.index(chars)] = pa.array(counts, n.type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(work, docs.schema)
