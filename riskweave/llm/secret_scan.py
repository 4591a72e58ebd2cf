"""Operator 4: secrets, with structural confirmation.

Base spans are plain matches of three kinds: assignments of passwords and
tokens, access-key ids, and long hex runs. The method then takes every long
base64 or hex run, also one wrapped over lines, as a candidate, decodes it, and
reports it only if the bytes have the structure of a secret: a signed token
whose header names an algorithm, a DER private key whose nested lengths add up,
an OpenSSH private key whose length-prefixed fields do, or a text that itself
holds a secret, plain or encoded again, at most ``DEPTH`` layers down. A PEM
block counts if its body is such a key or, with encryption headers, names a
cipher and start value and holds whole cipher blocks. Base spans stay whatever
the method finds.

Results by case: null and empty texts have no spans. Offsets count code points,
ends are exclusive. Confirmed spans do not overlap each other. Repeated rows get
equal results; extra columns are ignored. Time grows in proportion to the text.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "openssh", "nested")
#: Fixed patterns. Short runs can't match the hex and access rules, so their lengths are in the patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE = 8
#: The shortest base secret, token= and eight characters, has 14 bytes: 19 characters of base64, 28 of hex.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}={0,2}")
HEX_ANY = re.compile(r"[0-9A-Fa-f]{28,}")
#: Encodings inside encodings are followed this far; deeper ones are not reported.
DEPTH = 4
#: A base64 run that ends its line, before a line that is nothing but base64; and such a line.
LINE_END = re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{8,})[ \t]*\r?\n(?=[ \t]*[A-Za-z0-9+/_-]+={0,2}[ \t]*(?:\r?\n|\Z))")
WHOLE_LINE = re.compile(r"[ \t]*([A-Za-z0-9+/_-]+)(={0,2})[ \t]*(?:\r?\n|\Z)")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
CIPHER = re.compile(r"DEK-Info: [A-Z0-9-]+,(?:[0-9A-Fa-f]{2}){8,}\s*$", re.M)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """The matches of the three base kinds, each leftmost and non-overlapping."""
    found: list[Span] = []
    low = text.lower()
    if any(hint in low for hint in HINTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def decode64(run: str) -> bytes | None:
    """The bytes of a base64 run in either alphabet, padded or not."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


def wrapped_runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """The line spans of base64 that goes on over lines: any start, lines of one width, a last one no wider."""
    at = 0
    while m := LINE_END.search(text, at):
        spans, at, width = [m.span(1)], m.end(), None
        while line := WHOLE_LINE.match(text, at):
            n = line.end(2) - line.start(1)
            if width is not None and n > width:
                break
            spans.append((line.start(1), line.end(2)))
            at = line.end()
            if line[2] or width is not None and n < width:
                break
            width = n
        yield spans
        at = spans[-1][0]  # the last line may begin another run


def wrapped_choices(spans: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """A run without a word above it or below it that only looks like part of it, the longest first."""
    last = len(spans)
    for end in sorted({last, last - 1, 2}, reverse=True):
        for start in (0, 1):
            if end - start >= 2:
                yield spans[start:end]


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) items that fill ``data`` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            width = n & 0x7F
            if not 0 < width <= 4 or at + width > len(data):
                return None
            n, at = int.from_bytes(data[at : at + width], "big"), at + width
        if at + n > len(data):
            return None
        items.append((tag, data[at : at + n]))
        at += n
    return items


def is_der_key(data: bytes) -> bool:
    """PKCS#1, PKCS#8 (also encrypted) or SEC1: one sequence whose parts have the right tags and lengths."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = der_items(outer[0][1])
    if not parts:
        return False
    tags = [tag for tag, _ in parts]
    if tags[:9] == [0x02] * 9 and len(parts) in (9, 10):
        return True
    if tags[:3] == [0x02, 0x30, 0x04] and (oid := der_items(parts[1][1])) and oid[0][0] == 0x06:
        return len(parts[2][1]) > 0
    if tags[:2] == [0x02, 0x04] and parts[0][1] == b"\x01" and 16 <= len(parts[1][1]) <= 66:
        return True
    return tags == [0x30, 0x04] and bool(oid := der_items(parts[0][1])) and oid[0][0] == 0x06 and len(parts[1][1]) >= 16


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, kdf, options, the number of keys, and as many public keys and one private blob."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for place in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        if at > len(data) or place == 0 and at == len(magic) + 4:
            return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 0 < keys <= 16:
        return False
    for _ in range(keys + 1):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        if at > len(data):
            return False
    return True


def is_signed_token(token: str) -> bool:
    """A header object that names its algorithm, a payload object, and a signature unless the algorithm is none."""
    head, body, sign = token.split(".")
    for part, wanted in ((head, "alg"), (body, None)):
        data = decode64(part)
        try:
            value = json.loads(data) if data else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or wanted and not isinstance(value.get(wanted), str):
            return False
        if wanted:
            unsigned = value[wanted].lower() == "none"
    return unsigned or bool(sign) and decode64(sign) is not None


def _kind_of(data: bytes | None, depth: int) -> str | None:
    """The kind of secret that decoded bytes are, or None."""
    if not data:
        return None
    if is_der_key(data):
        return "der"
    if is_openssh_key(data):
        return "openssh"
    try:
        inside = data.decode()
    except UnicodeDecodeError:
        return None
    if not inside.translate(BLANKS).isprintable():
        return None
    if any(kind != "hex" for *_, kind in base_spans(inside)):
        return "nested"
    return "nested" if depth < DEPTH and confirmed_spans(inside, depth + 1) else None


BLANKS = str.maketrans("\t\n\r", "   ")


def is_pem_body(body: str) -> bool:
    """The lines between the markers: a key, or an encrypted one with its headers."""
    headers, blank, rest = body.replace("\r", "").partition("\n\n")
    if ":" not in headers:
        data = decode64("".join(body.split()))
        return bool(data) and (is_der_key(data) or is_openssh_key(data))
    data = decode64("".join(rest.split())) if blank else None
    return bool(data) and len(data) >= 16 and len(data) % 8 == 0 and "ENCRYPTED" in headers and bool(CIPHER.search(headers))


def pem_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Each end marker with the nearest begin marker of its label before it, if no other marker lies between."""
    begun: re.Match | None = None
    for m in PEM.finditer(text):
        if m[1] == "END" and begun and begun[2] == m[2] and is_pem_body(text[begun.end() : m.start()]):
            yield begun.start(), m.end()
        begun = m if m[1] == "BEGIN" else None


class Taken:
    """Disjoint spans by start, for lookups in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.spans = sorted(spans)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.spans, (end, 0))
        return at == 0 or self.spans[at - 1][1] <= start

    def add(self, start: int, end: int) -> None:
        insort(self.spans, (start, end))


def confirmed_spans(text: str, depth: int = 1) -> list[Span]:
    """Candidates whose decoded bytes have the structure of a secret; the first kind that fits counts."""
    found: list[Span] = []
    if "PRIVATE KEY-----" in text:
        found += [(a, b, "pem") for a, b in pem_blocks(text)]
    taken = Taken([(a, b) for a, b, _ in found])
    if "eyJ" in text:
        tokens = [m for m in TOKEN.finditer(text) if taken.free(*m.span()) and is_signed_token(m[0])]
        found += [(m.start(), m.end(), "jwt") for m in tokens]
        for m in tokens:
            taken.add(*m.span())

    def report(start: int, end: int, data: bytes | None) -> bool:
        if kind := _kind_of(data, depth):
            found.append((start, end, kind))
            taken.add(start, end)
        return kind is not None

    for spans in wrapped_runs(text):
        for part in wrapped_choices(spans):
            start, end = part[0][0], part[-1][1]
            if taken.free(start, end) and report(start, end, decode64("".join(text[a:b] for a, b in part))):
                break
    for m in BASE64.finditer(text):
        if taken.free(*m.span()):
            report(*m.span(), decode64(m[0]))
    for m in HEX_ANY.finditer(text):  # a letter beside the run may belong to it: both alignments are tried
        for start in (m.start(), m.start() + 1):
            end = m.end() - (m.end() - start) % 2
            if taken.free(start, end) and report(start, end, bytes.fromhex(text[start:end])):
                break
    return found


def listed(spans: list[Span]) -> str:
    """kind:start:end by start, then kind as listed, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the base counts, base_sha256 and all spans as kind:start:end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                kinds = [k for *_, k in base]
                row = (*map(kinds.count, KINDS[:3]), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + confirmed_spans(text)))
                for column, cell in zip(columns, row, strict=True):
                    column.append(cell)
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
