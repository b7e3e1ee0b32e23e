"""Secret scans: patterns first, then structural confirmation of encoded candidates.

Base kinds are plain patterns (``assign``, ``access``, ``hex``).  Longer base64 and hex runs and
dotted tokens are only candidates: they are decoded and reported when the bytes parse, lengths
nested exactly, as a private key (PKCS#8, PKCS#1, SEC 1 or OpenSSH) or, for dotted tokens, as a
signed token whose header names its algorithm and whose signature has that algorithm's length.  A key in
DER states its own length, so it is also found wrapped over lines, quoted, or behind other text in a
run; decoded text is searched for keys between marks; an encrypted key with header lines has to fill
whole cipher blocks.

Null and empty texts have no spans.  Offsets are code points of the text, ends exclusive.  All of
it is one column expression: every text is read whole and nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import prepared, whole_text

# The three base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("pem_key", "der_key", "ssh_key", "signed_token")

# Between the marks: header lines, then base64, white space and, as in JSON and source text, escaped line
# ends and slashes, the quotes that join the lines of a string or list, and marks of quoted or commented
# lines.  Possessive, so every body is read once.
_ESCAPE = r"\\++(?:[nr]|(?=/))"
_JOIN = r"""\\*+["'][\s\\]*+(?:[+.,][\s\\]*+)?["']|[>#|;*]++"""
_HEADER = r"""[A-Z][A-Za-z0-9-]{1,40}:[^\n\r\\"']{1,200}+"""
_PEM = re.compile(rf"-----BEGIN ((?:[A-Z0-9]{{1,12}} ){{0,3}}PRIVATE KEY)-----((?:(?:\s|{_ESCAPE}|{_JOIN})*+{_HEADER})*+)"
                  rf"((?:[A-Za-z0-9+/=\s]++|{_ESCAPE}|{_JOIN})*+)-----END \1-----")
_NOT_BODY = re.compile(rf"{_ESCAPE}|{_JOIN}")
_DER_START = re.compile(r"(?<![A-Za-z0-9])M[A-P][A-Za-z0-9+/_-]{6}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_LINE_END = re.compile(r"(?:\s|\\++[nr]|[>#|;*])*+")
_DER_LEAST, _DER_MOST = 24, 1 << 16  # bytes of a private key
_B64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{60,}(?![0-9A-Fa-f])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(e[yw][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}


def _unbase64(s: str) -> bytes | None:
    s = "".join(s.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, start: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill ``data[start:end]`` exactly, else None."""
    end = len(data) if end is None else end
    out, at = [], start
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            size = int.from_bytes(data[at:at + width], "big")
            at += width
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one private key: PKCS#8 (also encrypted), PKCS#1 or SEC 1."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = der_items(data, *outer[0][1:])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]
    inner = [der_items(data, *p[1:]) if p[0] == 0x30 else None for p in parts]
    version = int.from_bytes(data[parts[0][1]:parts[0][2]], "big") if tags[0] == 0x02 else None
    if tags[:3] == [0x02, 0x30, 0x04] and version in (0, 1):
        return bool(inner[1]) and inner[1][0][0] == 0x06
    if tags == [0x02] * 9 and version in (0, 1):
        return all(p[2] > p[1] for p in parts)
    if tags[:2] == [0x02, 0x04] and version == 1:
        return 16 <= parts[1][2] - parts[1][1] <= 66 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return tags == [0x30, 0x04] and bool(inner[0]) and inner[0][0][0] == 0x06 and len(inner[0]) == 2


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key file's body."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size:at]

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 16 or any(not field() for _ in range(keys)):
        return False
    return bool(field()) and at == len(data)


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether three dotted parts are a signed token."""
    try:
        head, body = (json.loads((_unbase64(x) or b"").decode("utf-8")) for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    sign = _unbase64(signature)
    if sign is None or (not sign) != (head["alg"].lower() == "none"):
        return False
    return not sign or len(sign) == _SIGNATURE_BYTES.get(head["alg"], len(sign))


def _is_pem_key(headers: str, body: str) -> bool:
    data = _unbase64(_NOT_BODY.sub("", body)) or b""
    if "ENCRYPTED" in headers and "DEK-Info" in headers:
        return len(data) >= 32 and len(data) % 8 == 0
    return is_der_key(data) or is_ssh_key(data)


def _der_end(text: str, start: int) -> int | None:
    """The end of the base64 text of a DER key that starts here, over line ends, as long as it says."""
    head = _unbase64(text[start:start + 8])
    if head is None:
        return None
    size, width = head[1], 0
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4:
            return None
        size = int.from_bytes(head[2:2 + width], "big")
    size += 2 + width
    if not _DER_LEAST <= size <= _DER_MOST:
        return None
    need, got, at = -(-size * 4 // 3), [], start
    while need > 0:
        m = _RUN.match(text, at)
        if not m:
            return None
        got.append(m[0][:need])
        need -= len(got[-1])
        at += len(got[-1])
        if need > 0:
            gap = _LINE_END.match(text, at).end()
            if not 0 < gap - at <= 64:
                return None
            at = gap
    if not is_der_key((_unbase64("".join(got)) or b"")[:size]):
        return None
    while text[at:at + 1] == "=" and at < len(text):
        at += 1
    return at


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) sorted by start, then by the kinds' order, then by end."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "-----BEGIN" in text:
        out += [("pem_key", *m.span()) for m in _PEM.finditer(text) if _is_pem_key(m[2], m[3])]
    marked = [s[1:] for s in out if s[0] == "pem_key"]
    for m in _B64.finditer(text):
        data = _unbase64(m[0])
        if data and data[:1] == b"\x30" and is_der_key(data):
            out.append(("der_key", *m.span()))
        elif data and is_ssh_key(data):
            out.append(("ssh_key", *m.span()))
        elif data and b"-----BEGIN" in data and any(_is_pem_key(k[2], k[3]) for k in _PEM.finditer(data.decode("latin-1"))):
            out.append(("pem_key", *m.span()))
    known = {s[1] for s in out if s[0] == "der_key"}
    for m in _DER_START.finditer(text):
        if m.start() not in known and not any(a <= m.start() < b for a, b in marked):
            end = _der_end(text, m.start())
            if end is not None:
                out.append(("der_key", m.start(), end))
    for m in _HEX_BYTES.finditer(text):
        if m[0][:2] == "30" and len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
            out.append(("der_key", *m.span()))
    if "." in text and ("ey" in text or "ew" in text):
        out += [("signed_token", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(*m.groups())]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(out), key=lambda s: (s[1], order[s[0]], s[2]))


def secret_spans(text: str | Column = "text") -> Column:
    """array<struct<kind, start, end>> of a text column, in the order of ``find_secrets``."""

    def spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in texts],
                            dtype=object)

    spans.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(spans, "array<struct<kind:string,start:bigint,end:bigint>>")(whole_text(text))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns; every run of overlapping spans is replaced by ``mark``.

    Texts without a span, null among them, stay as they are.
    """
    prepared(docs.sparkSession)

    def redacted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([_redacted(t, mark) for t in texts], dtype=object)

    redacted.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(text, F.pandas_udf(redacted, "string")(F.col(text)))


def _redacted(text: str | None, mark: str) -> str | None:
    spans = find_secrets(text)
    if not spans:
        return text
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def of_kinds(spans: str | Column, kinds) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def joined(spans: str | Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    c = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, secrets): one row per row of ``docs``."""
    prepared(docs.sparkSession)
    return docs.select(F.col(key), secret_spans(text).alias("secrets"))
