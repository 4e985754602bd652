"""Operator 3, secret scans: candidates by pattern, confirmed by structure before they are reported.

Three base kinds come from patterns alone. Further kinds are reported only when the candidate's bytes parse: a
signed token's header must decode to JSON with an algorithm, and a base64 or hex key must decode to an encoding
whose nested lengths fill it exactly.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts, trimmed, tune

#: The order of kinds at one start.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, so its length decides as for the run itself
_RUN = re.compile(r"[A-Za-z0-9_.-]+")  # a maximal run of a token's characters, so each is read once
_LABEL = r"[A-Z0-9 ]{0,40}PRIVATE KEY"
_PEM = re.compile(rf"-----BEGIN ({_LABEL})-----\r?\n?((?:[A-Za-z-]{{1,40}}: [^\n]*\n)*)([A-Za-z0-9+/=\s]+)-----END ({_LABEL})-----")
_CIPHER = re.compile(r"DEK-Info: [A-Z0-9-]+,([0-9A-Fa-f]{16,32})\s")
_B64 = re.compile(r"(?<![A-Za-z0-9+/])M[A-Za-z0-9+/]{39,}={0,2}")  # a sequence tag, 0x30, starts with M
_HEXKEY = re.compile(r"(?<![0-9A-Za-z])30(?:[0-9a-fA-F]{2}){19,}(?![0-9A-Za-z])")
_SSH_MAGIC = b"openssh-key-v1\0"


def _unbase64(text: str, urlsafe: bool = False) -> bytes:
    if urlsafe:
        text = text.replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the element at a place, if its length is well formed and fits."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        wide = n & 0x7F
        if not 1 <= wide <= 4 or at + wide > end:
            return None
        n, at = int.from_bytes(data[at : at + wide], "big"), at + wide
    return (tag, at, at + n) if at + n <= end else None


def _nested(data: bytes, at: int, end: int, depth: int = 0) -> int:
    """The number of elements, if elements fill [at, end) exactly and so on within each constructed one; else 0."""
    count = 0
    while at < end:
        found = _tlv(data, at, end)
        if not found or depth > 8:
            return 0
        tag, start, at = found
        if tag & 0x20 and start < at and not _nested(data, start, at, depth + 1):
            return 0
        count += 1
    return count


def is_key_encoding(data: bytes) -> bool:
    """A tag-length-value sequence that fills data and opens with a version number or a nested sequence."""
    outer = _tlv(data, 0, len(data))
    if not outer or outer[0] != 0x30 or outer[2] != len(data) or outer[1] >= len(data) or data[outer[1]] not in (0x02, 0x30):
        return False
    return _nested(data, outer[1], outer[2]) >= 2


def is_ssh_key(data: bytes) -> bool:
    """The magic, then length-prefixed fields (cipher, derivation, options) and a count that fit."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)
    for _ in range(3):
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4 + n
        if at > len(data):
            return False
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 64


def _json(part: str) -> object:
    try:
        return json.loads(_unbase64(part, urlsafe=True))
    except (ValueError, RecursionError):
        return None


def is_signed_token(token: str) -> bool:
    """Header and payload decode to JSON objects, the header with an algorithm; the signature decodes, and is empty only for none."""
    head, body, signature = token.split(".")
    header = _json(head)
    if not isinstance(header, dict) or not isinstance(header.get("alg"), str) or not isinstance(_json(body), dict):
        return False
    return bool(_unbase64(signature, urlsafe=True)) or header["alg"].lower() == "none" and not signature


def signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of signed tokens: three dotted parts of a run, the first from its first eyJ on; a part is in one token at most."""
    for run in _RUN.finditer(text):
        parts, at, ends = run[0].split("."), run.start(), []
        for part in parts:
            ends.append(at + len(part))
            at += len(part) + 1
        k = 0
        while k + 2 < len(parts):
            cut = parts[k].find("eyJ")
            start = ends[k] - len(parts[k]) + cut
            if cut >= 0 and is_signed_token(text[start : ends[k + 2]]):
                yield start, ends[k + 2]
                k += 2
            k += 1


def is_pem_body(headers: str, body: str) -> bool:
    """Base64 of a key encoding, or, where the headers name a cipher, of whole cipher blocks."""
    data = _unbase64("".join(body.split()))
    if cipher := _CIPHER.search(headers):
        return bool(data) and len(data) % (len(cipher[1]) // 2) == 0
    return is_key_encoding(data) or is_ssh_key(data)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three base kinds, sorted."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates whose structure was confirmed."""
    found = []
    if "eyJ" in text:
        found += [(a, 3, b) for a, b in signed_tokens(text)]
    if "-----BEGIN " in text:
        found += [(m.start(), 4, m.end()) for m in _PEM.finditer(text) if m[1] == m[4] and is_pem_body(m[2], m[3])]
    found += [(m.start(), 5, m.end()) for m in _B64.finditer(text) if is_key_encoding(_unbase64(m[0]))]
    found += [(m.start(), 5, m.end()) for m in _HEXKEY.finditer(text) if is_key_encoding(bytes.fromhex(m[0]))]
    return found


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by start, then kind as listed."""
    return [(KINDS[k], a, b) for a, k, b in sorted({*base_spans(text), *confirmed_spans(text)})]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(text.as_py())] for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return per row of docs: doc_id, spans (by start, then kind as listed in KINDS).

    A span is (kind, start, end) in code points, end exclusive. One row in, one row out, so repeated rows and null
    ids are kept as they are; a null or empty text has no spans; texts of any length are scanned whole, one at a
    time; an empty table gives an empty one; other columns are not read.
    """
    tune(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(trimmed(_scan), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of all spans of every document."""
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), *counts[3:])
