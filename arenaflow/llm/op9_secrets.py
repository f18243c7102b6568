"""Operator 9, secret scans with structural confirmation.

Base patterns report assignments, access keys and hex runs.  Further candidates
(base64 and hex runs, PEM blocks, dotted tokens) are reported only after their
structure is confirmed: the text is decoded and the encoding of a key, its
nested lengths, or the header of a signed token must parse.

Kinds, in the order used for ties: assign, access, hex, pem, jwt, der, openssh.
Positions are code points, end exclusive.  Defined cases: a NULL text counts as
empty; texts are scanned whole; matches that fail a length test are dropped
after they have consumed their characters (leftmost, non-overlapping per kind);
repeated rows each get their row; an empty table gives an empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.llm.common import map_rows

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # greedy and leftmost: the maximal runs of 16 or more
KINDS = ("assign", "access", "hex", "pem", "jwt", "der", "openssh")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s]|\\+[nr])+)-----END \1-----")
ESCAPED_BREAK = re.compile(r"\\+[nr]")  # as in JSON strings
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
BASE64 = re.compile(r"[A-Za-z0-9+/]{32,}={0,2}")
# Candidates of the last two kinds start, anywhere in a run, like an encoded key: a DER
# sequence (byte 0x30, whose length tells the end), or the key file's magic word.
DER_START, DER_HEX, HEX_RUN = re.compile(r"(?=M[A-P])"), re.compile(r"(?=30)"), re.compile(r"[0-9A-Fa-f]{64,}")
OPENSSH_START = "b3BlbnNzaC1rZXkt"
OPENSSH_MAGIC = b"openssh-key-v1\0"
SIGNATURES = re.compile(r"(HS|RS|ES|PS)(256|384|512)|EdDSA|none")

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
     T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
     T.StructField("n_confirmed", T.LongType())]
)


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the items that fill ``data[at:end]`` exactly, else ``None``."""
    items = []
    while at < end:
        if at + 2 > end:
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n >= 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > end:
                return None
            n, at = int.from_bytes(data[at : at + size], "big"), at + size
            if n < 0x80:
                return None  # DER asks for the shortest form
        if at + n > end:
            return None
        items.append((tag, at, at + n))
        at += n
    return items


def is_der_key(data: bytes) -> bool:
    """One sequence that fills the data, whose items nest exactly, starting as keys
    do: a version number or an algorithm (a sequence with an object identifier)."""
    outer = der_items(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30 or len(data) < 32:
        return False
    inner = der_items(data, *outer[0][1:])
    if not inner or len(inner) < 2:
        return False
    tag, start, end = inner[0]
    if tag == 0x02 and end - start == 1 and data[start] <= 3:  # version, then numbers, an algorithm or the key's octets
        return inner[1][0] in (0x02, 0x04, 0x30)
    if tag == 0x30:
        algorithm = der_items(data, start, end)
        return bool(algorithm) and algorithm[0][0] == 0x06 and inner[1][0] in (0x03, 0x04)
    return False


def is_openssh_key(data: bytes) -> bool:
    """The magic word, then cipher, derivation and options as length-prefixed strings, then the number of keys."""
    if not data.startswith(OPENSSH_MAGIC):
        return False
    at = len(OPENSSH_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 16


def der_size(head: bytes) -> int | None:
    """Bytes of the item that starts with ``head`` (six bytes or more), with its tag and length."""
    n = head[1]
    if n < 0x80:
        return 2 + n
    size = n & 0x7F
    return 2 + size + int.from_bytes(head[2 : 2 + size], "big") if 1 <= size <= 4 else None


def der_spans(run: str, starts: re.Pattern, decode, bits: int) -> list[tuple[int, int]]:
    """(start, end) of the keys in a run of characters of ``bits`` bits each, from the left, not overlapping."""
    found, free = [], 0
    for m in starts.finditer(run):
        at = m.start()
        if at < free or 8 * 32 > bits * (len(run) - at) or not (head := decode(run[at : at + 48 // bits])) or len(head) < 6:
            continue
        size = der_size(head)
        if size is None or size < 32 or (end := at - (-8 * size // bits)) > len(run):
            continue
        if (data := decode(run[at:end])) and is_der_key(data):
            found.append((at, end))
            free = end
    return found


def decoded(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(text: str) -> bool:
    """A dotted token whose header names a signature algorithm and whose payload is an object."""
    head, body, signature = text.split(".")
    parts = []
    for part in (head, body):
        raw = decoded(part, url=True)
        try:
            parts.append(json.loads(raw) if raw is not None else None)
        except (ValueError, RecursionError):
            return False
    header, payload = parts
    if not isinstance(header, dict) or not isinstance(payload, dict):
        return False
    alg = header.get("alg")
    if not isinstance(alg, str) or not SIGNATURES.fullmatch(alg):
        return False
    return alg == "none" or decoded(signature, url=True) not in (None, b"")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base matches."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates whose structure parses."""
    found = []
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            data = decoded("".join(ESCAPED_BREAK.sub("", m[2]).split()))
            if data and (is_der_key(data) or is_openssh_key(data)):
                found.append((m.start(), 3, m.end()))
    if "eyJ" in text:
        found += [(m.start(), 4, m.end()) for m in JWT.finditer(text) if is_signed_token(m[0])]
    blocks = [(a, b) for a, k, b in found if k == 3]
    for m in BASE64.finditer(text):
        run, at = m[0], m.start()
        if any(a <= at < b for a, b in blocks):
            continue
        body = run.rstrip("=")
        start = body.find(OPENSSH_START)
        if start >= 0:
            size = len(body) - start
            data = decoded(body[start : start + size - (size % 4 == 1)])
            if data and is_openssh_key(data):
                found.append((at + start, 6, m.end()))
                body = body[:start]
        found += [(at + a, 5, m.end() if b == len(body) == len(run.rstrip("=")) else at + b) for a, b in der_spans(body, DER_START, decoded, 6)]
        for h in HEX_RUN.finditer(body):
            found += [(at + h.start() + a, 5, at + h.start() + b) for a, b in der_spans(h[0], DER_HEX, bytes.fromhex, 4)]
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secret_row(doc_id, text: str | None) -> tuple:
    text = text or ""
    base, more = base_spans(text), confirmed_spans(text)
    kinds = [k for _, k, _ in base]
    return (
        doc_id, kinds.count(0), kinds.count(1), kinds.count(2),
        hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more),
    )


def secret_scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts and digest, all ``spans`` (``kind:start:end`` by start), ``n_confirmed``."""

    def start():
        return lambda row: (secret_row(*row),)

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), start, SCHEMA)
