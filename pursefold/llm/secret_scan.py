"""Secrets in texts: patterns, and candidates that hold what their structure claims.

Three patterns find assignments (`password = ...`), access keys and runs of hexadecimal digits; matches that are too short are
dropped after matching, as the scan goes on behind them. Runs of base64 or hexadecimal digits are decoded and reported only if
they are built like a secret throughout:

- `pem`: an armoured block, with the marker of its end next after that of its beginning, whose body is a private key;
- `key`: a run that is a private key, outside such blocks;
- `jwt`: three runs joined by dots, the first a JSON object that names an algorithm, the second a JSON object, the third of
  the length that a signature by that algorithm has.

A private key is DER whose nested lengths fill it exactly, with the members that PKCS#1, PKCS#8 (plain or encrypted), SEC 1 or
DSA give it, or OpenSSH's format, whose length-prefixed strings fill it exactly. A run is decoded from its start.
All steps are linear in the length of a text; candidates are runs that do not overlap.

A span is a kind, a start and an end (exclusive) in code points; the spans of a text are ordered by start, then by kind.
Null texts are empty and have none; repeated rows each get a row; an empty table gives none. Other columns are left alone.
"""

from __future__ import annotations

import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pursefold.llm.common import byte_texts

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "key", "jwt")

#: All patterns match ASCII only, so they are looked for in UTF-8 bytes.
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18

MARKER = re.compile(rb"-----(BEGIN|END) ([A-Z0-9 ]{1,64})-----")
RUN = re.compile(rb"[A-Za-z0-9+/_=.-]{50,}")
BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{64,}={0,2}")
ALL_HEX = re.compile(rb"(?:[0-9A-Fa-f]{2})+")
DOTTED = re.compile(rb"[A-Za-z0-9_.-]+")
URL = bytes.maketrans(b"-_", b"+/")
BLANKS = re.compile(rb"\s|\\[nr]")
#: Bytes of a signature by algorithm (RFC 7518, RFC 8037); those of RSA have the length of the key, 128 at least.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
LEAST_RSA = 128
#: Digits of the shortest header, {"alg":"HS256"}.
LEAST_HEADER = 20
INTEGER, OCTETS, OID, SEQUENCE, PARAMETERS, PUBLIC = 0x02, 0x04, 0x06, 0x30, 0xA0, 0xA1
OPENSSH = b"openssh-key-v1\0"


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and stop of the content of the DER element at a place, if it ends by `end`."""
    if end - at < 2:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        many = length - 0x80
        if not 1 <= many <= 4 or at + many > end:
            return None
        length, at = int.from_bytes(data[at : at + many]), at + many
    return (tag, at, at + length) if at + length <= end else None


def members(data: bytes, at: int, end: int, most: int = 16) -> list[tuple[int, int, int]] | None:
    """The elements that fill a range exactly."""
    found = []
    while at < end:
        one = element(data, at, end)
        if one is None or len(found) == most:
            return None
        found.append(one)
        at = one[2]
    return found


def is_der_key(data: bytes) -> bool:
    whole = element(data, 0, len(data))
    if whole is None or whole[0] != SEQUENCE or whole[2] != len(data):
        return False
    inside = members(data, *whole[1:])
    if not inside:
        return False
    tags = [tag for tag, _, _ in inside]

    def algorithm(k: int) -> bool:
        parts = members(data, *inside[k][1:])
        return bool(parts) and parts[0][0] == OID

    version = int.from_bytes(data[inside[0][1] : inside[0][2]]) if tags[0] == INTEGER else -1
    if tags in ([INTEGER] * 9, [INTEGER] * 6):  # PKCS#1 and DSA
        return version == 0
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # PKCS#8
        return version in (0, 1) and algorithm(1) and all(t in (PARAMETERS, PUBLIC, 0x81) for t in tags[3:])
    if tags[:2] == [INTEGER, OCTETS]:  # SEC 1
        return version == 1 and tags[2:] in ([], [PARAMETERS], [PUBLIC], [PARAMETERS, PUBLIC])
    return tags == [SEQUENCE, OCTETS] and algorithm(0)  # encrypted PKCS#8


def is_openssh_key(data: bytes) -> bool:
    if not data.startswith(OPENSSH):
        return False

    def string(at: int) -> int:
        """Where the length-prefixed string at a place ends; beyond the data if it does not fit."""
        return at + 4 + int.from_bytes(data[at : at + 4]) if at + 4 <= len(data) else len(data) + 1

    at = len(OPENSSH)
    for _ in range(3):  # cipher, key derivation and its options
        at = string(at)
    if at + 4 > len(data):
        return False
    many, at = int.from_bytes(data[at : at + 4]), at + 4
    while many and at <= len(data):
        many, at = many - 1, string(at)
    return not many and string(at) == len(data)


def decoded(run: bytes) -> bytes:
    """Bytes of a run of base64 in either alphabet; none if it is not base64."""
    run = run.rstrip(b"=").translate(URL)
    try:
        return binascii.a2b_base64(run + b"=" * (-len(run) % 4))
    except binascii.Error:
        return b""


def _promising(head: bytes) -> bool:
    return head[:1] == bytes([SEQUENCE]) or head.startswith(OPENSSH)


def is_key(run: bytes) -> bool:
    """Whether a run of hexadecimal or base64 digits is a private key; only its head is decoded if that tells."""
    if ALL_HEX.fullmatch(run) and _promising(bytes.fromhex(run[:32].decode())):
        data = bytes.fromhex(run.decode())
    elif _promising(decoded(run[:32])):
        data = decoded(run)
    else:
        return False
    return is_der_key(data) or is_openssh_key(data)


def is_token(header: bytes, payload: bytes, signature: bytes) -> bool:
    if len(header) < LEAST_HEADER:
        return False
    try:
        head, body = json.loads(decoded(header)), json.loads(decoded(payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    name, size = head["alg"], len(decoded(signature))
    return size == SIGNATURES[name] if name in SIGNATURES else name[:2] in ("RS", "PS") and size >= LEAST_RSA


def _tokens(run: bytes, start: int) -> Iterator[tuple[int, int]]:
    for part in DOTTED.finditer(run):
        pieces, at = part.group().split(b"."), start + part.start()
        ends = [at := at + len(p) + 1 for p in pieces]
        k = 0
        while k + 2 < len(pieces):
            if is_token(*pieces[k : k + 3]):
                yield ends[k] - 1 - len(pieces[k]), ends[k + 2] - 1
                k += 3
            else:
                k += 1


def _confirmed(text: bytes) -> Iterator[tuple[str, int, int]]:
    blocks, opened = [], None
    for marker in MARKER.finditer(text) if b"-----BEGIN " in text else ():
        if marker[1] == b"BEGIN":
            opened = marker
        else:
            if opened and opened[2] == marker[2] and is_key(BLANKS.sub(b"", text[opened.end() : marker.start()])):
                blocks.append((opened.start(), marker.end()))
                yield ("pem", *blocks[-1])
            opened = None
    outside = iter([*blocks, (len(text) + 1, 0)])
    start, end = next(outside)
    for found in RUN.finditer(text):
        while found.start() >= end and end:
            start, end = next(outside)
        for part in BASE64.finditer(found.group()):
            a, b = found.start() + part.start(), found.start() + part.end()
            if not (start <= a and b <= end) and is_key(part.group()):
                yield "key", a, b
        if found.group().count(b".") > 1:
            yield from (("jwt", *span) for span in _tokens(found.group(), found.start()))


def spans(text: bytes) -> list[tuple[str, int, int]]:
    """Kind, start and end in code points of every secret in a UTF-8 text."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    if b"AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    found += _confirmed(text)
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    if not text.isascii() and found:
        places, at, chars = {}, 0, 0
        for place in sorted({p for s in found for p in s[1:]}):
            chars += len(text[at:place].decode())
            places[place], at = chars, place
        found = [(kind, places[a], places[b]) for kind, a, b in found]
    return found


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scanned(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and `spans` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t)] for t in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW)], ["doc_id", "spans"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id].dataType), T.StructField("spans", SPANS)])
    return docs.select(id, text).mapInArrow(run, schema)
