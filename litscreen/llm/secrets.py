"""Secret scans: patterns, and candidates that are reported only if their decoded bytes have the structure of a key.

Base kinds are plain patterns: ``assign`` (a value given to a name such as token), ``access`` (key IDs of a cloud)
and ``hex``. Confirmed kinds are added: ``jwt`` (a signed token: its header is a JSON object that names an algorithm
and its payload is a JSON object), ``pem`` (an armoured private key) and ``key`` (a private key in base64 or hex
without armour). A private key is confirmed by parsing all nested lengths of its DER encoding, or of the OpenSSH one.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from litscreen.llm.texts import Texts, by_slices, text_rows, with_struct

KINDS = ("assign", "access", "hex", "jwt", "pem", "key")
BASE_KINDS = KINDS[:3]
REPLACEMENT = "[SECRET]"
Span = tuple[int, int, int]  # begin, index of the kind, end

NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_access = re.compile(r"AKIA[A-Z0-9]+")
_hex = re.compile(r"[0-9a-f]+")
# A header in JSON begins, as base64, with the letter of a brace or of white space before it.
_jwt = re.compile(r"(?<![A-Za-z0-9_-])([eCID][A-Za-z0-9_-]{7,}+)\.([A-Za-z0-9_-]*+)\.([A-Za-z0-9_-]*+)(?:\.([A-Za-z0-9_-]*)\.([A-Za-z0-9_-]+))?")
_pem = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----((?:(?!-----).)+)-----END \1PRIVATE KEY-----", re.S)
_line_end = re.compile(r"\r\n|[\r\n]|(?:\\r)?\\n|\\r")
_header_line = re.compile(r"[A-Za-z0-9-]+:|[ \t]+\S")
_wrapped = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+(?:(?:\r?\n|(?:\\r)?\\n)[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_encoded = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_hex_key = re.compile(r"[0-9A-Fa-f]{48,}")

_bytes = np.arange(256)
IS_HEX = np.isin(_bytes, list(b"0123456789abcdef"))
IS_BASE64 = np.isin(_bytes, list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"))


# ---------------------------------------------------------------- structure

def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of DER values that fill ``data`` exactly, else None."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length >= 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            length, at = int.from_bytes(data[at:at + n], "big"), at + n
            if length < 0x80:
                return None  # DER has the shortest form only
        if at + length > len(data):
            return None
        found.append((tag, data[at:at + length]))
        at += length
    return found


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_private_key(data: bytes) -> bool:
    """PKCS #1, PKCS #8 (also encrypted), SEC 1 or OpenSSH."""
    if data.startswith(b"openssh-key-v1\0"):
        return _openssh(data)
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    parts = der_items(outer[0][1])
    if not parts or len(parts) < 2:
        return False
    tags = [tag for tag, _ in parts]
    if tags[:9] == [INTEGER] * 9:  # RSA: version, modulus, exponents, primes
        return len(parts[1][1]) >= 32
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # version, algorithm, key
        return _algorithm(parts[1][1]) and len(parts[2][1]) >= 16
    if tags[:2] == [INTEGER, OCTETS]:  # elliptic curve: version 1, number
        return parts[0][1] == b"\x01" and len(parts[1][1]) >= 16
    if tags == [SEQUENCE, OCTETS]:  # encrypted: algorithm, data
        return _algorithm(parts[0][1]) and len(parts[1][1]) >= 16
    return False


def _algorithm(data: bytes) -> bool:
    parts = der_items(data)
    return bool(parts) and parts[0][0] == OID and len(parts[0][1]) >= 3


def _openssh(data: bytes) -> bool:
    """Cipher, key derivation, its options, number of keys, public and private parts; all lengths must nest."""
    at, fields = len(b"openssh-key-v1\0"), []
    for i in range(6):
        if at + 4 > len(data):
            return False
        length, at = int.from_bytes(data[at:at + 4], "big"), at + 4
        if i == 3:  # a number, not a length
            fields.append(length)
            continue
        if at + length > len(data):
            return False
        fields.append(data[at:at + length])
        at += length
    return at == len(data) and fields[3] >= 1 and len(fields[5]) >= 16


def decode64(text: str) -> bytes | None:
    """Plain or URL-safe base64 with or without padding."""
    text = text.rstrip("=").translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(text: str) -> dict | None:
    try:
        found = json.loads(decode64(text) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


# ---------------------------------------------------------------- spans

def base_spans(text: str) -> list[Span]:
    found = [(m.start(), 0, m.end()) for m in _assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _access.finditer(text) if len(m[0]) >= 20]
    return found + [(m.start(), 2, m.end()) for m in _hex.finditer(text) if len(m[0]) >= 24]


def _is_token(m: re.Match) -> int:
    """Where a signed or encrypted token ends, if it is one; else 0."""
    header = _json_object(m[1])
    if header is None or not isinstance(header.get("alg"), str):
        return 0
    if m[5] and isinstance(header.get("enc"), str):  # header, key, start vector, data, tag
        return m.end()
    return m.end(3) if _json_object(m[2]) is not None else 0


def _is_armoured(body: str) -> bool:
    """The lines between BEGIN and END; line ends may be escaped. Header lines, as of an encrypted key, come first."""
    lines = _line_end.split(body)
    at = next((i for i, line in enumerate(lines) if line.strip()), len(lines))
    headers = []
    while at < len(lines) and _header_line.match(lines[at]) and (headers or ":" in lines[at]):
        headers.append(lines[at])
        at += 1
    data = decode64("".join("".join(lines[at:]).split()))
    if data is None:
        return False
    if any(h.startswith("Proc-Type:") and "ENCRYPTED" in h for h in headers):  # whole blocks of a cipher
        return any(h.startswith("DEK-Info:") for h in headers) and len(data) >= 32 and len(data) % 8 == 0
    return is_private_key(data)


def _wrapped_keys(m: re.Match) -> int:
    """Where a key that is wrapped over lines ends, if it is one; a word on the line behind it may be no part of it."""
    parts = _line_end.split(m[0])
    text = "".join(p.strip() for p in parts)
    data = decode64(text)
    if data is not None and is_private_key(data):
        return m.end()
    data = decode64(text[: len(text) - len(parts[-1].strip())]) if len(parts) > 2 else None
    if data is not None and is_private_key(data):
        return m.start() + list(_line_end.finditer(m[0]))[-1].start()
    return 0


def confirmed_spans(text: str) -> list[Span]:
    found = []
    for m in _jwt.finditer(text):
        end = _is_token(m)
        if end:
            found.append((m.start(), 3, end))
    for m in _pem.finditer(text):
        if _is_armoured(m[2]):
            found.append((m.start(), 4, m.end()))
    for m in _encoded.finditer(text):
        data = decode64(m[0])
        if data is not None and is_private_key(data):
            found.append((m.start(), 5, m.end()))
    armoured = [(start, end) for start, kind, end in found if kind == 4]
    for m in _wrapped.finditer(text):
        end = _wrapped_keys(m)
        if end and not any(a <= m.start() < b for a, b in armoured):
            found.append((m.start(), 5, end))
    for m in _hex_key.finditer(text):
        for start in (m.start(), m.start() + 1):  # a hex digit may stand before the key, or behind it
            digits = text[start:m.end() - (m.end() - start) % 2]
            if is_private_key(bytes.fromhex(digits)):
                found.append((start, 5, start + len(digits)))
    return found


def spans(text: str) -> list[Span]:
    """All spans in code points, end exclusive, by begin and then kind. Equal spans of one kind count once."""
    return sorted({*base_spans(text), *confirmed_spans(text)})


def joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def _with_run(texts: Texts, flags: np.ndarray, least: int) -> np.ndarray:
    """Whether a text has so many flagged bytes in a row; a run over the end of a text may count for both."""
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = end - begin >= least
    hit = np.zeros(len(texts), bool)
    n = len(texts.offsets) - 1
    first = np.searchsorted(texts.offsets, begin[long], "right") - 1
    last = np.searchsorted(texts.offsets, end[long] - 1, "right") - 1
    for a, b in zip(first, last):
        hit[a:min(b, n - 1) + 1] = True
    return hit


def _found(texts: Texts) -> dict[int, tuple[str, list[Span]]]:
    """Texts with spans. Only texts in which a pattern can match at all are looked at letter by letter."""
    candidates = _with_run(texts, IS_HEX[texts.data], 24) | _with_run(texts, IS_BASE64[texts.data], 40)
    found = {}
    for i, raw in enumerate(texts.bytes()):
        lower = raw.lower()
        if candidates[i] or b"AKIA" in raw or b"." in raw and _jwt_like(raw) \
                or b"-----BEGIN" in raw or any(name in lower for name in NAMES):
            text = raw.decode()
            some = spans(text)
            if some:
                found[i] = (text, some)
    return found


_jwt_bytes = re.compile(_jwt.pattern.encode())


def _jwt_like(raw: bytes) -> bool:
    return _jwt_bytes.search(raw) is not None


def scan(docs: DataFrame) -> DataFrame:
    """Spans of each whole text; null counts as empty. One row for each row, nothing is shuffled.

    ``secrets`` are (kind, start, end, text); the counts and joined forms are made of the same spans.
    """

    def work(part, texts: Texts):
        found = _found(texts)
        n = len(texts)
        empty = ("", [])
        rows = [found.get(i, empty) for i in range(n)]
        count = lambda kind: [sum(k == kind for _, k, _ in some) for _, some in rows]
        nothing = hashlib.sha256(b"").hexdigest()
        return {
            "doc_id": part["doc_id"], "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
            "base_sha256": [hashlib.sha256(joined([s for s in some if s[1] < 3]).encode()).hexdigest() if some else nothing
                            for _, some in rows],
            "spans": [joined(some) for _, some in rows],
            "secrets": pa.array([[{"kind": KINDS[k], "start": a, "end": b, "text": text[a:b]} for a, k, b in some]
                                 for text, some in rows],
                                pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                                    ("text", pa.string())]))),
        }

    return by_slices(text_rows(docs, "doc_id"), work,
                     "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
                     "secrets array<struct<kind: string, start: long, end: long, text: string>>")


def without(text: str, found: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced."""
    parts, at = [], 0
    for start, _, end in found:
        if start >= at:
            parts += [text[at:start], REPLACEMENT]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced, and ``n_chars`` after that where there is such a column."""

    def work(part, texts: Texts):
        found = _found(texts)
        old = part.column(part.schema.get_field_index("text"))
        return {"text": [without(*found[i]) if i in found else None for i in range(len(old))]}

    cleaned, made = with_struct(docs, work, "text string")
    changed = F.col(f"{made}.text")
    cleaned = cleaned.withColumn("text", F.coalesce(changed, F.col("text")))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(changed.isNotNull(), F.length(changed).cast(docs.schema["n_chars"].dataType))
                                     .otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)
