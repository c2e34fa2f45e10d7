"""Secrets: patterns propose candidates, decoding confirms their structure.

Three base kinds (assign, access, hex) are reported whenever their pattern holds. Candidates
of base64 or hex that decode to a key encoding (PEM body, DER with consistent nested lengths,
SSH key blobs) or to a signed token with a readable header are reported as kinds of their own.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame

from tidemark.llm.rowwise import SPANS, add_columns, has_run, marks, span_array

HEX_MARKS = marks("0123456789abcdefABCDEF")
BASE64_MARKS = marks("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")

BASE = ("assign", "access", "hex")
EXTRA = ("pem", "der", "ssh", "token")
KINDS = BASE + EXTRA

ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
NAMES = ("passw", "secret", "token", "api")
ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){16,}(?![0-9A-Za-z])")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----([A-Za-z0-9+/=\s]*)-----END \1-----")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]*)")

# Names at the start of SSH key blobs.
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256",
             b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
SSH_FILE = b"openssh-key-v1\0"


def decoded(text: str) -> bytes | None:
    """Bytes of base64 text in either alphabet, with or without padding."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes, start: int, end: int):
    """(tag, start, end) of the DER elements that fill the range exactly, or None."""
    out = []
    while start < end:
        if start + 2 > end:
            return None
        tag, size, start = data[start], data[start + 1], start + 2
        if size == 0x80 or size > 0x84:
            return None
        if size > 0x80:
            more = size - 0x80
            size = int.from_bytes(data[start : start + more], "big")
            start += more
        if start + size > end:
            return None
        out.append((tag, start, start + size))
        start += size
    return out


def is_der(data: bytes) -> bool:
    """A DER sequence that fills the data, whose nested sequences fill theirs, and that
    holds an integer, an object id or a bit or octet string, as key encodings do."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    outer = _elements(data, 0, len(data))
    if not outer or len(outer) != 1:
        return False
    waiting, seen = [outer[0]], set()
    while waiting:
        tag, start, end = waiting.pop()
        seen.add(tag)
        if tag in (0x30, 0x31) or tag & 0xE0 == 0xA0:
            inner = _elements(data, start, end)
            if inner is None:
                return False
            waiting += inner
    return bool(seen & {0x02, 0x06}) and bool(seen & {0x02, 0x03, 0x04})


def is_ssh(data: bytes) -> bool:
    """An SSH private key file, or a public key whose length-prefixed fields fill it."""
    if data.startswith(SSH_FILE):
        return True
    place, fields = 0, []
    while place + 4 <= len(data):
        size = int.from_bytes(data[place : place + 4], "big")
        fields.append(data[place + 4 : place + 4 + size])
        place += 4 + size
    return place == len(data) and len(fields) >= 2 and fields[0] in SSH_NAMES


def is_token_header(text: str) -> bool:
    data = decoded(text)
    if data is None:
        return False
    try:
        header = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def structure(text: str) -> str | None:
    """What base64 or hex text decodes to: ``der``, ``ssh`` or None."""
    tried = [decoded(text)]
    if len(text) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", text):
        tried.append(bytes.fromhex(text))
    for data in tried:
        if data and is_der(data):
            return "der"
        if data and is_ssh(data):
            return "ssh"
    return None


def scan(text: str) -> list[tuple]:
    """(kind, start, end, score, text) by start, then kind; offsets count code points.

    The score is 1 for spans whose structure is confirmed, 0.6 for base spans that are only
    a pattern.
    """
    out = []
    data = text.encode("utf-8", "surrogatepass")
    lowered = data.lower()
    for m in ASSIGN.finditer(text) if any(n.encode() in lowered for n in NAMES) else ():
        if len(m[2]) >= 8:
            sure = structure(m[2]) or is_token_header(m[2].split(".")[0])
            out.append(("assign", *m.span(), 1.0 if sure else 0.6, m[0]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= 16:
                out.append(("access", *m.span(), 1.0 if len(m[0]) == 20 else 0.6, m[0]))
    for m in HEX.finditer(text) if has_run(data, HEX_MARKS, 32) else ():
        out.append(("hex", *m.span(), 1.0 if structure(m[0]) else 0.6, m[0]))
    covered = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            body = decoded("".join(m[2].split()))
            if body and (is_der(body) or is_ssh(body)):
                out.append(("pem", *m.span(), 1.0, m[0]))
                covered.append(m.span())
    if "eyJ" in text:
        for m in TOKEN.finditer(text):
            if is_token_header(m[1]) and decoded(m[2]) is not None:
                out.append(("token", *m.span(), 1.0, m[0]))
                covered.append(m.span())
    for pattern in (BASE64, ANY_HEX) if has_run(data, BASE64_MARKS, 24) else ():
        for m in pattern.finditer(text):
            if any(a <= m.start() and m.end() <= b for a, b in covered):
                continue
            kind = structure(m[0])
            if kind:
                out.append((kind, *m.span(), 1.0, m[0]))
                covered.append(m.span())
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``secrets``: its spans by start, then kind.

    One row per input row, whole texts of any length. A null text counts as empty and has
    no spans. Repeated rows give repeated results, an empty table an empty one. An input
    column named ``secrets`` is replaced.
    """

    def make():
        return lambda texts: [span_array([scan(t or "") for t in texts])]

    return add_columns(df, text_col, make, f"secrets {SPANS}")
