"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Four base kinds (email, ip, card, phone) are reported whenever pattern and validator agree.
Further kinds (short card numbers, IBANs, social security numbers, national phone numbers)
are reported when their score, raised or lowered by words nearby, reaches ``threshold``.
"""

from __future__ import annotations

import re
from bisect import bisect_right

from pyspark.sql import DataFrame

from tidemark.llm.rowwise import SPANS, add_columns, has_run, marks, span_array

DIGITS = marks("0123456789")

BASE = ("email", "ip", "card", "phone")
EXTRA = ("short_card", "iban", "ssn", "local_phone")
KINDS = BASE + EXTRA

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) |[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")

# IBAN lengths by country (ISO 13616).
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27,
    "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SE": 24, "SI": 19, "SK": 24, "TR": 26,
}

# Starting score of a kind, words that raise it and words that lower it.
START = {
    "email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7,
    "short_card": 0.5, "iban": 0.9, "ssn": 0.3, "local_phone": 0.3,
}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("call", "phone", "tel", "fax", "mobile"),
    "short_card": ("card", "amex", "credit", "payment"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security"),
    "local_phone": ("call", "phone", "tel", "fax", "mobile"),
}
AGAINST = ("version", "invoice", "order no", "isbn", "sample")
RAISED, LOWERED = 0.3, 0.2
BEFORE, AFTER = 40, 20


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str):
    """Leftmost matches of the email pattern, found from their ``@`` in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1, at):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def score(kind: str, text: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - BEFORE):start]} {text[end:end + AFTER]}".lower()
    value = START[kind]
    if any(word in around for word in CONTEXT[kind]):
        value += RAISED
    if any(word in around for word in AGAINST):
        value -= LOWERED
    return min(1.0, max(0.0, round(value, 2)))


def scan(text: str, threshold: float = 0.5) -> list[tuple]:
    """(kind, start, end, score, text) by kind, then start; offsets count code points."""
    found = {kind: [] for kind in KINDS}
    found["email"] = list(emails(text))
    if has_run(text.encode("utf-8", "surrogatepass"), DIGITS, 1):
        _numbers(text, found)

    certain = _merged(s for kind in BASE for s in found[kind])
    ends = [end for _, end in certain]
    out = []
    for kind in KINDS:
        for start, end in found[kind]:
            value = score(kind, text, start, end)
            if kind in EXTRA:
                after = bisect_right(ends, start)
                if value < threshold or after < len(ends) and certain[after][0] < end:
                    continue
            out.append((kind, start, end, value, text[start:end]))
    return out


def _merged(spans) -> list[tuple[int, int]]:
    """Disjoint spans that cover the given ones, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _numbers(text: str, found: dict) -> None:
    """Add the spans of all kinds that have digits."""
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19:
            if luhn(digits):
                found["card"].append(m.span())
        elif 13 <= len(digits) <= 15 and digits[0] in "34" and luhn(digits):
            found["short_card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found["phone"].append(m.span())
    for m in IBAN.finditer(text):
        wanted = IBAN_LENGTH.get(m[0][:2], 0)
        seen, end = 0, m.start()
        while seen < wanted and end < m.end():
            seen += text[end] != " "
            end += 1
        whole = seen == wanted > 0 and not text[end : end + 1].isalnum()
        if whole and mod97(text[m.start() : end].replace(" ", "")):
            found["iban"].append((m.start(), end))
    found["ssn"] = [m.span() for m in SSN.finditer(text)]
    found["local_phone"] = [m.span() for m in LOCAL_PHONE.finditer(text)]


def mask(text: str, spans: list[tuple]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first."""
    parts, done = [], 0
    for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
            done = end
    return "".join([*parts, text[done:]])


def find_pii(df: DataFrame, text_col: str = "text", threshold: float = 0.5, masked: bool = False):
    """``df`` with ``pii``: its spans by kind, then start; with ``masked`` also the text
    with the spans replaced.

    One row per input row, whole texts of any length. A null text counts as empty and has
    no spans; its masked text is null. Repeated rows give repeated results, an empty table
    an empty one. Input columns named ``pii`` or ``masked`` are replaced.
    """
    import pyarrow as pa

    def make():
        def compute(texts):
            spans = [scan(t or "", threshold) for t in texts]
            arrays = [span_array(spans)]
            if masked:
                hidden = [t and mask(t, s) for t, s in zip(texts, spans, strict=True)]
                arrays.append(pa.array(hidden, pa.string()))
            return arrays

        return compute

    fields = f"pii {SPANS}" + (", masked string" if masked else "")
    return add_columns(df, text_col, make, fields)
