"""Personal data and secrets against a literal reading of their patterns."""

import base64
import json
import random
import re

import pytest

from tests.llm.conftest import plain
from tidemark.llm import pii, secret_scan
from tidemark.llm.queries import QUERIES


def _luhn(digits):
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def brute_pii(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def brute_secrets(text):
    out = []
    names = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    names += "|[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, "hex", m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


PIECES = [
    "a@b.co", "x.y+z@mail.example.com", "@", "a@b", "a@b@c.de", "..@q.w.", "1.2.3.4", "1.2.3.4.5.6.7.8",
    "256.1.1.1", "00.0.0.000001", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "5500005555555559",
    "+1 (988) 555-2485", "+49 30 1", "+", "+12", "1234567890123456789012", "password=", "Passwd: 'abcdefgh'",
    "api_key = \"0123456789abcdef\"", "APIKEY:short", "token==aaaaaaaa", "ſecret: abcdefgh1", "toKen=abcdefghi",
    "AKIAABCDEFGHIJKL", "AKIA1", "0123456789abcdef0123456789abcdef", "deadbeef" * 5, "é", "漢", "\U0001f600", " ", "  ", "\n", "-", ".",
]


def test_base_spans_equal_the_literal_patterns():
    chance = random.Random(3)
    for _ in range(1500):
        text = "".join(chance.choice(PIECES) + chance.choice(["", " ", ","]) for _ in range(chance.randint(0, 12)))
        found = [s[:3] for s in pii.scan(text) if s[0] in pii.BASE]
        assert found == brute_pii(text), text
        found = [s[:3] for s in secret_scan.scan(text) if s[0] in secret_scan.BASE]
        assert found == brute_secrets(text), text


@pytest.mark.parametrize("piece", ["a", "1", "1 ", "1.", "a.", "@", "+1", "(123) ", "token ", "eyJ", "AB12", "{", "-----BEGIN A-----"])
def test_long_texts_take_linear_time(piece):
    text = piece * (200_000 // len(piece))
    pii.scan(text)
    secret_scan.scan(text)


def test_checksums_confirm_and_context_decides():
    def kinds(text):
        return [s[0] for s in pii.scan(text)]

    assert kinds("iban DE89 3704 0044 0532 0130 00.") == ["iban"]
    assert kinds("iban DE88 3704 0044 0532 0130 00.") == []
    assert kinds("amex 3782 822463 10005") == ["short_card"]
    assert kinds("ssn 123-45-6789") == ["ssn"]
    assert kinds("part 123-45-6789") == []
    assert kinds("call 555-123-4567") == ["local_phone"]
    assert kinds("range 555-123-4567") == []
    (span,) = pii.scan("card 4111 1111 1111 1111")
    (bare,) = pii.scan("4111 1111 1111 1111")
    assert span[3] > bare[3] and span[4] == "4111 1111 1111 1111"
    assert pii.mask("mail a@b.co now", pii.scan("mail a@b.co now")) == "mail [EMAIL] now"


def _der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


def test_structures_are_confirmed_by_decoding():
    numbers = b"".join(_der(2, bytes(range(1, 60))) for _ in range(3))
    key = _der(0x30, _der(2, b"\0") + numbers)
    text = base64.b64encode(key).decode()
    assert [s[0] for s in secret_scan.scan(f"key {text} end")] == ["der"]
    assert [s[0] for s in secret_scan.scan("key " + base64.b64encode(key[:-1]).decode())] == []
    assert "der" not in [s[0] for s in secret_scan.scan("A" * 200)]
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{text}\n-----END RSA PRIVATE KEY-----"
    assert [s[:3] for s in secret_scan.scan("x " + pem)] == [("pem", 2, 2 + len(pem))]
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    body = base64.urlsafe_b64encode(b'{"sub":"1"}').decode().rstrip("=")
    assert [s[0] for s in secret_scan.scan(f"jwt {head}.{body}.abcd_-123")] == ["token"]
    wrong = base64.urlsafe_b64encode(b'{"xyz": 12}').decode().rstrip("=")
    assert secret_scan.scan(f"jwt {wrong}.{body}.abcd") == []
    name = b"ssh-rsa"
    blob = len(name).to_bytes(4, "big") + name + (40).to_bytes(4, "big") + bytes(40)
    assert [s[0] for s in secret_scan.scan(base64.b64encode(blob).decode())] == ["ssh"]
    assert [s[0] for s in secret_scan.scan(key.hex())] == ["hex", "der"]
    assert [s[3] for s in secret_scan.scan(key.hex())] == [1.0, 1.0]


@pytest.mark.parametrize("find, new", [(pii.find_pii, "pii"), (secret_scan.find_secrets, "secrets")])
def test_odd_rows(odd, odd_rows, find, new):
    df = find(odd(new))
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", new]
    assert plain(df, "doc_id", "text") == sorted([r[:2] for r in odd_rows], key=repr)
    assert all(s == [] for (s,) in plain(df, new))
    assert find(odd("a.b c")).where("doc_id = 7").select("`a.b c`").first()[0] == "x"
    assert find(odd(rows=[])).count() == 0


def test_masked_text(odd, spark):
    df = spark.createDataFrame([(1, "to a@b.co"), (2, None)], "doc_id long, text string")
    got = plain(pii.find_pii(df, masked=True), "doc_id", "masked")
    assert got == [(1, "to [EMAIL]"), (2, None)]


@pytest.mark.parametrize("name, brute", [("op1_pii", brute_pii), ("op8_secrets", brute_secrets)])
def test_queries(spark, name, brute):
    import hashlib

    folder = "/root/testdata/sf0.01"
    texts = dict(plain(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text"))
    rows = QUERIES[name](spark, folder).collect()
    assert len(rows) == len(texts)
    hits = 0
    for row in rows:
        found = brute(texts[row["doc_id"]] or "")
        hits += len(found)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        for kind in {k for k, *_ in found}:
            assert row[f"n_{kind}"] == sum(k == kind for k, *_ in found)
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))
    assert hits > 0
