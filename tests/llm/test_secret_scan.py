import base64
import hashlib
import json
import random
import re
import time

import pytest

from pursefold.llm import queries, secret_scan

SF = "/root/testdata/sf0.01"


def base_spans(text):
    """The three patterns as they are written, on text instead of bytes."""
    name = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    assign = re.compile(rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [s for _, _, s in sorted(found)]


def written_out(spans):
    return [f"{k}:{a}:{b}" for k, a, b in spans]


def of_base(spans):
    return written_out(s for s in spans if s[0] in secret_scan.BASE)


def test_secrets_of_documents(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op12_secrets(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        wanted = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in wanted) for k in secret_scan.BASE)
        assert set(wanted) <= set(r.spans.split(",")) if wanted else r.spans == ""
    assert sum(r.n_assign for r in found) > 5


def test_patterns_on_random_texts():
    pick = random.Random(4)
    parts = ["password", "PassWD", "token", "api_key", "ApiKey", "secret", "ſecret", "toKen", "=", ": ", " ", '"', "'", "AKIA", "AKIAABCDEFGHIJ12", "0123456789abcdef", "f", "é", "日本", "\n", "abcdefghijkl", "x.y=", "ZZ9"]
    for _ in range(3000):
        text = "".join(pick.choices(parts, k=pick.randint(0, 14)))
        assert of_base(secret_scan.spans(text.encode())) == base_spans(text), text


def der(tag, *contents):
    body = b"".join(contents)
    size = len(body)
    length = bytes([size]) if size < 128 else (n := size.to_bytes((size.bit_length() + 7) // 8)) and bytes([128 + len(n)]) + n
    return bytes([tag]) + length + body


def number(value, size=1):
    return der(2, value.to_bytes(size))


RSA = der(48, number(0), *(number(2**500 + 7 * k, 64) for k in range(8)))
PKCS8 = der(48, number(0), der(48, der(6, b"\x2a\x86\x48"), der(5)), der(4, RSA))
SEC1 = der(48, number(1), der(4, b"k" * 32), der(0xA0, der(6, b"\x2a\x86")), der(0xA1, der(3, b"\0" * 66)))
SEALED = der(48, der(48, der(6, b"\x2a\x86\x48"), der(48, der(4, b"salt" * 4))), der(4, b"e" * 200))
DSA = der(48, *(number(0 if not k else 2**200 + k, 1 if not k else 30) for k in range(6)))


def string(data):
    return len(data).to_bytes(4) + data


OPENSSH = secret_scan.OPENSSH + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4) + string(b"public" * 8) + string(b"private" * 20)


def url(data):
    return base64.urlsafe_b64encode(data).rstrip(b"=").decode()


def token(head, body=b'{"sub":"1"}', signature=b"s" * 32):
    return f"{url(json.dumps(head).encode())}.{url(body)}.{url(signature)}"


def kinds(text):
    return [s[0] for s in secret_scan.spans(text.encode()) if s[0] not in secret_scan.BASE]


@pytest.mark.parametrize("key", [RSA, PKCS8, SEC1, SEALED, DSA, OPENSSH], ids=["rsa", "pkcs8", "sec1", "sealed", "dsa", "openssh"])
def test_keys_are_confirmed_by_their_structure(key):
    code = base64.b64encode(key).decode()
    assert secret_scan.spans(f"é {code}, ".encode())[-1] == ("key", 2, 2 + len(code))
    assert kinds(f"x {key.hex().upper()} y") == ["key"]
    assert kinds(f"x {url(key)} y") == ["key"]
    lines = "\n".join(code[k : k + 64] for k in range(0, len(code), 64))
    for body in (lines, lines.replace("\n", "\r\n"), lines.replace("\n", "\\n")):
        block = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
        assert [s for s in secret_scan.spans(f"a {block} b".encode()) if s[0] not in secret_scan.BASE] == [("pem", 2, 2 + len(block))]
    for wrong in (key[:-1], key + b"\0", key[: len(key) // 2], b"1" + key[1:]):
        code = base64.b64encode(wrong).decode()
        assert kinds(code) == [] and kinds(wrong.hex().upper()) == []
        assert kinds(f"-----BEGIN PRIVATE KEY-----\n{code}\n-----END PRIVATE KEY-----") == []


def test_blocks_need_the_marker_of_their_end():
    code = base64.b64encode(RSA).decode()
    begin, end = "-----BEGIN RSA PRIVATE KEY-----\n", "\n-----END RSA PRIVATE KEY-----"
    assert kinds(begin + code + end) == ["pem"]
    assert kinds(begin + code) == ["key"]
    assert kinds(begin + code + "\n-----END CERTIFICATE-----") == ["key"]
    assert kinds("-----BEGIN X-----\n" + begin + code + end) == ["pem"]
    assert kinds(begin + code + end + " " + code) == ["pem", "key"]
    public = der(48, der(48, der(6, b"\x2a\x86\x48"), der(5)), der(3, b"\0" + b"p" * 100))
    assert kinds(begin + base64.b64encode(public).decode() + end) == []


def test_tokens_are_confirmed_by_their_headers():
    good = token({"alg": "HS256", "typ": "JWT"})
    assert secret_scan.spans(f"日 {good}.".encode())[-1] == ("jwt", 2, 2 + len(good))
    assert kinds(token({"alg": "ES512"}, signature=b"s" * 132)) == ["jwt"]
    assert kinds(token({"alg": "RS256"}, signature=b"s" * 256)) == ["jwt"]
    assert kinds(f"www.x.{good} {good}") == ["jwt", "jwt"]
    for wrong in (token({"alg": "HS256"}, signature=b"s" * 31), token({"alg": "none"}, signature=b""), token({"alg": 5}), token({"typ": "JWT and more"}), token(["HS256", "and so on"]), token({"alg": "HS256"}, b"[1]"), token({"alg": "HS256"}, b"{"), token({"alg": "RS256"}), "a" * 40 + "." + "b" * 40 + "." + "c" * 43):
        assert kinds(wrong) == [], wrong
    deep = url(b"[" * 100_000)
    assert kinds(f"{deep}.{deep}.{deep}") == []


@pytest.mark.parametrize("text", ["a" * 3_000_000, "a." * 1_500_000, "A1+/" * 750_000, "-----BEGIN A-----" * 150_000, "token " * 500_000, "token=" * 500_000, "MIIE" * 750_000, "eyJhbGciOiJIUzI1NiJ9." * 150_000, "password" + " " * 3_000_000, "AKIA" * 750_000], ids=range(10))
def test_long_texts_take_linear_time(text):
    start = time.process_time()
    secret_scan.spans(text.encode())
    assert time.process_time() - start < 10


def test_secrets_of_odd_rows(spark, odd):
    got = secret_scan.scanned(odd.withColumnsRenamed({"hash": "spans", "at": "kind"})).collect()
    assert len(got) == odd.count() and all(not r.spans for r in got)
    assert secret_scan.scanned(odd.filter("false")).count() == 0
    twice = spark.createDataFrame([(1, "token: abcdefghijklm")] * 2, "doc_id int, text string")
    assert [[tuple(s) for s in r.spans] for r in secret_scan.scanned(twice).collect()] == [[("assign", 0, 20)]] * 2
