"""Personal data and secrets against plain patterns, and what the methods add."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import pii, queries, secret_scan
from tests.llm.odd_tables import none, odd

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def plain_pii(t):
    found = [("email", m) for m in EMAIL.finditer(t)]
    found += [("ip", m) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    found += [("phone", m) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in found]


def plain_secrets(t):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [(k, b, e) for b, _, k, e in sorted(found)]


TEXT = st.lists(
    st.sampled_from(
        ["a.b", "@", "x-1", ".", "com", " ", "1.2.3.4", "256", "4111 1111 1111 1111", "+", "49", "(0)", "-", "é", "token",
         "=", ": ", '"', "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "ſecret", "API_key", "\n"]
    ),
    max_size=25,
).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_base_spans_are_those_of_the_patterns(t):
    assert pii.base_spans(t) == plain_pii(t)
    assert secret_scan.base_spans(t) == plain_secrets(t)


def test_scans_stay_linear_in_long_runs():
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+" * 300_000, "token" + " " * 300_000, "1." * 100_000):
        pii.base_spans(t)
        secret_scan.base_spans(t)


@settings(max_examples=100, deadline=None)
@given(st.text("abc0", min_size=1, max_size=60))
def test_window_entropies_are_kept_up_to_date(s):
    width = min(secret_scan.WINDOW, len(s))
    for i, h in enumerate(secret_scan.window_entropies(s)):
        counts = Counter(s[i : i + width])
        assert h == pytest.approx(-sum(c / width * math.log2(c / width) for c in counts.values()), abs=1e-9)


def test_high_entropy_strings_are_added_and_harmless_ones_are_not():
    key = "q7Rz0Kp2Vx9Lm4Tn8Bc1"
    _, spans = secret_scan.all_spans(f"see {key} and internationalization-of-things-2024 and 00000000000000000000")
    assert spans == [("entropy", 4, 4 + len(key))]
    base, spans = secret_scan.all_spans(f"token={key}")
    assert base == spans == [("assign", 0, 6 + len(key))]


@pytest.mark.parametrize("n", [128, 256, 512])
def test_slashes_do_not_hide_long_keys(n):
    r = random.Random(n)
    for _ in range(300):
        key = base64.b64encode(r.randbytes(n * 3 // 4)).decode()
        assert secret_scan.all_spans(f"see {key} here")[1] == [("entropy", 4, 4 + len(key.rstrip("=")) + key.count("="))]
    for path in ("/usr/local/lib/python3/site-packages/numpy", "data/raw/2024/01/05/part-00012", "src/main/java/OrderService/v2/README"):
        assert secret_scan.all_spans(f"see {path} here") == ([], [])


def test_labelers_and_classifier_accept_what_they_agree_on():
    good = pii.code_of("ssn", (1, -1, 1, -1, 1))
    bad = pii.code_of("ssn", (0, -1, -1, 0, 0))
    assert pii.decode(good) == ("ssn", (1, -1, 1, -1, 1))
    assert pii.train({good: 50, bad: 50}) == {good}
    assert pii.train({}) == set()
    prior, right = pii.reliabilities([((1, 1, 1, -1, 1), 80), ((0, 0, -1, 0, 0), 20)])
    assert 0.05 <= prior <= 0.95 and all(0.55 <= r <= 0.99 for r in right)


def test_annotate_adds_spans_and_redacts(spark):
    t = "tax ssn 123-45-6789, call 212-555-0182 or mail jo@site.org"
    row = pii.annotate(spark.createDataFrame([(1, t)] * 3, "doc_id long, text string")).first()
    base = pii.base_spans(t)
    assert row.base_sha256 == hashlib.sha256(pii.join_spans(base).encode()).hexdigest()
    assert row.spans.startswith(pii.join_spans(base)) and row.n_added >= 1
    assert "jo@site.org" not in pii.redact(t, row.spans) and "[email]" in pii.redact(t, row.spans)


@pytest.mark.parametrize("operator", [pii.annotate, secret_scan.scan])
def test_odd_rows(spark, operator):
    rows = operator(odd(spark)).collect()
    assert len(rows) == odd(spark).count()
    assert {"doc_id", "kept", "base_sha256", "spans"} <= set(rows[0].asDict())
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.base_sha256 for r in rows if r.doc_id in (4, 5, 6)} == {empty}
    assert operator(none(spark)).count() == 0


def test_queries_on_documents(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op2_pii_votes(spark, small).collect():
        base = plain_pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.join_spans(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
    for r in queries.op9_secret_entropy(spark, small).collect():
        base = plain_secrets(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.join_spans(base).encode()).hexdigest()


def test_many_spans_in_one_text_take_linear_time():
    import time

    rng = random.Random(3)
    keys = " ".join("".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(20_000))
    mails = " ".join(f"a{i}@b{i}.com {i}-12-34 +49 30 12345{i % 1000:03d}" for i in range(8_000))
    began = time.monotonic()
    assert len(secret_scan.all_spans(keys)[0]) == 20_000
    base = pii.base_spans(mails)
    assert len(base) >= 16_000 and isinstance(pii.more_spans(mails, base), list)
    assert time.monotonic() - began < 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 8)), max_size=15), st.integers(0, 60), st.integers(1, 8))
def test_taken_places(spans, begin, size):
    from tessera.llm.common import Taken

    spans = [(b, b + n) for b, n in spans if n]
    assert Taken(spans).meets(begin, begin + size) == any(b < begin + size and begin < e for b, e in spans)


def test_secrets_of_letters_only():
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    assert sum(secret_scan.is_secret("".join(rng.choice(letters) for _ in range(40))) for _ in range(500)) > 400
    for words in ("getElementsByClassNameAndThenSome", "InternationalBusinessMachinesCorporation", "averylonglowercasewordthatisfine", "XMLHttpRequestEventTargetFactory"):
        assert not secret_scan.is_secret(words)
