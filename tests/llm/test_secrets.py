"""Operator 13 against a plain reading of its base patterns, and its token test on planted strings."""

import hashlib
import random
import re
import string
import uuid

import public_tokenizers
import pytest

from duskwatch.llm.secrets import KINDS, Vocabulary, base_spans, is_digest, is_identifier, random_spans, scan_secrets, secret_digests

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def plain_base(text):
    """The patterns as the contract words them: match, then drop what falls short."""
    any_case = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    words = "|".join(map(any_case, ["password", "passwd", "secret", "token", "api_key", "apikey"]))
    out = []
    for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return out


def cases():
    pick = random.Random(7)
    pieces = ["token", "Secret", "API_KEY", "apikey", "passwd", "PASSWORD", "ſecret", " ", "  ", ":", "=", "\"", "'", "AKIA", "AKIAAKIA", "é", "漢", "\n",
              "abc", "Z9", "deadbeef", "0123456789abcdef", "x-y", "A1B2C3D4E5F6G7H8", ".", "=="]
    return ["".join(pick.choices(pieces, k=pick.randint(0, 30))) for _ in range(3000)]


def test_base_spans_follow_the_patterns():
    hits = 0
    for text in cases():
        want = plain_base(text)
        assert sorted(base_spans(text)) == sorted(want), text
        hits += len(want)
    assert hits > 1000


def test_random_strings_stand_out():
    vocabulary, pick = Vocabulary(PATH, PATTERN), random.Random(8)
    found = lambda run: bool(random_spans(f"see {run} there", vocabulary, [], 2.2))
    made = ["".join(pick.choices(string.ascii_letters + string.digits, k=36)) for _ in range(300)]
    assert sum(map(found, made)) >= 297
    plain = ["getUserAccountNameById2", "some_long_function_name_v2", "org.apache.spark.sql.functions", "2024-01-15T10:30:00", str(uuid.UUID(int=99)),
             "application/x-www-form-urlencoded", "HTTP_REQUEST_TIMEOUT_SECONDS", "geeinvererberlichlich", "1234567890123456789",
             hashlib.sha1(b"a").hexdigest().upper(), hashlib.sha256(b"a").hexdigest(), "47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "----------------====", "."]
    assert [p for p in plain if found(p)] == []
    assert is_digest("sha256-AbCd1234") and not is_digest("a" * 31) and is_identifier("snake_case_2") and not is_identifier("a1b2c3d4e5f6")


def test_long_runs_and_places():
    vocabulary, pick = Vocabulary(PATH, PATTERN), random.Random(9)
    run = "".join(pick.choices(string.ascii_letters + string.digits, k=50_000))
    assert [s[:2] for s in random_spans(f"漢 é {run}.", vocabulary, [], 2.2)] == [(4, 50_004)]
    inside = f"token = {run[:40]}"
    assert random_spans(inside, vocabulary, base_spans(inside), 2.2) == []  # a base span holds it already


@pytest.fixture(scope="module")
def documents(spark):
    pick = random.Random(10)
    run = "".join(pick.choices(string.ascii_letters + string.digits, k=40))
    texts = cases()[:300] + [None, "", f"a {run} b", f"a {run} b", "word " * 30_000 + run + " password: hunter22", f"token={run} deadbeefdeadbeefdeadbeefdeadbeef"]
    rows = [(k if k % 40 else None, t) for k, t in enumerate(texts)] + [(3, "secret: abcdefg")] * 2
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as spans", "1 as n_hex").repartition(5)


def test_query_columns(documents):
    rows, docs = documents
    got = sorted((tuple(r) for r in secret_digests(scan_secrets(docs, PATH, PATTERN)).collect()), key=str)
    order, want, vocabulary = {k: n for n, k in enumerate(KINDS)}, [], Vocabulary(PATH, PATTERN)
    for doc, text in rows:
        base = sorted(plain_base(text or ""), key=lambda s: (s[1], order[s[0]]))
        extra = [("random", a, b) for a, b, _ in random_spans(text or "", vocabulary, base, 2.2)]
        line = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]])))
        want.append((doc, *[sum(s[0] == k for s in base) for k in KINDS[:3]], hashlib.sha256(line(base).encode()).hexdigest(), line(base + extra)))
    assert got == sorted(want, key=str) and sum("random" in r[-1] for r in got) >= 3
    assert secret_digests(scan_secrets(docs.limit(0), PATH, PATTERN)).count() == 0
