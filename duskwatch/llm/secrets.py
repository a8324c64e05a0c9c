"""Operator 13: secret scans with a token-efficiency test.

Base patterns find assignments, access key ids and long hexadecimal runs. Beside them, every unbroken run of key characters is put
through a tokenizer's vocabulary: what people write is made of frequent pieces and takes few tokens, a random string falls apart
into short ones. A run with fewer than ``max_ratio`` characters a token is reported as kind ``random``, unless it is a digest (hexadecimal of a digest's
length, an integrity value, a listed value) or an identifier (a UUID, or words and numbers held together by separators
or by capital letters), or lies inside a base span.

All of it happens in one pass without a shuffle: a text is a row, a run is worked on in pieces of ``_PIECE`` characters.

Defined cases: null and empty texts have no spans; runs and texts of any length are read whole; several kinds may report one place
(base kinds do not see each other); rows that share a doc_id, or have none, stay separate; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.batches import byte_slices, byte_texts, worker_cache

# The base patterns. Letters of the assignment's keyword count in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 or more characters; a shorter run fails from any start in it
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "random")  # order of spans that start at one place
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.I)
INTEGRITY = re.compile(r"sha(256|384|512)[-:=].*", re.I)
# A word or a number: lower-case letters with at most one capital before them, capitals alone, or digits.
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SEPARATORS = re.compile(r"[+/_.=-]+")
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
# base64 digests of the empty input, which many lock files and manifests repeat.
KNOWN_DIGESTS = frozenset({
    "1B2M2Y8AsgTpgAmY7PhCfg==",
    "2jmj7l5rSw0yVb/vlWAYkK/YBwk=",
    "47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=",
})
_PIECE = 4096
_SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,ratio:double>>"


class Vocabulary:
    """Counts the tokens of a string under a public vocabulary of byte ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def shared(cls, path: str, pattern: str) -> "Vocabulary":
        cache = worker_cache().setdefault("vocabularies", {})
        if (path, pattern) not in cache:
            cache[path, pattern] = cls(path, pattern)
        return cache[path, pattern]

    def tokens(self, run: str) -> int:
        return sum(len(self.encoding.encode_ordinary(run[k:k + _PIECE])) for k in range(0, len(run), _PIECE))


def is_digest(run: str, known: frozenset[str] = KNOWN_DIGESTS) -> bool:
    if run in known or INTEGRITY.fullmatch(run):
        return True
    return len(run) in DIGEST_LENGTHS and all(c in "0123456789abcdefABCDEF" for c in run)


def is_identifier(run: str) -> bool:
    """A UUID, or parts between separators that each are words, or words and one number at an end.

    Digits between letters are no identifier's, and neither are more changes of case than one for every three characters.
    """
    if UUID.fullmatch(run):
        return True
    for part in filter(None, SEPARATORS.split(run)):
        words = WORD.findall(part)
        inner = words[1:-1] if len(words) > 2 else []
        if any(w.isdigit() for w in inner) or (len(words) > 2 and len(words) * 3 > len(part)):
            return False
        if len(words) > 1 and words[0].isdigit() and words[-1].isdigit():
            return False
    return True


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns: per kind leftmost and non-overlapping, those that fall short left out."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def random_spans(text: str, vocabulary: Vocabulary, base: list[tuple[str, int, int]], max_ratio: float) -> list[tuple[int, int, float]]:
    """(start, end, characters a token) of the runs that read as random and are no digest, identifier or part of a base span."""
    out = []
    for found in RUN.finditer(text):
        run = found[0].strip(".-")
        start = found.start() + found[0].index(run) if run else 0
        end = start + len(run)
        if len(run) < 16 or any(a <= start and end <= b for _, a, b in base) or is_digest(run) or is_identifier(run):
            continue
        ratio = len(run) / vocabulary.tokens(run)
        if ratio < max_ratio:
            out.append((start, end, ratio))
    return out


def scan_secrets(docs: DataFrame, vocabulary_path: str, pattern: str, max_ratio: float = 2.2) -> DataFrame:
    """doc_id and ``spans``: kind, start and end (code points, end exclusive) by start, then kind; ``ratio`` is null for base kinds."""
    def run(batches):
        vocabulary = Vocabulary.shared(vocabulary_path, pattern)
        order = {kind: k for k, kind in enumerate(KINDS)}
        for part in byte_slices(batches, "text"):
            rows = []
            for raw in byte_texts(part, "text"):
                text = raw.decode("utf-8", "replace")
                base = base_spans(text)
                spans = [(*b, None) for b in base] + [("random", *r) for r in random_spans(text, vocabulary, base, max_ratio)]
                rows.append([dict(zip(("kind", "start", "end", "ratio"), s)) for s in sorted(spans, key=lambda s: (s[1], order[s[0]]))])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in KINDS[:3]], F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))
