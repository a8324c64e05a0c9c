"""Operator 11 against loops over the tokenizers' own results, and the laws of its monoid."""

import collections
import hashlib
import random
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duskwatch.llm.alignment import NUMBERS, Fragment, align_documents, cut_ranges, fragment_of
from duskwatch.llm.pair_tokens import PairTokens

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [" ", " ", " ", "  ", "\n", "\t", "\r", "\x1c", "\xa0", "　", "a", "b", "é", "ß", "中", "文", "😀", "́", ".", ",", "!", "'s", "'", "12", "3",
            "the", "Hello", "und", "tion", "<s>", "<|endoftext|>", "▁", "᠎", "ſ", "​", "\x00", "_", "²"]


@pytest.fixture(scope="module")
def tokens():
    return PairTokens(*PATHS)


def odd_texts(seed, n, length):
    pick = random.Random(seed)
    return ["".join(pick.choices(ALPHABET, k=pick.randrange(0, length))) for _ in range(n)]


def whole(tokens, text):
    """Ids by one call to each library; none where the joined bytes are not the text's."""
    a = tokens.a.encode(" " + text, add_special_tokens=False).ids
    b = tokens.b.encode(text)
    raw = (" " + text).encode()
    same = b"".join(tokens.bytes_a[i] for i in a) == raw == b"".join(tokens.bytes_b[i] for i in b)
    return (a, b) if text and same else ([], [])


def test_lookup_agrees_with_the_libraries(tokens):
    texts = odd_texts(2, 4000, 25) + ["", " ", "  ", "\n", " \n", "x ", "x\n", "y" * 700, "中" * 300]
    for step in range(0, len(texts), 500):
        part = texts[step:step + 500]
        ids_a, n_a, ids_b, n_b, _ = tokens.encode([" " + t if t else "" for t in part])
        ends = np.cumsum(n_a), np.cumsum(n_b)
        got = [(ids_a[e - n:e].tolist(), ids_b[f - m:f].tolist()) for e, n, f, m in zip(ends[0], n_a, ends[1], n_b)]
        assert got == [whole(tokens, t) for t in part]


def test_every_byte_is_spelled_and_punctuation_is_no_part_of_a_word(tokens):
    spelled = {x for x in tokens.bytes_a if len(x) == 1}
    assert spelled >= {bytes([b]) for b in range(256)}
    asked = []
    library = tokens.a

    class Model:
        def tokenize(self, word):
            asked.append(word)
            return library.model.tokenize(word)

    class Recorded:
        model = Model()
        encode_batch_fast = library.encode_batch_fast

    fresh = PairTokens(*PATHS)
    fresh.a = Recorded()
    texts = ["one", "two,", "three...", "n\u00e9e", "(four)", "it's"]
    ids_a, n_a, _, _, good = fresh.encode([" " + t for t in texts])
    assert [x.tolist() for x in np.split(ids_a, np.cumsum(n_a)[:-1])] == [whole(tokens, t)[0] for t in texts] and good.all()
    assert asked == ["\u0120one", "\u0120n\u00c3\u00a9e"]


def aligned(tokens, texts):
    """Rows of the query by loops."""
    found = []
    for text in texts:
        a, b = whole(tokens, text or "")
        spans = []
        for ids, table in ((a, tokens.bytes_a), (b, tokens.bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i])))
                at += len(table[i])
            spans.append(own)
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = ["|".join(",".join(str(i) for i, (_, e) in zip(ids, own) if low < e <= high) for ids, own in zip((a, b), spans))
                  for low, high in zip([0] + common, common)]
        links = [(i, j) for i, (u, v) in zip(a, spans[0]) for j, (x, y) in zip(b, spans[1]) if x < v and u < y]
        found.append((len(a), len(b), groups, links))
    counts = collections.Counter(link for row in found for link in row[3])
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "", ";".join(groups)) for n_a, n_b, groups, links in found]


def test_documents_whole_and_in_ranges(spark, tokens):
    pick = random.Random(4)
    texts = odd_texts(3, 150, 60) + ["", " ", None, "a▁b", "x" * 900, "中文" * 200, " ".join(pick.choices(["ab", "cde", "né", "f.", "(g)"], k=300))] * 2
    rows = [(k if k % 17 else None, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as row", "'g' as groups").repartition(5)
    want = [(doc, *row) for (doc, _), row in zip(rows, aligned(tokens, texts))]
    for size in (1 << 16, 64, 300):
        got = align_documents(docs, *PATHS, range_bytes=size, digest=True).select("doc_id", *NUMBERS, "groups").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(str(w[:-1]) for w in want), size
    got = align_documents(docs, *PATHS, range_bytes=300).select("doc_id", *NUMBERS, "groups").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(w[:-2] + w[-1:]) for w in want)
    assert align_documents(docs.limit(0), *PATHS).count() == 0


def test_ranges_hold_what_both_tokenizers_need(tokens):
    for text in odd_texts(6, 60, 400) + ["word " * 500, "x" * 3000 + " y " + "z" * 900]:
        raw = (" " + text).encode()
        ranges = list(cut_ranges(raw, 100))
        assert [r[0] for r in ranges] == [0] + [r[1] for r in ranges[:-1]] and ranges[-1][1] == len(raw)
        assert all(raw[base:base + len(piece)] == piece and base <= begin and end <= base + len(piece) for begin, end, base, piece in ranges)
        assert sum(len(r[3]) for r in ranges) <= 3 * len(raw) + 1000


ends = st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), min_size=1, max_size=30)


@settings(max_examples=150, deadline=None)
@given(ends, st.lists(st.integers(1, 60), max_size=6), st.randoms(use_true_random=False))
def test_composition_is_associative(sizes, edges, pick):
    """Any cut into ranges, composed in any order, gives the groups of the whole."""
    sizes_a, sizes_b = np.array([s for s, _ in sizes]), np.array([s for _, s in sizes])
    short = sizes_a.sum() - sizes_b.sum()
    sizes_a, sizes_b = (np.append(sizes_a, max(-short, 0) + 1), np.append(sizes_b, max(short, 0) + 1))
    ids, total = np.arange(len(sizes_a)), int(sizes_a.sum())
    places = [0, *sorted({e for e in edges if e < total}), total]

    def pieces(places):
        return [fragment_of(ids, ids, sizes_a, sizes_b, 0, low, high, k) for k, (low, high) in enumerate(zip(places, places[1:]))]

    made = pieces(places)
    row = [f for f, _, _ in made]
    left = reduce(Fragment.__add__, row)
    while len(row) > 1:
        k = pick.randrange(len(row) - 1)
        row[k:k + 2] = [row[k] + row[k + 1]]
    assert row[0] == left
    (one, rest_a, rest_b), = pieces([0, total])
    every = lambda side, closed, made: sorted(i for part in closed for i in part[side + 1]) + [
        i for _, *inner in made for i in inner[side].tolist()]
    assert left.cut and left.suffix == ([], []) and left.prefix == one.prefix
    for side, rest in enumerate((rest_a, rest_b)):
        assert sorted(every(side, left.closed, made)) == rest.tolist()
    for _, a, b in left.closed:  # what composition closes is one group
        at_a, at_b = np.cumsum(sizes_a)[a], np.cumsum(sizes_b)[b]
        assert at_a[-1] == at_b[-1] and not set(at_a[:-1]) & set(at_b[:-1])
