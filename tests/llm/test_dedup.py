"""Operators 2, 3 and 5 and the components they share."""

import hashlib
import random

import numpy as np
import pytest

from duskwatch.llm.components import components
from duskwatch.llm.embeddings import link_vectors
from duskwatch.llm.simhash import keep_one, near_duplicates
from duskwatch.llm.substrings import add_factors, remove_repeats, repeated_words
from tests.llm.brute import classes, fingerprint, kept_words, plain_words

SCHEMA = "doc_id bigint, text string"


def texts(seed, n, words=60, vocabulary=400):
    pick = random.Random(seed)
    known = ["".join(pick.choices("abcdeé", k=5)) for _ in range(vocabulary)]
    return [" ".join(pick.choices(known, k=pick.randint(0, words))) for _ in range(n)]


def test_components(spark):
    pick = random.Random(3)
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 160)]
    loose = [(pick.randint(200, 320), pick.randint(200, 320)) for _ in range(70)] + [(7, 7)]
    links = chain + star + loose + [(5, 4)]
    want = classes(330, links)
    rows = spark.createDataFrame(links + [(None, 1)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(rows, "a", "b").collect()}
    assert got == {n: want[n] for pair in links for n in pair if pair[0] != pair[1]}
    words = spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string")
    assert {tuple(r) for r in components(words, "a", "b").collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
    assert components(rows.limit(0), "a", "b").count() == 0


def test_simhash_agrees_with_all_pairs(spark):
    base = texts(1, 40, 200)
    pick = random.Random(2)
    near = []
    for text in base:
        words = text.split()
        for _ in range(2):
            if words:
                words[pick.randrange(len(words))] = "changed"
            near.append(" ".join(words))
    every = base + near + ["", None, "   ", "one", "ONE", "two words", "same text again"] + ["same text again"] * 30
    rows = [(1000 - k, t) for k, t in enumerate(every)] + [(1000, base[0])]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as fp", "'k' as key")
    prints = [fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    of = classes(len(rows), links)
    first = {c: min(rows[k][0] for k in range(len(rows)) if of[k] == c) for c in of}
    want = sorted((rows[k][0], f"{prints[k]:016x}", first[of[k]]) for k in range(len(rows)))
    assert sorted(map(tuple, near_duplicates(docs).collect())) == want
    assert len(set(of)) < len(rows) - 30
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in want})


def test_one_row_stays_of_repeated_and_missing_ids(spark):
    pick = random.Random(4)
    texts = [" ".join("".join(pick.choices("abcdefgh", k=6)) for _ in range(50)) for _ in range(6)]
    long = " ".join("".join(pick.choices("abcdefgh", k=6)) for _ in range(40_000))
    rows = [(1, texts[0])] * 3 + [(None, texts[1])] * 4 + [(None, texts[2]), (9, texts[2]), (9, texts[2]), (5, texts[3]), (5, texts[4]), (7, long), (8, long)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as at", "'r' as root", "2 as fp").repartition(4)
    got = keep_one(docs)
    assert got.columns == docs.columns
    want = [(1, texts[0]), (None, texts[1]), (9, texts[2]), (5, texts[3]), (5, texts[4]), (7, long)]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(want, key=str)
    found = near_duplicates(docs).toPandas()
    assert len(found) == len(rows) and found.component_id.isna().sum() == 4


def test_simhash_with_chains_of_bits(spark):
    """Fingerprints one and two bits apart, in chains, are one component."""
    from duskwatch.llm.simhash import ball_links
    start = 0x0123456789ABCDEF
    values = [start, start ^ 3, start ^ 3 ^ (1 << 63), start ^ 3 ^ (1 << 63) ^ (5 << 20), start ^ 0xFF00]
    rows = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    found = {frozenset((r["a"] % (1 << 64), r["b"] % (1 << 64))) for r in ball_links(rows).collect()}
    assert {frozenset(values[0:2]), frozenset(values[1:3]), frozenset(values[2:4])} <= found
    assert all((a ^ b).bit_count() <= 2 for a, b in map(tuple, found)) and not any(values[4] in f for f in found)


def test_substrings_agree_with_every_window(spark):
    base = texts(5, 60, 80, 60)
    pick = random.Random(9)
    passage = " ".join(texts(6, 1, 60)[0].split()[:30])
    every = []
    for k, text in enumerate(base):
        words = text.split()
        if k % 3 == 0:
            other = base[pick.randrange(len(base))].split()
            at, cut = pick.randint(0, len(words)), pick.randint(0, max(0, len(other) - 20))
            words[at:at] = other[cut:cut + pick.randint(4, 25)]
        if k % 4 == 0:
            words += passage.split()[pick.randint(0, 10):]
        every.append("\n ".join(words))
    every += [base[0]] * 5 + [None, "", " \t", "a b c", "x " * 300, "x " * 20]
    rows = [(k * 2, t) for k, t in enumerate(every)] + [(4, every[1]), (None, base[0]), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as start", "'s' as anchors", "2 as key")
    for window in (13, 5):
        want = kept_words(rows, window)
        expected = sorted(((d if d is not None else -1), len(plain_words(t)), len(plain_words(t)) - len(k), hashlib.sha256(b" ".join(k)).hexdigest())
                          for (d, t), k in zip(rows, want))
        got = sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in repeated_words(docs, window).collect())
        assert got == expected
    assert any(n for _, _, n, _ in expected)


def test_cut_texts_keep_the_rest_as_it_is(spark):
    shared = " ".join(f"w{k}" for k in range(20))
    rows = [(1, f"first\tone\n{shared} end"), (2, f"kept  as\nit is {shared}\nand  this"), (3, shared), (4, "no  repeat\n"), (5, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "length(text) as n_chars", "7 as _starts", "8 as _row")
    got = {r["doc_id"]: r for r in remove_repeats(docs).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert (got[1]["text"], got[4]["text"], got[5]["text"]) == (rows[0][1], rows[3][1], None)
    assert got[2]["text"] == "kept  as\nit is and  this" and got[2]["n_chars"] == len(got[2]["text"])
    assert (got[2]["_starts"], got[2]["_row"]) == (7, 8)
    factors = {r["doc_id"]: r for r in add_factors(docs.select("doc_id", "text")).collect()}
    assert set(factors[3]["_sources"]) == {1} and sum(factors[3]["_runs"]) == 8


def unlinked(rows, threshold=0.93):
    """(n_links, component) by all pairs; None and unsound vectors link with nothing."""
    def sound(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for a, (_, x, p) in enumerate(rows):
        for b in range(a):
            y, q = rows[b][1:]
            if p is not None and p == q and sound(x) and sound(y) and len(x) == len(y):
                x64, y64 = np.array(x), np.array(y)
                if x64 @ y64 / np.linalg.norm(x64) / np.linalg.norm(y64) >= threshold:
                    links.append((a, b))
    return links


@pytest.mark.parametrize("tile", [2048, 7])
def test_embeddings_agree_with_all_pairs(spark, tile):
    gen = np.random.default_rng(4)
    centres = gen.normal(size=(6, 12))
    rows = []
    for k in range(220):
        v = (centres[k % 6] + gen.normal(size=12) * 0.28) * gen.uniform(0.1, 50)
        rows.append((k, v.tolist(), int(k % 3) if k % 11 else None))
    rows += [(300 + k, rows[1][1], 1) for k in range(30)] + [(400, None, 1), (401, [0.0] * 12, 1), (402, [None] + [1.0] * 11, 1),
             (403, [float("nan")] * 12, 1), (404, [float("inf")] + [0.0] * 11, 1), (405, rows[1][1][:5], 1), (406, [1e300] * 12, 2), (407, [1e-300] * 12, 2), (408, [], 1)]
    links = unlinked(rows[:-3]) + [(len(rows) - 3, len(rows) - 2)]
    of = classes(len(rows), links)
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    want = sorted((r[0], int(degree[k]), rows[of[k]][0], of[k] == k) for k, r in enumerate(rows))
    got = link_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 as cid", "2 as tile"), tile=tile)
    assert sorted(map(tuple, got.collect())) == want


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert link_vectors(none).count() == 0
    lone = spark.createDataFrame([(3, None, None)], none.schema)
    assert [tuple(r) for r in link_vectors(lone).collect()] == [(3, 0, 3, True)]


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(none).count() == keep_one(none).count() == repeated_words(none).count() == remove_repeats(none).count() == 0
