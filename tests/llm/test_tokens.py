"""Operators 1 and 7: encoding, the file format, packing."""

import os
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from duskwatch.llm import packing, simple8b
from duskwatch.llm.queries import tokenizer_path
from duskwatch.llm.token_files import encode_and_index, read_token_files, token_index, write_token_files
from duskwatch.llm.tokens import WordTokens
from duskwatch.session import new_scratch
from tests.llm.brute import crc

HARD = ["", "  ", "don't we'll. (it's) 'tis!", "x<|endoftext|>y <|ENDOFTEXT|>", "naïve—café, 12.5% a b\x1cc", "İ H̱ é. ΑΣ.",
        "a" * 500 + "." * 300, "日本語。ok", "abc.def,ghi;;'s", "\x00\x01 a\x0bb\xa0c", "É ÀÎ œuvre Straße ŉa ſ ı I"]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def tokens():
    return WordTokens(tokenizer_path())


def whole(tokens, text, end):
    return tokens.tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_ids_of_whole_texts(tokens, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + HARD
    ids, counts = tokens.encode([t.encode() for t in texts], 7)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at:at + n].tolist() == whole(tokens, text, 7)
        at += n


def test_any_other_tokenizer_encodes_whole_texts(tokens):
    other = WordTokens(tokenizer_path("byte_bpe_50k.json"))
    assert tokens.by_word and not other.by_word
    texts = HARD + ["Hello World", "  two  blanks", "tab\there"]
    ids, counts = other.encode([t.encode() for t in texts], 7)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [whole(other, t, 7) for t in texts]
    assert whole(other, "Hello World", 7) == [15496, 2159, 7]


def test_a_repeated_word_is_looked_up_once_a_slice(tokens):
    """Words are counted off over bytes; one object and one look-up for each of them was most of the time of known words."""
    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    own = WordTokens(tokenizer_path())
    own.known = Counted(own.known)
    text = " ".join(f"{'abcde'[k % 5]}word{',.!'[k % 4:][:1]}" for k in range(20_000))
    for _ in range(2):
        ids, counts = own.encode([text.encode()], 7)
        assert ids.tolist() == whole(tokens, text, 7) and counts.tolist() == [len(ids)]
    assert own.known.asked == 2 * (5 + 3)  # words and marks


def test_punctuation_after_accented_words_is_looked_up(tokens, monkeypatch):
    """Such words went whole through the library's normaliser and splitter, which costs several times more than its model."""
    own, plain = WordTokens(tokenizer_path()), []
    monkeypatch.setattr(own, "encode_plain", lambda piece: plain.append(piece) or tokens.encode_plain(piece))
    texts = ["Coñadó, naïveté! (été)... café; ", "déjà?\nœuvre_ É. Straße, Straß."]
    ids, counts = own.encode([t.encode() for t in texts], 7)
    assert ids.tolist() == [i for t in texts for i in whole(tokens, t, 7)] and len(counts) == 2
    assert [p.decode() for p in plain if not p.isascii()] == ["(été)..."]


def test_texts_of_blanks_and_leading_punctuation(tokens):
    texts = ["...", "", " ", "\n\na. ", ".a", "a.", "x\ty\x0b\x0cz!\r\n", "!" * 300 + " " + "b" * 300 + "!" * 300, "", "?"]
    ids, counts = tokens.encode([t.encode() for t in texts], 7)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [whole(tokens, t, 7) for t in texts]
    assert [len(part) for part in tokens.encode([], 7)] == [0, 0]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=400))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words, offsets, escapes = simple8b.encode(values)
    assert (simple8b.decode(words, offsets, escapes, len(values)) == values).all()


def test_simple8b_packs_and_blocks_stand_alone():
    values = np.arange(1000, dtype=np.uint64) % 2
    words, offsets, _ = simple8b.encode(values)
    assert len(words) == 7 * 3 + 2  # 60, 60 and 8 values to a block of 128; the last block has 104
    block = simple8b.decode(words[offsets[3]:offsets[4]], np.zeros(1, np.uint32), np.zeros(0, np.uint64), 128)
    assert (block == values[384:512]).all()


def test_simple8b_chooses_selectors_in_little_memory():
    """Selectors are told from one byte a value; places of eight bytes for each of them cost time and memory several times over."""
    values = np.arange(200_000, dtype=np.uint32) * 7919 % 49_000
    tracemalloc.start()
    try:
        words, offsets, escapes = simple8b.encode(values)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (simple8b.decode(words, offsets, escapes, len(values)) == values).all()
    assert peak < 50 * len(values)


def test_simple8b_words_are_the_greedy_ones():
    """The first selector, in the order of its counts, whose values all fit; to the end of a block."""
    rng = np.random.default_rng(5)
    for n, block in ((1, 128), (129, 128), (300, 7), (500, 60), (640, 64)):
        values = rng.integers(0, 1 << 63, n, dtype=np.uint64) >> rng.integers(0, 64, n).astype(np.uint64)
        values[rng.random(n) < 0.6] &= np.uint64(3)
        want, at = [], 0
        while at < n:
            end = min(at // block * block + block, n)
            k = next((k for k in range(14) if (values[at:min(at + simple8b.COUNTS[k], end)] >> simple8b.BITS[k] == 0).all()), simple8b.ESCAPE)
            want.append(k)
            at = min(at + int(simple8b.COUNTS[k]), end)
        words, offsets, escapes = simple8b.encode(values, block)
        assert (words >> np.uint64(60)).tolist() == want
        assert (simple8b.decode(words, offsets, escapes, n, block) == values).all()


def test_files_round_trip(spark, tokens):
    rows = [(k * 3, t) for k, t in enumerate(HARD)] + [(1, None), (None, "no id"), (4, "tie b"), (4, "tie a"), (9000, "word " * 40_000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as shard", "'x' as ids").repartition(3)
    path = new_scratch(spark, "files")
    write_token_files(docs, path, tokenizer_path(), 1)
    found = sorted(read_token_files(spark, path).collect(), key=lambda r: (r["shard"], r["file"], r["place"]))
    key = lambda text: (xxh64_intdigest(text or "", 42) ^ 1 << 63)  # noqa: E731  order of the signed hash
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key(r[1])))
    assert [r["doc_id"] for r in found] == [r[0] for r in want]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == [whole(tokens, t, 1) for _, t in want]
    assert any(f.startswith("part-") for f in os.listdir(path.replace("file://", "")))
    index = encode_and_index(docs, tokenizer_path(), 1).orderBy("start").collect()
    start = 0
    for row, (doc, text) in zip(index, want, strict=True):
        ids = whole(tokens, text, 1)
        assert tuple(row) == (doc, start, len(ids), crc(ids))
        start += len(ids)


def test_large_shards_are_several_files_and_a_shared_doc_id_is_split(spark, tokens):
    rows = [(7, "word " * 200_000)] * 4 + [(7, None)] * 500 + [(8, "last one")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    path = new_scratch(spark, "files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tasks stay apart, as large ones do
    write_token_files(docs, path, tokenizer_path(), 1, file_segments=1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = read_token_files(spark, path)
    assert found.select("shard").distinct().count() > 2  # one doc_id, several tasks
    assert found.select("shard", "file").distinct().count() > found.select("shard").distinct().count()
    index = token_index(spark, path).orderBy("start").collect()
    start = 0
    for row in index:
        assert row["start"] == start
        start += row["n_tokens"]
    want = sorted((d, len(ids), crc(ids)) for d, t in rows for ids in [whole(tokens, t, 1)])
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in index) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert encode_and_index(docs, tokenizer_path()).count() == 0
    assert packing.pack_documents(docs, tokenizer_path()).count() == 0


@given(st.lists(st.integers(1, 60), max_size=60))
@settings(max_examples=100, deadline=None)
def test_plans_cover_and_never_overfill(lengths):
    counts = {s: lengths.count(s) for s in set(lengths)}
    plan, used = packing.plan_sequences(counts, 60), {}
    for filling, times in plan:
        assert sum(filling) <= 60
        for size in filling:
            used[size] = used.get(size, 0) + times
    assert used == counts
    assert packing.lower_bound(counts, 60) <= sum(t for _, t in plan)


def fewest(sizes, capacity):
    """Exact number of bins by trying every bin for every piece."""
    best = [len(sizes)]

    def put(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms) if r >= sizes[k]}.values():
            rooms[i] -= sizes[k]
            put(k + 1, rooms)
            rooms[i] += sizes[k]
        put(k + 1, rooms + [capacity - sizes[k]])

    put(0, [])
    return best[0]


@given(st.lists(st.integers(3, 20), min_size=1, max_size=9))
@settings(max_examples=60, deadline=None)
def test_small_plans_are_optimal(lengths):
    counts = {s: lengths.count(s) for s in set(lengths)}
    assert sum(t for _, t in packing.plan_sequences(counts, 30)) == fewest(sorted(lengths, reverse=True), 30)


def test_best_fit_alone_is_improved():
    # best fit puts 10+10+... together and needs a sequence more than the fillings 13+7+10, 13+7+10
    counts = {13: 2, 10: 2, 7: 2}
    assert sum(t for _, t in packing.plan_sequences(counts, 30)) == 2


def test_packing_places_every_piece(spark, tokens):
    rows = [(k, t) for k, t in enumerate(HARD)] + [(50, "word " * 700), (50, "word " * 700), (51, None), (None, "x y")] + [
        (100 + k, "a b c " * (k % 7)) for k in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as length", "2 as sequence_id").repartition(5)
    found = packing.pack_documents(docs, tokenizer_path(), capacity=256, end_id=0).toPandas()
    want = sorted((doc if doc is not None else -1, p, crc(ids[p * 256:p * 256 + 256]), len(ids[p * 256:p * 256 + 256]))
                  for doc, text in rows for ids in [whole(tokens, text, 0)] for p in range(-(-len(ids) // 256)))
    got = sorted((int(d) if d == d else -1, p, c, n) for d, p, c, n in
                 zip(found.doc_id, found.piece, found.ids_crc32, found.length))
    assert got == want
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert (group.offset == group.length.cumsum() - group.length).all() and group.length.sum() <= 256
    assert found.sequence_id.nunique() == packing.lower_bound(found.length.value_counts().to_dict(), 256)


def test_plans_are_close_to_the_bound():
    gen = np.random.default_rng(1)
    for n, low, high, most in ((20_000, 500, 860, 6740), (2000, 500, 860, 690), (2000, 100, 500, 300)):
        lengths = gen.integers(low, high + 1, n).tolist()
        counts = {s: lengths.count(s) for s in set(lengths)}
        plan = packing.plan_sequences(counts, 2048, budget=2000)
        assert packing.lower_bound(counts, 2048) <= packing.used(plan) <= most
        placed = {}
        for filling, times in plan:
            assert sum(filling) <= 2048
            for size in filling:
                placed[size] = placed.get(size, 0) + times
        assert placed == counts


def test_dominance():
    assert packing.dominates((9, 6), (9, 5)) and packing.dominates((9, 6), (9, 4, 2)) and packing.dominates((9, 6, 3), (9, 3, 3, 3))
    assert not packing.dominates((9, 5), (9, 6)) and not packing.dominates((9, 4, 2), (9, 6)) and not packing.dominates((9, 4, 4), (9, 5, 3))
