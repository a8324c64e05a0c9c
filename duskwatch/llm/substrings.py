"""Operator 3: repeated passages by Relative Lempel-Ziv parsing against indexed reference blocks.

A document is parsed against everything with a smaller doc_id. Its factors are the longest stretches of words that the
index holds block after block from one source; a reference block is a run of ``window`` words. Factors of at least that length become
duplicate spans, and where one factor ends the next block is looked up all the same, so a repeat that runs over a factor's boundary is not lost.

Indexing every block of a corpus would shuffle every word position, so blocks are found through anchors first: the anchor of a
block is the smallest hash among its runs of ``gram`` words. Equal blocks have equal anchors, one position in about six is an
anchor, and an anchor that only one document holds rules out all its blocks. Blocks of shared anchors go into the index with a 96-bit
hash of all their words. Counts are minima and maxima, combined before the shuffle; a passage that a third of all documents share
is a hot key of joins only, which AQE splits.

Defined cases: null and empty texts have no words and lose none; texts of fewer words than a window lose none; rows with one doc_id do
not count as earlier than each other; a row without a doc_id neither loses words nor makes others lose any; ``repeated_words`` leaves extra
columns out, ``remove_repeats`` keeps them; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duskwatch.llm.batches import byte_slices, byte_texts, plain_words
from duskwatch.llm.simhash import text_key
from duskwatch.llm.tables import fold, release, settle, unfold

GRAM = 4
_HASHES = np.dtype([("w1", "<i8"), ("w2", "<i4")])  # 96 bits of a block
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# Odd multipliers of the rolling hashes and of the final mix.
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _runs(words: np.ndarray, length: int, step: np.uint64) -> np.ndarray:
    """Hash of the ``length`` words from every position on; one value per position that has so many."""
    n = max(0, len(words) - length + 1)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = out * step + words[j:j + n]
    out ^= out >> np.uint64(32)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


class Parsed:
    """Word hashes of a slice of texts, their windows, and every window's anchor."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        from xxhash import xxh3_64_intdigest

        self.window, words, counts = window, [], []
        for text in texts:
            own = plain_words(text)
            words += own
            counts.append(len(own))
        self.counts = np.asarray(counts, np.int64)
        self.begin = np.cumsum(self.counts) - self.counts
        self.hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
        grams = _runs(self.hashes, gram, _STEP[0])
        n = max(0, len(words) - window + 1)
        low, at = grams[:n].copy(), np.arange(n)
        for j in range(1, window - gram + 1):
            less = grams[j:j + n] < low
            low[less] = grams[j:j + n][less]
            at[less] = np.flatnonzero(less) + j
        # windows that lie inside one text
        per_text = np.maximum(0, self.counts - window + 1)
        self.text = np.repeat(np.arange(len(texts)), per_text)
        self.start = np.arange(len(self.text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        self.place = self.begin[self.text] + self.start
        self.anchor, self.anchor_at = low[self.place], at[self.place]

    def window_hashes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of the windows at ``rows``, as a long and an int."""
        places = self.place[rows]
        first = _runs(self.hashes, self.window, _STEP[0])[places] if len(places) else np.zeros(0, np.uint64)
        second = _runs(self.hashes, self.window, _STEP[1])[places] if len(places) else np.zeros(0, np.uint64)
        return first.view(np.int64), (second >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, doc_id, key), each once per text and slice."""
    def run(batches):
        for part in byte_slices(batches, "text"):
            parsed = Parsed(byte_texts(part, "text"), window, gram)
            if not len(parsed.text):
                continue
            fresh = np.concatenate([[True], (parsed.anchor_at[1:] != parsed.anchor_at[:-1]) | (parsed.text[1:] != parsed.text[:-1])])
            text, anchor = parsed.text[fresh], parsed.anchor[fresh]
            order = np.lexsort((anchor, text))
            text, anchor = text[order], anchor[order]
            once = np.concatenate([[True], (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])])
            owner = pa.array(text[once])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[once].view(np.int64)), part.column("doc_id").take(owner), part.column("key").take(owner)], ["anchor", "doc_id", "key"])

    return docs.select("doc_id", "key", "text").mapInArrow(run, "anchor bigint, doc_id bigint, key bigint")


def _blocks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Groups of blocks in a row that have one shared anchor, with doc_id, key, first start and how many they are.

    The outer two blocks hold all words of a group, so their hashes name it (g1, g2, n). ``hashes`` has 12 bytes for each block.
    ``docs`` has the shared anchors as ``anchors``.
    """
    def run(batches):
        for part in byte_slices(batches, "text"):
            parsed, shared = Parsed(byte_texts(part, "text"), window, gram), part.column("anchors")
            # an anchor counts for the text whose document shares it
            owner = np.repeat(np.arange(part.num_rows), shared.value_lengths().to_numpy(zero_copy_only=False))
            known = np.rec.fromarrays([owner, shared.flatten().to_numpy(zero_copy_only=False)], names="t,a")
            mine = np.rec.fromarrays([parsed.text, parsed.anchor.view(np.int64)], names="t,a")
            rows = np.flatnonzero(_in(mine, known))
            if not len(rows):
                continue
            w1, w2 = parsed.window_hashes(rows)
            both = np.empty(len(rows), _HASHES)
            both["w1"], both["w2"] = w1, w2
            cut = np.flatnonzero((np.diff(parsed.anchor_at[rows]) != 0) | (np.diff(parsed.text[rows]) != 0)) + 1
            begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(rows)]])
            data, step = both.tobytes(), _HASHES.itemsize
            text = pa.array(parsed.text[rows[begin]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1[begin]), pa.array(w1[end - 1] ^ w2[end - 1]), pa.array((end - begin).astype(np.int32)),
                 part.column("doc_id").take(text), part.column("key").take(text), pa.array(parsed.start[rows[begin]].astype(np.int32)),
                 pa.array([data[i * step:j * step] for i, j in zip(begin.tolist(), end.tolist())], pa.binary())],
                ["g1", "g2", "n", "doc_id", "key", "start", "hashes"])

    return docs.mapInArrow(run, "g1 bigint, g2 bigint, n int, doc_id bigint, key bigint, start int, hashes binary")


def _single_blocks(groups: DataFrame) -> DataFrame:
    """One row per block (w1, w2) of the groups."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n").to_numpy()
            both = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), _HASHES)
            owner = pa.array(np.repeat(np.arange(len(n)), n))
            step = np.arange(len(both)) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(batch.column("start").to_numpy(), n) + step
            yield pa.RecordBatch.from_arrays(
                [pa.array(both["w1"].copy()), pa.array(both["w2"].copy()), batch.column("doc_id").take(owner),
                 batch.column("key").take(owner), pa.array(start.astype(np.int32))], ["w1", "w2", "doc_id", "key", "start"])

    return groups.select("n", "doc_id", "key", "start", "hashes").mapInArrow(
        run, "w1 bigint, w2 int, doc_id bigint, key bigint, start int")


def _in(mine: np.recarray, known: np.recarray) -> np.ndarray:
    """Which (text, anchor) pairs of ``mine`` are in ``known``; both have texts 0, 1, ... in order."""
    out = np.zeros(len(mine), bool)
    if not len(mine) or not len(known):
        return out
    order = np.lexsort((known.a, known.t))
    # one sorted key per pair: the rank of the anchor among all, and the text
    values, rank = np.unique(known.a, return_inverse=True)
    keys = known.t[order] * np.int64(len(values)) + rank[order]
    at = np.minimum(np.searchsorted(values, mine.a), len(values) - 1)
    there = values[at] == mine.a
    wanted = mine.t * np.int64(len(values)) + at
    found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return there & (keys[found] == wanted)


def factor(starts: np.ndarray, sources: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(first word, words, source) of every factor: blocks one after another that the index holds from one source."""
    if not len(starts):
        return []
    cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(sources) != 0)) + 1
    begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(starts)]]) - 1
    return list(zip(starts[begin].tolist(), (starts[end] - starts[begin] + window).tolist(), sources[begin].tolist()))


def add_factors(docs: DataFrame, window: int = 13, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``_starts``, ``_runs`` and ``_sources``: runs of blocks that an earlier document holds, and one that does.

    Groups of blocks that are equal as a whole are settled first, which takes all copies but the first out of the way. The first of
    each may still share single blocks with an earlier document; those are looked up one by one.
    """
    gram = min(gram, window)
    base = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       text_key().alias("key")).where("doc_id is not null")
    anchors = _anchors(base, window, gram)
    shared = settle(anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor"),
                    "anchors")
    per_doc = settle(anchors.join(shared, "anchor", "left_semi").groupBy("doc_id", "key").agg(F.collect_set("anchor").alias("anchors")), "anchors")
    release(shared)
    groups = settle(_blocks(base.join(per_doc, ["doc_id", "key"]), window, gram), "blocks")
    release(per_doc)
    # written, so that both sides of the join are plain shuffles and AQE can split a group that many documents share
    first = settle(groups.groupBy("g1", "g2", "n").agg(F.min("doc_id").alias("source")), "first")
    new = F.col("doc_id") == F.col("source")
    known = settle(groups.join(first, ["g1", "g2", "n"]).select(
        "n", "doc_id", "key", "start", "source", F.when(new, F.col("hashes")).alias("hashes")), "groups")
    release(groups)
    release(first)
    single = _single_blocks(known.where("hashes is not null"))
    earliest = settle(single.groupBy("w1", "w2").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
                      .where("source < last").drop("last"), "earliest")
    singles = single.join(earliest, ["w1", "w2"]).where("doc_id > source").select("doc_id", "key", "start", F.lit(1).alias("n"), "source")
    wholes = known.where("hashes is null").select("doc_id", "key", "start", "n", "source")
    hits = settle(singles.unionAll(wholes).groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"))
                  .agg(F.sort_array(F.collect_set(F.struct("start", "n", "source"))).alias("_hits")), "factors")
    release(known)
    release(earliest)
    return (docs.join(hits, (F.col("doc_id") == F.col("_doc")) & (text_key() == F.col("_key")), "left")
            .withColumn("_starts", F.coalesce(F.col("_hits.start"), F.array().cast("array<int>")))
            .withColumn("_runs", F.coalesce(F.col("_hits.n"), F.array().cast("array<int>")))
            .withColumn("_sources", F.coalesce(F.col("_hits.source"), F.array().cast("array<bigint>"))).drop("_doc", "_key", "_hits"))


def _kept(n: int, runs: tuple[list[int], list[int], list[int]], window: int) -> np.ndarray:
    """Which of ``n`` words stay, given (starts, runs, sources) of the blocks that are repeats."""
    starts, counts, sources = (np.array(x, np.int64) for x in runs)
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    covered = np.zeros(n + 1, np.int64)
    for at, length, _ in factor(np.repeat(starts, counts) + step, np.repeat(sources, counts), window):
        covered[at] += 1
        covered[at + length] -= 1
    return np.cumsum(covered)[:n] == 0


def _runs_of(part: pa.RecordBatch) -> list[tuple[list[int], list[int], list[int]]]:
    return list(zip(*(part.column(c).to_pylist() for c in ("_starts", "_runs", "_sources"))))


def repeated_words(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by blanks)."""
    def digest(batches):
        for part in byte_slices(batches, "text"):
            rows = []
            for text, runs in zip(byte_texts(part, "text"), _runs_of(part)):
                words = plain_words(text)
                n = len(words)
                if runs[0]:
                    keep = _kept(n, runs, window)
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                rows.append((n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
            n, gone, sha = zip(*rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return add_factors(narrow, window).mapInArrow(digest, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def cut_text(text: bytes, runs: tuple[list[int], list[int], list[int]], window: int) -> bytes:
    """``text`` without the words of its factors: kept stretches as they are, joined by one blank."""
    places = [m.span() for m in _WORD.finditer(text)]
    keep = _kept(len(places), runs, window)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], keep.astype(np.int8), [0]]))).reshape(-1, 2)
    return b" ".join(text[places[a][0]:places[b - 1][1]] for a, b in edges.tolist())


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """The documents, all columns, without their repeated passages. A text that loses nothing stays byte for byte; a document that loses
    all its words goes; n_chars, where there is one, counts the characters of the new text."""
    plain = fold(docs, "doc_id", "text", "n_chars").withColumn("text", F.col("text").cast("string"))

    def cut(batches):
        for part in byte_slices(batches, "text"):
            texts = part.column("text").to_pylist()
            for row, runs in enumerate(_runs_of(part)):
                if runs[0]:
                    texts[row] = cut_text(texts[row].encode(), runs, window).decode()
            at = part.schema.names.index("text")
            columns = [pa.array(texts, pa.string()) if i == at else part.column(i) for i in range(part.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    found = add_factors(plain, window)
    out = found.mapInArrow(cut, StructType(found.schema.fields)).where((F.size("_starts") == 0) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        new = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size("_starts") > 0, new).otherwise(F.col("n_chars")))
    return unfold(out, docs.columns, "doc_id", "text", "n_chars")
