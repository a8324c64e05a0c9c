"""Operator 2: SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; a bit is set if it is set in over half of the XXH64 hashes (seed 42) of the document's
word shingles. Two fingerprints within distance 2 have a value in the middle that is within distance 1 of both. So every distinct
fingerprint emits the 65 values within distance 1, rows are shuffled on those, and whoever meets there is a candidate. A bucket is kept
as a 64-bit mask of the flipped bits that arrived plus a flag for the value itself: that is its member list without repeats, 65 at most however
large the corpus, and it is combined before the shuffle. Pairs of a bucket are verified by their distance and linked to its first member,
then components are formed over distinct fingerprints.

Defined cases: null and empty texts have fingerprint zero and link like any other; texts of fewer words than a shingle have one shingle, the whole
sequence; rows sharing a doc_id are separate documents; a null doc_id takes its component's smallest doc_id (null if it has none);
extra columns are left out by ``near_duplicates`` and kept by ``keep_one``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskwatch.llm.batches import LOWER_TABLE, byte_slices, byte_texts
from duskwatch.llm.components import components
from duskwatch.llm.tables import fold, settle, unfold

SEED = 42
_LANES = 128  # hashes added up in 8-bit lanes before they are widened
# _SPREAD[b] has bit i of b in byte lane i
_SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER_TABLE).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """uint64 fingerprint of every text."""
    hashes, counts = [], []
    for text in texts:
        own = shingle_hashes(text, shingle)
        hashes += own
        counts.append(len(own))
    counts = np.asarray(counts, np.int64)
    out = np.zeros(len(texts), np.uint64)
    live = np.flatnonzero(counts)
    if not len(live):
        return out
    lanes = _SPREAD[np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)]
    # runs of at most _LANES hashes of one text
    runs = -(-counts[live] // _LANES)
    begin = np.repeat(np.cumsum(counts[live]) - counts[live], runs)
    nth = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    sums = np.add.reduceat(lanes, begin + nth * _LANES, axis=0)
    wide = sums.view(np.uint8).reshape(len(sums), 64).astype(np.int64)
    totals = np.add.reduceat(wide, np.cumsum(runs) - runs, axis=0)
    bits = totals * 2 > counts[live][:, None]
    out[live] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def add_fingerprints(docs: DataFrame, shingle: int, *kept: str) -> DataFrame:
    """The columns ``kept`` and fp (the 64 bits as a signed long) of every row."""
    def run(batches):
        for part in byte_slices(batches, "text"):
            fp = fingerprints(byte_texts(part, "text"), shingle)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(fp.view(np.int64))], [*kept, "fp"])

    rows = docs.select(*kept, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([*[rows.schema[c] for c in kept], T.StructField("fp", T.LongType())]))


def text_key():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def ball_links(prints: DataFrame) -> DataFrame:
    """(a, b): distinct fingerprints of ``fp`` that differ in one or two bits, enough of the pairs to connect all that do."""
    one = F.lit(1).cast("bigint")
    flips = F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")
    variants = prints.select("fp", flips).select(
        F.when(F.col("bit") < 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(F.expr("shiftleft(1L, bit)"))).alias("middle"),
        F.when(F.col("bit") < 0, F.lit(0).cast("bigint")).otherwise(F.expr("shiftleft(1L, bit)")).alias("mask"),
        F.when(F.col("bit") < 0, one).otherwise(F.lit(0).cast("bigint")).alias("own"))
    buckets = variants.groupBy("middle").agg(F.bit_or("mask").alias("mask"), F.max("own").alias("own")).where(
        F.bit_count("mask") + F.col("own") > 1)
    members = F.filter(F.sequence(F.lit(-1), F.lit(63)), lambda i: F.when(i < 0, F.col("own") == 1).otherwise(
        F.getbit(F.col("mask"), F.greatest(i, F.lit(0))) == 1))
    values = F.transform(members, lambda i: F.when(i < 0, F.col("middle")).otherwise(
        F.col("middle").bitwiseXOR(F.call_function("shiftleft", one, F.greatest(i, F.lit(0))))))
    pairs = buckets.select(values.alias("v")).select(F.col("v")[0].alias("a"), F.explode(F.slice("v", 2, 64)).alias("b"))
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)


def _labelled(docs: DataFrame, shingle: int, *kept: str) -> DataFrame:
    """``kept`` columns, fp, root (of the fingerprint's component) and component_id of every row."""
    rows = settle(add_fingerprints(docs, shingle, *kept), "fingerprints")
    prints = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = components(ball_links(prints), "a", "b")
    rooted = prints.join(roots, prints.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    classes = settle(
        rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "root", "component_id"), "classes")
    return rows.join(classes, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links of at most 2 bits)."""
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _labelled(named, shingle, "doc_id").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The documents, all columns, one row of every component: the one with the smallest doc_id (nulls last), then text hash, then row.

    Rows are told apart by a number that is stored with them, so rows that repeat a doc_id or have none go like any other.
    """
    rows = settle(fold(docs, "doc_id", "text").withColumn("at", F.monotonically_increasing_id()), "rows")
    labelled = settle(_labelled(rows.select("doc_id", "text", text_key().alias("key"), "at"), shingle, "doc_id", "key", "at"), "labelled")
    first = labelled.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "at")).alias("first"))
    gone = settle(labelled.join(first, "root").where("at != first.at").select("at"), "gone")
    return unfold(rows.join(gone, "at", "left_anti"), docs.columns, "doc_id", "text")
