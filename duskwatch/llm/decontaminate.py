"""Operator 10: benchmark passages in documents, found by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``window`` words of every benchmark item; an item of fewer words, but not none,
is one pattern of its own length. Patterns of one length share a set of tables: a shift table over blocks of
two words says how far the search may jump, since no pattern can end sooner; where the shift is zero, a bucket chosen
by that block, which is the pattern's end, gives the patterns to compare word by word. Work per text is about words / window probes.

The benchmark is read in slices of about ``slice_bytes`` of text. A slice is broadcast as it is and turned into tables once per worker;
hits of several slices are written slice by slice, so one slice's tables are all that is held at a time (a single item longer than a slice is one slice).
Defined cases: null and empty texts have no words, and hit nothing; null item texts have none; windows of a row without an item_id hit words and name no item;
rows sharing an item_id count as one item; rows sharing a doc_id stay separate; extra columns are left out by ``contamination`` and kept by ``mark_documents``;
an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from duskwatch.llm.batches import byte_slices, byte_texts, letter_words, worker_cache
from duskwatch.llm.tables import fold, settle, unfold

SLICE_BYTES = 16 << 20


class Patterns:
    """Wu-Manber tables of word patterns that have one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.owners: dict[tuple[bytes, ...], set[int]] = {}
        self.shift: dict = {}
        self.buckets: dict = {}

    def add(self, words: list[bytes], item: int | None) -> None:
        owners = self.owners.setdefault(tuple(words), set())
        if item is not None:  # a window of an item without an id hits words and names no item
            owners.add(item)

    def close(self) -> "Patterns":
        m, b = self.length, self.block
        for pattern in self.owners:
            for end in range(b, m + 1):
                key = pattern[end - b:end]
                self.shift[key] = min(self.shift.get(key, m - b + 1), m - end)
            self.buckets.setdefault(pattern[-b:], []).append(pattern)
        return self

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, pattern) of every occurrence."""
        m, n = self.length, len(words)
        longest, shift = m - self.block + 1, self.shift.get
        end = m
        if self.block == 1:
            for at, word in enumerate(words):
                for pattern in self.buckets.get((word,), ()):
                    yield at, pattern
            return
        while end <= n:
            key = (words[end - 2], words[end - 1])
            jump = shift(key, longest)
            if jump:
                end += jump
                continue
            start = end - m
            for pattern in self.buckets[key]:
                if pattern[0] == words[start] and tuple(words[start:end]) == pattern:
                    yield start, pattern
            end += 1


def build_tables(items: list[tuple[int | None, str | None]], window: int) -> list[Patterns]:
    by_length: dict[int, Patterns] = {}
    for item, text in items:
        words = letter_words((text or "").encode())
        for at in range(max(1, len(words) - window + 1) if words else 0):
            part = words[at:at + window]
            by_length.setdefault(len(part), Patterns(len(part))).add(part, item)
    return [p.close() for p in by_length.values()]


def _slices(benchmark: DataFrame, slice_bytes: int) -> list[DataFrame]:
    """The items in parts whose texts have about ``slice_bytes``, by a hash of their rows."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // slice_bytes))
    return [items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) for k in range(parts)]


def _tables(key: str, items, window: int) -> list[Patterns]:
    """Tables of a broadcast slice, built once per worker; those of an earlier slice go."""
    cache = worker_cache().setdefault("wu-manber", {})
    if key not in cache:
        cache.clear()
        cache[key] = build_tables(items.value, window)
    return cache[key]


_NAMES = ["_hit_starts", "_hit_ends", "_hit_items"]


def _hits(rows: DataFrame, items, window: int, hit_only: bool) -> DataFrame:
    """``rows`` with the hits of one slice added; with ``hit_only`` the rows that have any, without their texts."""
    key, kept = uuid.uuid4().hex, [c for c in rows.columns if c != "text" or not hit_only]
    schema = StructType([*(rows.schema[c] for c in kept), *(StructField(n, ArrayType(LongType())) for n in _NAMES)])

    def search(batches):
        patterns = _tables(key, items, window)
        for part in byte_slices(batches, "text"):
            found: list[list[list[int]]] = [[], [], []]
            for text in byte_texts(part, "text"):
                words, spans, owners = letter_words(text), set(), set()
                for table in patterns:
                    for start, pattern in table.occurrences(words):
                        spans.add((start, start + table.length))
                        owners |= table.owners[pattern]
                ordered = sorted(spans)
                for column, values in zip(found, ([a for a, _ in ordered], [b for _, b in ordered], sorted(owners))):
                    column.append(values)
            out = pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *(pa.array(v, pa.list_(pa.int64())) for v in found)], [*kept, *_NAMES])
            yield out.filter(pa.array([bool(v) for v in found[0]], pa.bool_())) if hit_only else out

    return rows.mapInArrow(search, schema)


def mark_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with hit_starts and hit_ends (words, half open) and hit_items (item_ids) added.

    One slice is searched in the documents' own pass. Of several, each is searched by a job of its own whose hits are written, and its
    broadcast is released before the next; rows without a hit are not written.
    """
    spark = docs.sparkSession
    fetch = lambda part: spark.sparkContext.broadcast([tuple(r) for r in part.collect()])  # noqa: E731  at most about slice_bytes
    slices = _slices(benchmark, slice_bytes)
    if len(slices) == 1:
        return _hits(docs, fetch(slices[0]), window, hit_only=False)
    rows = settle(docs.withColumn("_row_number", F.monotonically_increasing_id()), "rows")
    found = []
    for part in slices:
        items = fetch(part)
        found.append(settle(_hits(rows.select("_row_number", "text"), items, window, hit_only=True), "hits"))
        items.destroy()
    joined = reduce(DataFrame.unionByName, found).groupBy("_row_number").agg(
        *[F.flatten(F.collect_list(n)).alias(n) for n in _NAMES[:2]], F.array_distinct(F.flatten(F.collect_list(_NAMES[2]))).alias(_NAMES[2]))
    empty = F.array().cast("array<bigint>")
    return rows.join(joined, "_row_number", "left").select(*docs.columns, *[F.coalesce(n, empty).alias(n) for n in _NAMES])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per document."""
    def digest(batches):
        for part in byte_slices(batches, "text"):
            rows = []
            hits = zip(*(part.column(n).to_pylist() for n in ("_hit_starts", "_hit_ends", "_hit_items")))
            for text, (starts, ends, items) in zip(byte_texts(part, "text"), hits):
                n = len(letter_words(text))
                covered = np.zeros(n + 1, np.int64)
                np.add.at(covered, np.array(starts, np.int64), 1)
                np.add.at(covered, np.array(ends, np.int64), -1)
                names = ",".join(sorted(map(str, items)))
                rows.append((n, int((np.cumsum(covered)[:n] > 0).sum()) if starts else 0, len(items), hashlib.sha256(names.encode()).hexdigest()))
            n, hit, items, sha = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.int64()),
                 pa.array(sha), pa.array([h > 0 for h in hit])],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return mark_documents(narrow, benchmark, window, slice_bytes).mapInArrow(
        digest, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, all columns, that hold no window of the benchmark."""
    marked = mark_documents(fold(docs, "text").withColumn("text", F.col("text").cast("string")), benchmark, window)
    return unfold(marked.where(F.size("_hit_starts") == 0), docs.columns, "text")
