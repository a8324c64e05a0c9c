"""Operator 1: token ids of documents as binary files of Simple-8b words.

``write_token_files`` orders documents by doc_id over range partitions (shards), encodes whole texts and writes
files of at most ``FILE_SEGMENTS`` segments per shard; ``read_token_files`` gives the ids of every document back from the files alone.
The files go through Spark's own writer and commit, so a lost executor's file is written again and any
store that Spark reaches will do.

A file is a run of segments, each followed by one newline byte. A segment, all little-endian:

    8 bytes   b"DWS8B\\x01\\x00\\x00"
    8 x u64   shard, segment in the shard, documents, ids, ids per block, blocks, words, escapes
    i64 each  doc_id of every document (0 where null)
    u8 each   1 where doc_id is null
    u32 each  number of ids of every document, its end id included
    u32 each  offset of every block's first word
    u64 each  words (see simple8b)
    u64 each  escaped values

Defined cases: a null text counts as empty and has the end id alone; a null doc_id comes first;
rows that share a doc_id stay separate, ordered by a hash of their text, and may lie in several shards; columns other than doc_id and text are
left out; an empty table gives no rows. A text is never cut, so a segment holds about 2 MB of text or one
document. A file is read as one binary value (2 GB at most), so a shard is written as several files, whatever its size.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duskwatch.llm import simple8b
from duskwatch.llm.batches import byte_slices, byte_texts
from duskwatch.llm.simhash import text_key
from duskwatch.llm.tokens import TEXT_BYTES, WordTokens
from duskwatch.llm.tables import settle
from duskwatch.session import new_scratch

MAGIC = b"DWS8B\x01\x00\x00"
_HEAD = "<8s8Q"
FILE_SEGMENTS = 64  # about 128 MB of text


def pack_segment(shard: int, number: int, doc_ids: list[int | None], n_ids: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets, escapes = simple8b.encode(ids)
    head = struct.pack(_HEAD, MAGIC, shard, number, len(doc_ids), len(ids), simple8b.BLOCK, len(offsets), len(words), len(escapes))
    return b"".join([
        head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.asarray(n_ids, "<u4").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(),
        escapes.astype("<u8").tobytes()])


def unpack_segments(content: bytes) -> Iterator[tuple[int, int, list[int | None], np.ndarray, np.ndarray]]:
    """(shard, segment, doc_ids, ids per document, all ids) of every segment of a file."""
    at = 0
    while at < len(content):
        magic, shard, number, docs, n, block, blocks, n_words, n_escapes = struct.unpack_from(_HEAD, content, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += struct.calcsize(_HEAD)

        def take(kind, count):
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        doc_ids, missing, n_ids = take("<i8", docs), take("u1", docs), take("<u4", docs)
        offsets, words, escapes = take("<u4", blocks), take("<u8", n_words), take("<u8", n_escapes)
        at += 1  # newline
        yield (shard, number, [None if m else d for d, m in zip(doc_ids.tolist(), missing.tolist())], n_ids,
               simple8b.decode(words, offsets, escapes, n, block))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, file_segments: int = FILE_SEGMENTS) -> None:
    """Write ``docs`` (doc_id, text) to ``path``; ``tokenizer`` is a file of the tokenizers library."""
    def encode(batches):
        tokens, shard = WordTokens.shared(tokenizer), TaskContext.get().partitionId()
        for number, part in enumerate(byte_slices(batches, "text", TEXT_BYTES)):
            ids, n_ids = tokens.encode(byte_texts(part, "text"), end_id)
            segment = pack_segment(shard, number, part.column("doc_id").to_pylist(), n_ids, ids)
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.binary())], ["segment"])

    order = ["doc_id", "_key", "_at"]  # the last two split a doc_id that many rows share
    (docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
     .select("*", text_key().alias("_key"), F.monotonically_increasing_id().alias("_at"))
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(encode, "segment binary")
     .select(F.col("segment").cast("string").alias("value"))  # bytes as they are
     .write.option("lineSep", "\n").option("maxRecordsPerFile", file_segments).text(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: shard, file (its first segment's number in the shard), place in the file, doc_id,
    local_start (ids before it in its file), ids (u32)."""
    def decode(batches):
        for batch in batches:
            for content in batch.column("content"):
                at = place = 0
                file = None
                for shard, number, doc_ids, n_ids, ids in unpack_segments(content.as_py()):
                    file = number if file is None else file
                    flat, ends = ids.astype("<u4"), np.cumsum(n_ids, dtype=np.int64)
                    begins = ends - n_ids
                    k = len(doc_ids)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([shard] * k, pa.int64()), pa.array([file] * k, pa.int64()), pa.array(range(place, place + k), pa.int64()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(begins + at, pa.int64()),
                        pa.array([flat[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())], pa.binary())],
                        ["shard", "file", "place", "doc_id", "local_start", "ids"])
                    at, place = at + len(ids), place + k

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(decode, "shard bigint, file bigint, place bigint, doc_id bigint, local_start bigint, ids binary")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files."""
    rows = settle(
        read_token_files(spark, path).select(
            "shard", "file", "doc_id", "local_start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32")), "tokens")
    before = Window.orderBy("shard", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = (rows.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n"))
              .select("shard", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start")))
    return rows.join(starts, ["shard", "file"]).select(
        "doc_id", (F.col("file_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_index(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the files (to the shared folder if no path is given), read them back and describe every document."""
    spark = docs.sparkSession
    path = path or new_scratch(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return token_index(spark, path)
