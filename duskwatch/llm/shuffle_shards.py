"""Operator 9: a reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in doc_id order over range partitions; a keyed Feistel network permutes the
numbers, and shard = image mod shards, slot = image div shards follow by arithmetic. The network works on
pairs (a, b) with a*b just above n; an image of n or more is sent through again (cycle walking) until
all are below n, so the map stays one to one and shard sizes differ by one at most. Only DataFrame functions are used.

Defined cases: a null text has size 1 and crc32 0; null doc_ids come first; rows with one doc_id, or rows that
are equal throughout, are separate rows with slots of their own, and a row number column spreads even a
doc_id that holds a third of the table over several partitions; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.tables import settle

ROUNDS = 6
WALKS = 3


def number_rows(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """(``df`` with ``row`` 0..n-1 in the given order, n). Partition totals are the only thing gathered: one row each."""
    placed = settle(
        df.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order, "_at")
        .sortWithinPartitions(*order, "_at").drop("_at").withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_mid", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    n = placed.count()
    rows = (placed.withColumn("_part", part).join(starts, "_part")
            .withColumn("row", F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_start", "_mid"))
    return rows, n


def _through(df: DataFrame, x: str, n: int, a: int, b: int, seed: int, where: Column | None = None) -> DataFrame:
    """Send column ``x`` through the network once (rows outside ``where`` keep theirs)."""
    df = df.withColumn("_l", F.pmod(F.col(x), F.lit(a))).withColumn("_r", F.expr(f"{x} div {a}"))
    for k in range(ROUNDS):
        turn, other, size = ("_l", "_r", a) if k % 2 == 0 else ("_r", "_l", b)
        mixed = F.pmod(F.xxhash64(F.col(other), F.lit(k), F.lit(seed)), F.lit(size))
        df = df.withColumn(turn, F.pmod(F.col(turn) + mixed, F.lit(size)))
    image = F.col("_r") * F.lit(a) + F.col("_l")
    return df.withColumn(x, image if where is None else F.when(where, image).otherwise(F.col(x))).drop("_l", "_r")


def permute_rows(df: DataFrame, n: int, seed: int, row: str = "row", out: str = "image") -> DataFrame:
    """Add ``out``: a permutation of 0..n-1 applied to ``row``."""
    df = df.withColumn(out, F.col(row))
    if n < 2:
        return df
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    df = _through(df, out, n, a, b, seed)
    for _ in range(WALKS):  # at most one in sqrt(n) rows still walks, then one in n, ...
        df = _through(df, out, n, a, b, seed, F.col(out) >= n)
    df = settle(df, "permuted")
    while df.filter(F.col(out) >= n).limit(1).count():
        df = settle(_through(df, out, n, a, b, seed, F.col(out) >= n), "permuted")
    return df


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, law "rows", shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("bigint"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    rows, n = number_rows(narrow, "doc_id", "text_crc32")
    return permute_rows(rows, n, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("image", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"image div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
