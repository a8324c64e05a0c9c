"""A corpus pipeline of five stages; each reads what the one before it wrote.

Quality classifier (rejected documents go), near-duplicates by SimHash (one document of each group stays), repeated passages (their words go),
benchmark decontamination (documents that hold a benchmark passage go), best-fit packing (the placement of every piece).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duskwatch.llm.decontaminate import remove_contaminated
from duskwatch.llm.packing import pack_documents
from duskwatch.llm.quality import keep_good
from duskwatch.llm.queries import read, tokenizer_path
from duskwatch.llm.simhash import keep_one
from duskwatch.llm.substrings import remove_repeats
from duskwatch.llm.tables import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, read(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, shingle=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs, window=13)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"), window=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

ORACLE_SQL = None  # SQL has neither the fingerprints nor the tokenizer; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
