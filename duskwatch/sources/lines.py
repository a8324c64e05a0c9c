"""Raw log files as rows."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.operators.normalize import NORMALIZERS, blank

log = logging.getLogger("duskwatch.lines")


def check_source(source_type: str) -> None:
    if source_type not in NORMALIZERS:
        raise ValueError(f"unknown source_type {source_type!r}; options: {list(NORMALIZERS)}")


def read_lines(spark: SparkSession, source_type: str, path: str) -> DataFrame:
    """Non-blank lines of a file, folder or glob: (source_type, raw_message, path)."""
    check_source(source_type)
    return (spark.read.text(path)
            .select(F.lit(source_type).alias("source_type"), F.col("value").alias("raw_message"),
                    F.col("_metadata.file_path").alias("path"))
            .filter(~blank(F.col("raw_message"))))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_all_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Lines of all sources as one frame; a missing path is skipped with a warning."""
    out = None
    for source_type, path in paths.items():
        check_source(source_type)
        if not path_exists(spark, path):
            log.warning("no input for %s at %s, skipped", source_type, path)
            continue
        lines = read_lines(spark, source_type, path)
        out = lines if out is None else out.unionByName(lines)
    if out is None:
        out = spark.createDataFrame([], "source_type string, raw_message string, path string")
    return out
