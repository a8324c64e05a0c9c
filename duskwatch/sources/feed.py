"""Threat feed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.schemas import INTEL
from duskwatch.sources.lines import path_exists


def read_feed(spark: SparkSession, path: str, with_place: bool = False) -> DataFrame:
    """CSV with header ``ip,category,confidence,source``; a missing file is an empty feed.

    ``with_place`` adds ``feed_file`` and ``feed_block``: Spark deals splits out by size, so over several files
    only these tell which row comes later.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], INTEL)
    feed = spark.read.csv(path, header=True, schema=INTEL)
    if not with_place:
        return feed
    return feed.select("*", F.col("_metadata.file_path").alias("feed_file"), F.col("_metadata.file_block_start").alias("feed_block"))
