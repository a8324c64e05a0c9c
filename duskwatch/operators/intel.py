"""Threat feed: match, enrich, and keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.net import strip_mask
from duskwatch.operators.hot_keys import hot_keys, only_hot, without_hot
from duskwatch.settings import Settings


def known_bad_ips(intel: DataFrame) -> DataFrame:
    """Distinct addresses of the feed, without a mask."""
    return intel.select(strip_mask(F.col("ip")).alias("src_ip")).filter("src_ip IS NOT NULL").distinct()


def is_small(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def hint_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after counting that it has at most ``max_rows`` rows.

    Beyond that the join is left to Catalyst and AQE (sort-merge, skewed sides split).
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def semi_join(events: DataFrame, ips: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Events whose ``src_ip`` is among ``ips``; NULL never matches."""
    events = events.filter(F.col("src_ip").isNotNull())
    if is_small(ips, settings.max_broadcast_rows):
        return events.join(F.broadcast(ips), "src_ip", "left_semi")
    # A feed too large to broadcast. What follows is often grouped by address, which keeps AQE from
    # splitting a hot one, so hot addresses are matched map-side against their own few feed rows.
    hot = [] if events.isStreaming else hot_keys(events, "src_ip", settings.max_rows_per_task)
    if not hot:
        return events.join(ips, "src_ip", "left_semi")
    return (only_hot(events, "src_ip", hot).join(F.broadcast(only_hot(ips, "src_ip", hot)), "src_ip", "left_semi")
            .unionByName(without_hot(events, "src_ip", hot).join(ips, "src_ip", "left_semi")))


def enrich(events: DataFrame, intel: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add the feed's category and confidence as ``intel_category``, ``intel_confidence``."""
    feed = (intel.select(strip_mask(F.col("ip")).alias("src_ip"), "category", "confidence")
            .groupBy("src_ip").agg(F.max(F.struct("confidence", "category")).alias("_best"))
            .select("src_ip", F.col("_best.category").alias("intel_category"),
                    F.col("_best.confidence").alias("intel_confidence")))
    return events.join(hint_if_small(feed, settings.max_broadcast_rows), "src_ip", "left")


def upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keyed upsert: the last incoming row of an address replaces it, ``added_at`` stays the oldest.

    ``incoming`` carries ``added_at`` and ``pos`` (its order: file, block, row). One partial aggregate,
    so repeats of one address never meet in one task unreduced.
    """
    before = F.lit(-1).cast("bigint")
    first = F.struct(F.lit("").alias("feed_file"), before.alias("feed_block"), before.alias("row"))  # before every feed row
    both = stored.withColumn("pos", first).unionByName(incoming)
    latest = F.max_by(F.struct("category", "confidence", "source"), "pos")
    # a stored row keeps its stamp; among new rows the first one inserts
    added = F.min_by("added_at", "pos")
    return (both.groupBy("ip").agg(latest.alias("_row"), added.alias("added_at"))
            .select("ip", "_row.category", "_row.confidence", "_row.source", "added_at"))
