"""Streams over arriving log lines and events.

Stateless rules are the batch operators themselves, applied to a stream. Late
data: a stream waits ``lateness`` for stragglers; anything later is left to the
next batch run over the stored events, which is authoritative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.operators.alerts import ALERT_COLUMNS
from duskwatch.operators.detect import detect_unusual_login_hours, intel_hits
from duskwatch.operators.normalize import blank, events_of, normalize
from duskwatch.plans import jobs
from duskwatch.schemas import EVENTS
from duskwatch.settings import Settings
from duskwatch.sources.lines import check_source
from duskwatch.sources.tables import Store

LATENESS = "24 hours"


def stream_lines(spark: SparkSession, source_type: str, folder: str, **options) -> DataFrame:
    """New files of ``folder`` as (source_type, raw_message, path)."""
    check_source(source_type)
    reader = spark.readStream.format("text")
    for name, value in options.items():
        reader = reader.option(name, value)
    return (reader.load(folder)
            .select(F.lit(source_type).alias("source_type"), F.col("value").alias("raw_message"),
                    F.col("_metadata.file_path").alias("path"))
            .filter(~blank(F.col("raw_message"))))


def stream_events(lines: DataFrame, year: int | None = None) -> DataFrame:
    """The batch normaliser on a stream of lines; malformed lines drop out."""
    return events_of(normalize(lines, year))


def stream_event_table(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Rows appended to a stored event table."""
    reader = spark.readStream.schema(EVENTS)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.parquet(folder)


def failure_counts(events: DataFrame, at_least: int = 5, bucket: str = "5 minutes", lateness: str = LATENESS) -> DataFrame:
    """Login failures per address and tumbling bucket. In append mode a bucket is sent once it can no longer change;
    ``count_sink`` takes every change, so that the newest buckets are not missing."""
    return (events.filter(F.col("source_type").isin("windows_auth", "linux_ssh") & (F.col("event_type") == "login_failure")
                          & F.col("src_ip").isNotNull())
            .withWatermark("event_time", lateness)
            .groupBy(F.window("event_time", bucket).alias("w"), "src_ip").agg(F.count("*").alias("count"))
            .filter(F.col("count") >= at_least)
            .select("src_ip", F.col("w.start").alias("bucket"), "count"))


_COUNTS = "src_ip string, bucket timestamp, count bigint"


def count_sink(counts: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None):
    """Keep the changed buckets of every micro-batch in a folder of its own; a replayed batch takes its place."""
    counts.sparkSession.createDataFrame([], _COUNTS).write.mode("overwrite").parquet(f"{folder}/batch=-1")
    return (counts.writeStream.outputMode("update")
            .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{folder}/batch={batch}"))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def latest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every bucket of a ``count_sink`` with its last count; counts only grow, so that is the largest."""
    return (spark.read.schema(f"{_COUNTS}, batch bigint").parquet(folder)
            .groupBy("src_ip", "bucket").agg(F.max("count").alias("count")))


def off_hours_alerts(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return detect_unusual_login_hours(events, settings)


def intel_matches(events: DataFrame, intel: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Events from a known-bad address: stream to static table."""
    return intel_hits(events, intel, settings)


def alert_sink(alerts: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None):
    """Store a stream of alerts, each once, however late they come.

    The anti join of the batch sink drops repeats and makes a replayed micro-batch add nothing; no watermark
    is involved, so an alert on an old event is stored like any other.
    """
    return (alerts.select(*ALERT_COLUMNS).writeStream.foreachBatch(lambda df, _id: store.persist_alerts(df) and None)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def stream_ingest(lines: DataFrame, store: Store, checkpoint: str, year: int | None = None, trigger: dict | None = None):
    """Store arriving lines as raw rows, events and rejects: one ingest batch per micro-batch.

    The micro-batch number is the batch number, so a replay replaces what it wrote before.
    """
    def store_batch(df: DataFrame, batch_id: int) -> None:
        jobs.ingest(store, df, batch_id, year)

    return (lines.writeStream.foreachBatch(store_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def scheduled_refresh(lines: DataFrame, store: Store, checkpoint: str, year: int | None = None,
                      settings: Settings = Settings(), feed_path: str | None = None, score: bool = True) -> int:
    """One scheduled tick: take in what has arrived, run detection on that, and score all history anew."""
    stream_ingest(lines, store, checkpoint, year).awaitTermination()
    written = jobs.detect_changes(store, settings, feed_path)
    if score:
        jobs.run_scoring(store, settings)
    return written
