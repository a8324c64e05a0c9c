"""Events and alerts as collector envelopes, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Envelope source types.
EVENT_PREFIX, ALERT_SOURCETYPE = "siem:", "siem:alert"
EVIDENCE_SOURCETYPE = f"{ALERT_SOURCETYPE}:evidence"


def _as_text(name: str, kind: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(value.cast("array<string>"), ", "), F.lit("]"))
    if isinstance(kind, (T.MapType, T.StructType)):
        return F.to_json(value)
    if isinstance(kind, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ssxxx")
    return value.cast("string")


def _envelopes(df: DataFrame, time: str, sourcetype: Column, index: str) -> DataFrame:
    body = [_as_text(f.name, f.dataType).alias(f.name) for f in df.schema if f.name != time]
    # A decimal prints as plain digits, a double would print an exponent.
    seconds = (F.unix_micros(F.col(time)).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)")
    envelope = F.struct(seconds.alias("time"), sourcetype.alias("sourcetype"),
                        F.lit(index).alias("index"), F.struct(*body).alias("event"))
    return df.select(F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))


def event_envelopes(events: DataFrame, index: str = "siem") -> DataFrame:
    return _envelopes(events, "event_time", F.concat(F.lit(EVENT_PREFIX), F.col("source_type")), index)


def alert_envelopes(alerts: DataFrame, index: str = "siem") -> DataFrame:
    return _envelopes(alerts, "detected_at", F.lit(ALERT_SOURCETYPE), index)


def evidence_envelopes(ids: DataFrame, alerts: DataFrame, index: str = "siem") -> DataFrame:
    """One envelope per (alert, event id), at the alert's time: what a whole-group alert's own envelope cannot hold."""
    timed = ids.join(alerts.select("alert_id", "detected_at"), "alert_id")
    return _envelopes(timed, "detected_at", F.lit(EVIDENCE_SOURCETYPE), index)


def write_envelopes(envelopes: DataFrame, path: str, records_per_file: int = 1_000_000) -> None:
    """Text files a forwarder can post as they are; the file size takes the place of request batching.
    A later export to the same path takes its place."""
    envelopes.write.mode("overwrite").option("maxRecordsPerFile", records_per_file).text(path)
