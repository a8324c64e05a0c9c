"""Table schemas. All timestamps are UTC."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampType())


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_LOGS = _struct(
    ("raw_id", L), ("source_type", S), ("raw_message", S), ("ingested_at", TS),
    ("processed", B), ("path", S),
)

EVENTS = _struct(
    ("id", L), ("raw_log_id", L), ("event_time", TS), ("source_type", S), ("host", S),
    ("username", S), ("src_ip", S), ("dst_ip", S), ("dst_port", I), ("event_type", S),
    ("severity", S), ("status_code", I), ("additional_data", T.MapType(S, S)), ("created_at", TS),
)

# What a normaliser adds to a raw line, in this order.
PARSED_COLUMNS = ["event_time", "source_type", "host", "username", "src_ip", "dst_ip",
                  "dst_port", "event_type", "severity", "status_code", "additional_data"]

ALERTS = _struct(
    ("alert_id", S), ("rule_name", S), ("severity", S), ("src_ip", S), ("username", S),
    ("host", S), ("title", S), ("description", S), ("risk_score", T.DecimalType(5, 2)),
    ("n_events", L), ("event_ids", T.ArrayType(L)), ("detected_at", TS), ("status", S),
)

INTEL = _struct(("ip", S), ("category", S), ("confidence", I), ("source", S))
INTEL_TABLE = _struct(*[(f.name, f.dataType) for f in INTEL], ("added_at", TS))

GEO = _struct(("priority", I), ("cidr", S), ("country", S), ("city", S), ("lat", D), ("lon", D))

FEATURE_COLUMNS = ["hour_of_day", "day_of_week", "is_new_source_ip", "failed_attempts_1h",
                   "logins_last_24h", "is_off_hours"]

SCORES = _struct(
    ("id", L), ("username", S), ("event_time", TS), ("anomaly_score", T.DecimalType(6, 4)),
    ("is_anomaly", B), ("features", _struct(*[(c, I) for c in FEATURE_COLUMNS])),
    ("scored_at", TS),
)

SOURCE_TYPES = ["windows_auth", "linux_ssh", "firewall", "web_server"]
SEVERITIES = ["low", "medium", "high", "critical"]
STATUSES = ["open", "acknowledged", "closed"]
