"""Saved searches over events and alerts. Grouped searches leave out NULL keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators.detect import PRIVILEGE, SUSPICIOUS_IP, TRAVEL, off_hours
from duskwatch.plans.dashboard import hours_between
from duskwatch.schemas import SEVERITIES
from duskwatch.settings import Settings

# Event types that count as an attempt.
ATTACK_TYPES = ("login_failure", "conn_denied", "http_suspicious_request")


def newest_first() -> list:
    """Total order of an alert list: newest first, ties by content."""
    return [F.desc("detected_at"), "rule_name", "username", "src_ip", "alert_id"]


def in_range(df: DataFrame, time: str, as_of: datetime, hours: int = 24) -> DataFrame:
    """Rows from the full hour ``hours`` before ``as_of`` up to ``as_of``."""
    now = F.lit(as_of).cast("timestamp")
    earliest = F.date_trunc("hour", now - F.expr(f"INTERVAL {int(hours)} HOURS"))
    return df.filter((F.col(time) >= earliest) & (F.col(time) <= now))


def brute_force_buckets(events: DataFrame, at_least: int = 5, bucket: str = "5 minutes") -> DataFrame:
    """Login failures per address and tumbling bucket."""
    return (events.filter(F.col("source_type").isin("windows_auth", "linux_ssh") & (F.col("event_type") == "login_failure")
                          & F.col("src_ip").isNotNull())
            .groupBy("src_ip", F.window("event_time", bucket).alias("w")).agg(F.count("*").alias("count"))
            .filter(F.col("count") >= at_least)
            .select("src_ip", F.col("w.start").alias("bucket"), "count").orderBy(F.desc("count"), "src_ip", "bucket"))


def top_attackers(events: DataFrame, k: int = 10) -> DataFrame:
    return (events.filter(F.col("event_type").isin(*ATTACK_TYPES)
                          & F.col("src_ip").isNotNull())
            .groupBy("src_ip").agg(F.count("*").alias("attempts"), F.count_distinct("event_type").alias("distinct_event_types"))
            .orderBy(F.desc("attempts"), "src_ip").limit(k))


def privilege_activity(alerts: DataFrame) -> DataFrame:
    return (alerts.filter(F.col("rule_name") == PRIVILEGE).orderBy(*newest_first())
            .select("detected_at", "username", "host", "description", "risk_score"))


def off_hours_logins(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return (events.filter((F.col("event_type") == "login_success") & off_hours(settings))
            .select("event_time", "username", "src_ip", "host"))


def severity_timechart(alerts: DataFrame) -> DataFrame:
    """Alerts per hour, a column per severity, hours without any included."""
    counts = (alerts.groupBy(F.date_trunc("hour", "detected_at").alias("hour"))
              .agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES]))
    return (hours_between(counts).join(counts, "hour", "left")
            .select("hour", *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in SEVERITIES]).orderBy("hour"))


def intel_alerts(alerts: DataFrame) -> DataFrame:
    return (alerts.filter(F.col("rule_name") == SUSPICIOUS_IP).orderBy(F.desc("risk_score"), "alert_id")
            .select("detected_at", "src_ip", "username", "description", "risk_score"))


def risk_leaderboard(alerts: DataFrame) -> DataFrame:
    return (alerts.filter(F.col("username").isNotNull()).groupBy("username")
            .agg(F.sum("risk_score").alias("total_risk"), F.count("*").alias("alert_count"))
            .orderBy(F.desc("total_risk"), "username"))


def travel_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("rule_name") == TRAVEL).select("detected_at", "username", "description", "risk_score")


def web_attack_surface(events: DataFrame) -> DataFrame:
    return (events.filter((F.col("source_type") == "web_server") & F.col("src_ip").isNotNull()
                          & F.col("event_type").isin("http_suspicious_request", "http_auth_failure"))
            .groupBy("src_ip", "event_type").agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), "src_ip", "event_type"))


def multi_source_ips(events: DataFrame, at_least: int = 2) -> DataFrame:
    """Addresses seen in several log sources."""
    # a set of source types per address: four values, merged map-side
    return (events.filter(F.col("src_ip").isNotNull()).groupBy("src_ip")
            .agg(F.array_sort(F.collect_set("source_type")).alias("sources"))
            .select("src_ip", F.size("sources").cast("bigint").alias("source_count"), "sources")
            .filter(F.col("source_count") >= at_least).orderBy(F.desc("source_count"), "src_ip"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Totals, distinct addresses and mean risk to one decimal."""
    return alerts.agg(
        F.count("*").alias("total"), F.count_if(F.col("severity") == "critical").alias("critical"),
        F.count_distinct("src_ip").alias("distinct_ips"),
        F.round(F.avg("risk_score"), 1).alias("avg_risk"))


def recent_alerts(alerts: DataFrame, k: int = 50) -> DataFrame:
    return (alerts.orderBy(*newest_first()).limit(k)
            .select("detected_at", "rule_name", "severity", "username", "src_ip", "title", "risk_score"))
