"""Aggregates an operations dashboard shows, one frame each.

``alerts`` follows ``schemas.ALERTS``, ``events`` ``schemas.EVENTS``, ``scores`` ``schemas.SCORES``.
Every aggregate is partial, so a hot address or account is reduced before it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kpis(events: DataFrame, alerts: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: events, open and critical alerts, mean risk (0 if none), anomalies."""
    none = lambda kind: F.lit(None).cast(kind)
    names = {"total_events": "bigint", "open_alerts": "bigint", "critical_alerts": "bigint",
             "avg_risk": "double", "anomalies": "bigint"}

    def row(df, **values):
        return df.agg(*[values.get(n, F.max(none(t))).alias(n) for n, t in names.items()])

    parts = [
        row(events, total_events=F.count("*")),
        row(alerts, open_alerts=F.count_if(F.col("status") == "open"),
            critical_alerts=F.count_if(F.col("severity") == "critical"),
            avg_risk=F.avg(F.col("risk_score").cast("double"))),
        row(scores, anomalies=F.count_if("is_anomaly")),
    ]
    # three one-row frames folded into one
    return reduce(DataFrame.unionByName, parts).agg(
        *[F.coalesce(F.max(n), F.lit(0).cast(t)).alias(n) for n, t in names.items()])


def filter_alerts(alerts: DataFrame, severities: list[str] | None = None, rules: list[str] | None = None) -> DataFrame:
    if severities is not None:
        alerts = alerts.filter(F.col("severity").isin(*severities))
    if rules is not None:
        alerts = alerts.filter(F.col("rule_name").isin(*rules))
    return alerts


def rule_options(alerts: DataFrame) -> DataFrame:
    return alerts.select("rule_name").distinct().orderBy("rule_name")


def hours_between(counts: DataFrame, hour: str = "hour") -> DataFrame:
    """Every hour from the first to the last of ``counts``."""
    return (counts.agg(F.min(hour).alias("lo"), F.max(hour).alias("hi")).filter("lo IS NOT NULL")
            .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias(hour)))


def hourly_trend(alerts: DataFrame) -> DataFrame:
    """Alerts per hour, hours without any included."""
    counts = alerts.groupBy(F.date_trunc("hour", "detected_at").alias("hour")).agg(F.count("*").alias("alert_count"))
    return (hours_between(counts).join(counts, "hour", "left")
            .select("hour", F.coalesce("alert_count", F.lit(0)).alias("alert_count")).orderBy("hour"))


def count_by(alerts: DataFrame, column: str) -> DataFrame:
    return alerts.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)


def top_ips(alerts: DataFrame, k: int = 10) -> DataFrame:
    return (alerts.filter(F.col("src_ip").isNotNull()).groupBy("src_ip")
            .agg(F.count("*").alias("alerts"), F.max("risk_score").alias("max_risk"))
            .orderBy(F.desc("alerts"), "src_ip").limit(k))


def risk_by_user(alerts: DataFrame) -> DataFrame:
    return (alerts.filter(F.col("username").isNotNull()).groupBy("username")
            .agg(F.sum("risk_score").alias("risk_score")).orderBy(F.desc("risk_score"), "username"))


def login_heatmap(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_type") == "login_success")
            .groupBy(F.date_format("event_time", "yyyy-MM-dd").alias("date"), F.hour("event_time").alias("hour"))
            .agg(F.count("*").alias("logins")))


def anomaly_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count("*").alias("logins_scored"), F.count_if("is_anomaly").alias("flagged"))


def flagged_logins(scores: DataFrame) -> DataFrame:
    return scores.filter("is_anomaly").orderBy(F.desc("anomaly_score"), "id")


def alert_table(alerts: DataFrame) -> DataFrame:
    """The alert list, newest first."""
    return alerts.orderBy(F.desc("detected_at"), "rule_name", "alert_id").select(
        "detected_at", "rule_name", "severity", "title", "username", "src_ip", "risk_score", "status")
