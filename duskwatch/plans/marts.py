"""Marts: partial aggregates of events and alerts, kept up as batches come in and folded when a panel is read.

Event marts have one folder per ingest batch, written with the batch; batches without one are filled in by ``refresh``.
Alert marts are per day of detection: the store notes the days it is about to change, ``refresh`` sums those up anew (an alert may
be withdrawn, and a maximum cannot be taken back) and writes them beside the older sums; the newest sum of a day counts. Both can be
run again after a failure. A panel gives what its function in ``dashboard`` or ``searches`` gives on all events or alerts.

Rows are told apart by ``facet``, each a folder: events by hour and type, attempts by day and address; alerts by hour and kind, by address, by account.
Sums are built map-side, one pass for all facets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.plans.dashboard import hours_between
from duskwatch.plans.searches import ATTACK_TYPES
from duskwatch.session import delete_path, materialize
from duskwatch.sources.tables import Store, VersionedTable

_EVENTS = "hour timestamp, event_type string, key string, n bigint, ingest_batch bigint, facet string"
_ALERTS = ("detected_date date, hour timestamp, rule_name string, severity string, status string, key string, n bigint, "
           "risk_sum decimal(38,2), risk_max decimal(5,2), change bigint, facet string")


def _facets(df: DataFrame, names: list[str], kinds: dict[str, dict[str, Column]], when: dict[str, Column], *more: str) -> DataFrame:
    """One row per row of ``df`` and facet that takes it in: (facet, names..., more...)."""
    null = F.lit(None).cast("string")
    row = lambda facet, own: F.struct(F.lit(facet).alias("facet"), *[own.get(n, null).alias(n) for n in names])
    rows = F.array(*[F.when(when[facet], row(facet, own)) for facet, own in kinds.items()])
    return df.select(*more, F.explode(F.array_compact(rows)).alias("_f")).select("_f.*", *more)


# ---------------------------------------------------------------- events

def drop_event_mart(store: Store, batch: int) -> None:
    """Before a batch's events change: what was summed up of them no longer holds."""
    delete_path(store.spark, f"{store.root}/event_marts/ingest_batch={batch}")


def write_event_mart(store: Store, batch: int) -> None:
    events = store.events().where(F.col("ingest_batch") == batch)
    attack = F.col("event_type").isin(*ATTACK_TYPES) & F.col("src_ip").isNotNull()
    rows = _facets(events, ["hour", "event_type", "key"], {
        "hour": {"hour": F.date_trunc("hour", "event_time"), "event_type": F.col("event_type")},
        "ip": {"hour": F.date_trunc("day", "event_time"), "event_type": F.col("event_type"), "key": F.col("src_ip")},
    }, {"hour": F.lit(True), "ip": attack})
    sums = rows.groupBy("facet", F.col("hour").cast("timestamp").alias("hour"), "event_type", "key").agg(F.count("*").alias("n"))
    sums.hint("rebalance", "facet").write.mode("overwrite").partitionBy("facet").parquet(f"{store.root}/event_marts/ingest_batch={batch}")


def _of(store: Store, table: str, schema: str, facet: str) -> DataFrame:
    return store._log(table, schema).where(F.col("facet") == facet)


# ---------------------------------------------------------------- alerts

def _write_alert_marts(store: Store) -> None:
    marks = store.day_marks()
    known = VersionedTable(store.spark, f"{store.root}/alert_marts", None).versions("change")
    fresh = [m for m in marks if not known or m > known[-1]]
    if not fresh:
        return
    days = materialize(store.marked_days().where(F.col("mark") >= fresh[0]).select("detected_date").distinct(), "alert-days")
    low, high = days.agg(F.min("detected_date"), F.max("detected_date")).first()
    alerts = store.alerts().where(F.col("detected_date").between(F.lit(low), F.lit(high))).join(days, "detected_date", "left_semi")
    rows = _facets(alerts, ["hour", "rule_name", "severity", "status", "key"], {
        "kind": {"hour": F.date_trunc("hour", "detected_at"), **{n: F.col(n) for n in ("rule_name", "severity", "status")}},
        "ip": {"key": F.col("src_ip")},
        "user": {"key": F.col("username")},
    }, {"kind": F.lit(True), "ip": F.col("src_ip").isNotNull(), "user": F.col("username").isNotNull()}, "detected_date", "risk_score")
    sums = rows.groupBy("facet", "detected_date", F.col("hour").cast("timestamp").alias("hour"), "rule_name", "severity", "status", "key").agg(
        F.count("*").alias("n"), F.sum("risk_score").cast("decimal(38,2)").alias("risk_sum"), F.max("risk_score").alias("risk_max"))
    # a row of its own for each day: a day whose alerts are all withdrawn has no other
    out = sums.unionByName(days.withColumn("facet", F.lit("day")), allowMissingColumns=True)
    out.hint("rebalance", "facet").write.mode("overwrite").partitionBy("facet").parquet(f"{store.root}/alert_marts/change={fresh[-1]:012d}")


def _alerts(store: Store, facet: str) -> DataFrame:
    """Rows of a facet from the newest sum of each day."""
    newest = _of(store, "alert_marts", _ALERTS, "day").groupBy("detected_date").agg(F.max("change").alias("change"))
    return _of(store, "alert_marts", _ALERTS, facet).join(newest, ["detected_date", "change"])


def refresh(store: Store) -> None:
    """Bring the marts up to what is stored: batches without an event mart, and days whose alerts changed."""
    known = set(VersionedTable(store.spark, f"{store.root}/event_marts", None).versions("ingest_batch"))
    for batch in store.batches():
        if batch not in known:
            write_event_mart(store, batch)
    _write_alert_marts(store)


# ---------------------------------------------------------------- panels

def kpis(store: Store) -> DataFrame:
    kinds, n = _alerts(store, "kind"), F.col("n")
    risk = F.sum("risk_sum").cast("double") / F.sum("n")
    events = _of(store, "event_marts", _EVENTS, "hour").agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_events"))
    alerts = kinds.agg(*[F.coalesce(F.sum(F.when(of, n)), F.lit(0).cast("bigint")).alias(name) for name, of in (
        ("open_alerts", F.col("status") == "open"), ("critical_alerts", F.col("severity") == "critical"))],
        F.coalesce(risk, F.lit(0.0)).alias("avg_risk"))
    anomalies = store.scores.read().agg(F.count_if("is_anomaly").alias("anomalies"))
    return events.join(alerts).join(anomalies)  # three rows of one


def hourly_trend(store: Store) -> DataFrame:
    counts = _alerts(store, "kind").groupBy("hour").agg(F.sum("n").alias("alert_count"))
    return (hours_between(counts).join(counts, "hour", "left")
            .select("hour", F.coalesce("alert_count", F.lit(0)).alias("alert_count")).orderBy("hour"))


def count_by(store: Store, column: str) -> DataFrame:
    return _alerts(store, "kind").groupBy(column).agg(F.sum("n").alias("count")).orderBy(F.desc("count"), column)


def top_ips(store: Store, k: int = 10) -> DataFrame:
    return (_alerts(store, "ip").groupBy(F.col("key").alias("src_ip")).agg(F.sum("n").alias("alerts"), F.max("risk_max").alias("max_risk"))
            .orderBy(F.desc("alerts"), "src_ip").limit(k))


def risk_by_user(store: Store) -> DataFrame:
    return (_alerts(store, "user").groupBy(F.col("key").alias("username")).agg(F.sum("risk_sum").alias("risk_score"))
            .orderBy(F.desc("risk_score"), "username"))


def login_heatmap(store: Store) -> DataFrame:
    return (_of(store, "event_marts", _EVENTS, "hour").filter(F.col("event_type") == "login_success")
            .groupBy(F.date_format("hour", "yyyy-MM-dd").alias("date"), F.hour("hour").alias("hour")).agg(F.sum("n").alias("logins")))


def top_attackers(store: Store, k: int = 10) -> DataFrame:
    return (_of(store, "event_marts", _EVENTS, "ip").groupBy(F.col("key").alias("src_ip"))
            .agg(F.sum("n").alias("attempts"), F.count_distinct("event_type").alias("distinct_event_types"))
            .orderBy(F.desc("attempts"), "src_ip").limit(k))
