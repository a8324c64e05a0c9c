"""One query per operator of the inventory, over the driver's tables.

Thresholds are the ones of FIXTURES.md that give results on these tables (the
defaults give none): 5 failures in 24 h per address, 3 in 24 h per account.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.scoring import risk_score
from duskwatch.functions.text import micros_text
from duskwatch.operators import alerts as alert_ops
from duskwatch.operators import detect, geo, intel
from duskwatch.operators.features import build_features
from duskwatch.operators.forest import train_and_score
from duskwatch.operators.greedy import threshold_windows
from duskwatch.operators.normalize import normalize, normalize_source, to_event_json
from duskwatch.plans import dashboard, jobs, marts, searches
from duskwatch.schemas import EVENTS, FEATURE_COLUMNS, SCORES
from duskwatch.session import materialize, new_scratch, prepare
from duskwatch.settings import Settings
from duskwatch.sources import export
from duskwatch.sources.driver_tables import as_lines, events_norm, feed_from_events, map_events
from duskwatch.sources.lines import read_all_lines, read_lines
from duskwatch.sources.tables import Store
from duskwatch.streaming import keyed, pipelines
from duskwatch.streaming import late as late_rule

LOOSE = Settings(brute_force_threshold=5, brute_force_minutes=24 * 60,
                 multi_fail_threshold=3, multi_fail_minutes=24 * 60)
SMOKE = Settings(brute_force_threshold=3, brute_force_minutes=168 * 60)
YEAR = 2024  # the tables' events are of January 2024
AS_OF = datetime(2024, 1, 20, 10, 30)
CUT = datetime(2024, 1, 20)
_SOURCES = ("windows_auth", "linux_ssh", "firewall", "web_server")

# ---------------------------------------------------------------- shared inputs

_MADE: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make):
    """Tables several queries read (alerts, log files, ...) are built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def _events(spark, sf_dir) -> DataFrame:
    return events_norm(prepare(spark), sf_dir)


def _raw(spark, sf_dir) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def _feed(spark, sf_dir) -> DataFrame:
    return _once(spark, sf_dir, "feed", lambda: materialize(feed_from_events(_raw(spark, sf_dir)), "feed"))


def _alerts(spark, sf_dir) -> DataFrame:
    """The stored alert table of a full detection run."""
    def make():
        store = Store(prepare(spark), new_scratch(spark, "store"))
        store.persist_alerts(detect.run_all_rules(_events(spark, sf_dir), _feed(spark, sf_dir), LOOSE))
        return store.alerts()
    return _once(spark, sf_dir, "alerts", make)


def _ingested_alerts(spark, sf_dir) -> Store:
    """A store with the events as they are, their alerts and the evidence of these."""
    def make():
        store = Store(prepare(spark), new_scratch(spark, "store"))
        store.intel.replace(_feed(spark, sf_dir).withColumn("added_at", F.lit(CUT)))
        events = _events(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))
        store.write_batch("normalized_events", events.select(*[F.col(f.name) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                                               for f in EVENTS], "event_date"), 0, by="event_date", rebalance=True)
        jobs.run_detection(store, LOOSE)
        return store
    return _once(spark, sf_dir, "ingested alerts", make)


def _scores(spark, sf_dir) -> DataFrame:
    def make():
        store = Store(prepare(spark), new_scratch(spark, "store"))
        store.scores.replace(jobs.score_rows(train_and_score(build_features(_events(spark, sf_dir)))))
        return store.scores.read()
    return _once(spark, sf_dir, "scores", make)


def _score_table(spark, sf_dir) -> DataFrame:
    """A score for every login by a rule on its id: what the dashboards make of scores can then be checked in full."""
    logins = _events(spark, sf_dir).filter((F.col("event_type") == "login_success") & F.col("username").isNotNull())
    score = (F.pmod(F.col("id") * 7919, F.lit(10_000)) / 10_000).cast("decimal(6,4)")
    return logins.select("id", "username", "event_time", score.alias("anomaly_score"), (score >= 0.95).alias("is_anomaly"))


def _lines(spark, sf_dir) -> DataFrame:
    """The events as log lines, written out once: parsing is what its queries are about."""
    return _once(spark, sf_dir, "lines", lambda: materialize(as_lines(_events(spark, sf_dir)), "lines"))


def _log_files(spark, sf_dir) -> dict[str, str]:
    """The events as log files, one folder per source."""
    def make():
        root = new_scratch(prepare(spark), "logs")
        _lines(spark, sf_dir).select("source_type", "raw_message").write.partitionBy("source_type").text(root)
        return {s: f"{root}/source_type={s}" for s in _SOURCES}
    return _once(spark, sf_dir, "logs", make)


def _ingested(spark, sf_dir) -> Store:
    def make():
        store = Store(prepare(spark), new_scratch(spark, "store"))
        jobs.ingest_all(store, _log_files(spark, sf_dir), batch=0, year=YEAR)
        return store
    return _once(spark, sf_dir, "ingested", make)


# ---------------------------------------------------------------- output shapes

def _time(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, micros_text(F.col(c)))
    return df


def _alert_out(alerts: DataFrame, description: bool = True) -> DataFrame:
    out = alerts.select("rule_name", "severity", "src_ip", "username", "title", "description",
                        F.col("risk_score").cast("double").alias("risk_score"), "n_events",
                        F.array_join("event_ids", ",").alias("event_ids"), "detected_at", "status")
    return _time(out if description else out.drop("description"), "detected_at")


def _event_out(events: DataFrame, *more) -> DataFrame:
    """Event columns; numbers that may be NULL as text, which every client shows alike."""
    return _time(events.select("source_type", "event_time", "host", "username", "src_ip", "dst_ip",
                               F.col("dst_port").cast("string").alias("dst_port"), "event_type", "severity",
                               F.col("status_code").cast("string").alias("status_code"), *more), "event_time")


def _double(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(F.col(c).cast("double"), 6))
    return df


# ---------------------------------------------------------------- scans and sinks

def s1_raw_scan(spark, sf_dir):
    return (read_lines(prepare(spark), "windows_auth", _log_files(spark, sf_dir)["windows_auth"])
            .select("source_type", "raw_message"))


def s2_all_sources_scan(spark, sf_dir):
    return (read_all_lines(prepare(spark), _log_files(spark, sf_dir))
            .groupBy("source_type").agg(F.count("*").alias("n"), F.sum(F.length("raw_message")).alias("chars")))


def s3_raw_audit(spark, sf_dir):
    return (_ingested(spark, sf_dir).raw_logs().groupBy("source_type", "processed")
            .agg(F.count("*").alias("n"), F.count_distinct("raw_id").alias("ids")))


def s4_event_sink(spark, sf_dir):
    return _event_out(_ingested(spark, sf_dir).events())


def s5_rejects(spark, sf_dir):
    return (_ingested(spark, sf_dir).rejects().groupBy("source_type", "reason").agg(F.count("*").alias("n")))


def s6_events_since(spark, sf_dir):
    return _event_out(_ingested(spark, sf_dir).events(since=CUT))


def s7_feed_scan(spark, sf_dir):
    from duskwatch.sources.feed import read_feed
    path = new_scratch(prepare(spark), "feed-csv")
    _feed(spark, sf_dir).write.csv(path, header=True)
    return read_feed(spark, path)


def s8_feed_upsert(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    store = Store(prepare(spark), new_scratch(spark, "store"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    store.upsert_intel(feed_from_events(raw.filter(F.col("ts") < cut)), datetime(2024, 1, 1))
    store.upsert_intel(feed_from_events(raw.filter(F.col("ts") >= cut)), datetime(2024, 2, 1))
    return _time(store.intel.read(), "added_at")


def s9_known_bad_ips(spark, sf_dir):
    return intel.known_bad_ips(_feed(spark, sf_dir))


def s10_alert_sink(spark, sf_dir):
    """Alerts of the older events are stored first; the full run then adds only what is new."""
    events, feed = _events(spark, sf_dir), _feed(spark, sf_dir)
    store = Store(prepare(spark), new_scratch(spark, "store"))
    old = events.filter(F.col("event_time") < F.lit(CUT))
    counts = [store.persist_alerts(detect.run_all_rules(e, feed, LOOSE)) for e in (old, events, events)]
    return spark.createDataFrame(list(zip(["older events", "all events", "all events again"], counts)), "run string, written bigint")


def s11_score_sink(spark, sf_dir):
    return _time(_scores(spark, sf_dir).select("id", "username", "event_time", *[F.col(f"features.{c}").alias(c) for c in FEATURE_COLUMNS]),
                 "event_time")


def _read_envelopes(envelopes: DataFrame, fields: dict[str, str]) -> DataFrame:
    get = lambda path: F.get_json_object("value", path)
    return envelopes.select(
        get("$.time").cast("decimal(20,6)").cast("string").alias("time"), get("$.sourcetype").alias("sourcetype"),
        get("$.index").alias("index"), *[get(f"$.event.{p}").alias(n) for n, p in fields.items()])


def s12_event_export(spark, sf_dir):
    path = new_scratch(prepare(spark), "export")
    export.write_envelopes(export.event_envelopes(_events(spark, sf_dir)), path)
    return _read_envelopes(spark.read.text(path), {"id": "id", "username": "username", "src_ip": "src_ip", "event_type": "event_type"})


def s13_alert_export(spark, sf_dir):
    path = new_scratch(prepare(spark), "export")
    export.write_envelopes(export.alert_envelopes(_alerts(spark, sf_dir).drop("detected_date")), path)
    return _read_envelopes(spark.read.text(path), {"rule_name": "rule_name", "risk_score": "risk_score", "event_ids": "event_ids", "title": "title"})


def s13_alert_evidence(spark, sf_dir):
    """The ids of every alert as the export has them: one envelope per (alert, event), told to its alert by alert_id."""
    store = _ingested_alerts(spark, sf_dir)
    out = new_scratch(prepare(spark), "export")
    jobs.export(store, out, "alerts")
    field = lambda name: F.get_json_object("value", f"$.event.{name}").alias(name)
    alerts = spark.read.text(f"{out}/alerts").select(field("alert_id"), field("title"))
    ids = spark.read.text(f"{out}/alert_evidence").select(F.get_json_object("value", "$.sourcetype").alias("sourcetype"), field("alert_id"),
                                                          field("rule_name"), field("event_id"))
    return ids.join(alerts, "alert_id").groupBy("sourcetype", "rule_name", "title").agg(
        F.count("*").alias("n"), F.sum(F.col("event_id").cast("bigint")).alias("id_sum"), F.min(F.col("event_id").cast("bigint")).alias("first_id"))


def s14_dashboard_scan(spark, sf_dir):
    return _time(_alerts(spark, sf_dir).orderBy(*searches.newest_first()).select("rule_name", "title", "detected_at", "status"), "detected_at")


# ---------------------------------------------------------------- normalisation

def _parsed(spark, sf_dir, source):
    lines = _lines(spark, sf_dir).filter(F.col("source_type") == source).drop("source_type")
    return normalize_source(lines, source, YEAR, column="raw_message").filter(F.col("event_time").isNotNull())


def _extra(*names):
    return [F.col("additional_data")[n].alias(n) for n in names]


def n1_windows(spark, sf_dir):
    return _event_out(_parsed(spark, sf_dir, "windows_auth"), "id", *_extra("event_id", "logon_type", "status"))


def n2_event_id_map(spark, sf_dir):
    return (_parsed(spark, sf_dir, "windows_auth").groupBy(F.col("additional_data.event_id").alias("event_id"), "event_type", "severity")
            .agg(F.count("*").alias("n")))


def n3_syslog_prefix(spark, sf_dir):
    return _time(_parsed(spark, sf_dir, "linux_ssh").select("id", "event_time", "host"), "event_time")


def n4_sshd(spark, sf_dir):
    return _event_out(_parsed(spark, sf_dir, "linux_ssh").filter(F.col("event_type").startswith("login")), "id", *_extra("port", "auth_method"))


def n5_sudo(spark, sf_dir):
    return _event_out(_parsed(spark, sf_dir, "linux_ssh").filter(F.col("event_type") == "privilege_escalation"), "id",
                      *_extra("target_user", "command"))


def n6_firewall(spark, sf_dir):
    return _event_out(_parsed(spark, sf_dir, "firewall"), "id", *_extra("protocol", "action"))


def n7_web(spark, sf_dir):
    return _event_out(_parsed(spark, sf_dir, "web_server"), "id", *_extra("method", "path", "user_agent"))


def n8_http_classes(spark, sf_dir):
    return (_parsed(spark, sf_dir, "web_server").groupBy("status_code", F.col("additional_data.path").alias("path"), "event_type", "severity")
            .agg(F.count("*").alias("n")))


def n9_line_stream(spark, sf_dir):
    return (normalize(_lines(spark, sf_dir), YEAR).filter(F.col("event_time").isNotNull()).select("id", "source_type", "event_type"))


def n10_event_json(spark, sf_dir):
    out = to_event_json(_events(spark, sf_dir).select("event_time", "source_type", "username", "src_ip", "id"))
    return out.select(*[F.get_json_object("value", f"$.{c}").alias(c) for c in ("id", "event_time", "source_type", "username", "src_ip")])


def n11_dispatch(spark, sf_dir):
    lines = read_all_lines(prepare(spark), _log_files(spark, sf_dir))
    return (normalize(lines, YEAR, by_source=True).groupBy("source_type", "event_type", "severity").agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- joins

def j1_intel_semi_join(spark, sf_dir):
    return detect.intel_hits(_events(spark, sf_dir), _feed(spark, sf_dir)).select("id", "src_ip", "event_type")


def j2_geo_lookup(spark, sf_dir):
    found = geo.locate_all(_events(spark, sf_dir).select("id", "src_ip"), geo.sample_ranges(spark))
    return found.select("id", "src_ip", "geo.country", "geo.city", "geo.lat", "geo.lon")


def j2_geo_inline(spark, sf_dir):
    found = geo.locate(_events(spark, sf_dir).select("id", "src_ip"))
    return found.select("id", "src_ip", "geo.country", "geo.city", "geo.lat", "geo.lon")


def j3_login_pairs(spark, sf_dir):
    out = detect.login_pairs(_events(spark, sf_dir)).select(
        "id", F.col("previous.id").alias("previous_id"), "username", "seconds",
        F.col("geo.city").alias("city"), F.col("previous.geo.city").alias("previous_city"), "distance_km", "speed_kmh")
    return _double(out, "seconds", "distance_km", "speed_kmh")


def j4_failures_before_login(spark, sf_dir):
    return build_features(_events(spark, sf_dir)).select("id", "username", "failed_attempts_1h")


def j5_new_alerts(spark, sf_dir):
    """Alerts of all events that a run over the older events had not raised."""
    events = _events(spark, sf_dir)
    stored = detect.run_all_rules(events.filter(F.col("event_time") < F.lit(CUT)), _feed(spark, sf_dir), LOOSE)
    return _alert_out(alert_ops.not_stored(_alerts(spark, sf_dir), stored), description=False)


def j6_raw_line(spark, sf_dir):
    raw = _lines(spark, sf_dir).select(F.col("id").alias("raw_id"), "raw_message", F.lit("memory").alias("path"))
    joined = jobs.with_raw_lines(_events(spark, sf_dir), raw)
    return joined.select("id", "source_type", F.length("raw_message").alias("line_length"))


def j7_intel_enrichment(spark, sf_dir):
    return intel.enrich(_events(spark, sf_dir), _feed(spark, sf_dir)).select(
        "id", "src_ip", "intel_category", F.col("intel_confidence").cast("string").alias("intel_confidence"))


# ---------------------------------------------------------------- detections

def a0_risk(spark, sf_dir):
    events = _events(spark, sf_dir).select("id", "severity", "k")
    return events.select("id", risk_score(F.col("severity"), F.col("k") / 7).alias("risk"))


def w1_threshold_windows(spark, sf_dir):
    failures = _events(spark, sf_dir).filter(F.col("event_type") == "login_failure")
    found = threshold_windows(failures, "src_ip", 3, 168 * 3_600_000_000)
    return _time(found.select("src_ip", "event_time", "id", F.array_join("members.id", ",").alias("ids")), "event_time")


def w1_split_hot_keys(spark, sf_dir):
    """The same windows with every address cut into slices of about 100 rows."""
    failures = _events(spark, sf_dir).filter(F.col("event_type") == "login_failure")
    found = threshold_windows(failures, "src_ip", 3, 168 * 3_600_000_000, max_rows=40)
    return _time(found.select("src_ip", "event_time", "id", F.array_join("members.id", ",").alias("ids")), "event_time")


def d1_brute_force(spark, sf_dir):
    return _alert_out(detect.detect_brute_force(_events(spark, sf_dir), LOOSE))


def d2_impossible_travel(spark, sf_dir):
    return _alert_out(detect.detect_impossible_travel(_events(spark, sf_dir)), description=False)


def d3_suspicious_ip(spark, sf_dir):
    return _alert_out(detect.detect_suspicious_ip(_events(spark, sf_dir), _feed(spark, sf_dir)))


def d4_privilege_escalation(spark, sf_dir):
    return _alert_out(detect.detect_privilege_escalation(_events(spark, sf_dir)))


def d5_unusual_hours(spark, sf_dir):
    return _alert_out(detect.detect_unusual_login_hours(_events(spark, sf_dir)))


def d6_multiple_failed_auth(spark, sf_dir):
    return _alert_out(detect.detect_multiple_failed_auth(_events(spark, sf_dir), LOOSE))


def d7_all_rules(spark, sf_dir):
    return _alert_out(detect.run_all_rules(_events(spark, sf_dir), _feed(spark, sf_dir), LOOSE), description=False)


def d8_evidence(spark, sf_dir):
    """Ids of every group alert with the alert's title, which names its group; one per row, for groups of any size."""
    events, feed = _events(spark, sf_dir), _feed(spark, sf_dir)
    alerts = detect.run_all_rules(events, feed, rules=[detect.SUSPICIOUS_IP, detect.PRIVILEGE])
    return detect.group_evidence(events, feed).join(alerts.select("alert_id", "title"), "alert_id").select("rule_name", "title", "event_id")


# ---------------------------------------------------------------- dashboard

def a1_kpis(spark, sf_dir):
    return _double(dashboard.kpis(_events(spark, sf_dir), _alerts(spark, sf_dir), _score_table(spark, sf_dir)), "avg_risk")


def a2_alert_filter(spark, sf_dir):
    found = dashboard.filter_alerts(_alerts(spark, sf_dir), ["critical", "medium"], [detect.TRAVEL, detect.OFF_HOURS, detect.BRUTE_FORCE])
    return _alert_out(found, description=False)


def a2_rule_options(spark, sf_dir):
    return dashboard.rule_options(_alerts(spark, sf_dir))


def a3_hourly_trend(spark, sf_dir):
    return _time(dashboard.hourly_trend(_alerts(spark, sf_dir)), "hour")


def a4_by_severity(spark, sf_dir):
    return dashboard.count_by(_alerts(spark, sf_dir), "severity")


def a5_top_ips(spark, sf_dir):
    return _double(dashboard.top_ips(_alerts(spark, sf_dir)), "max_risk")


def a6_by_rule(spark, sf_dir):
    return dashboard.count_by(_alerts(spark, sf_dir), "rule_name")


def a7_risk_by_user(spark, sf_dir):
    return _double(dashboard.risk_by_user(_alerts(spark, sf_dir)), "risk_score")


def a8_login_heatmap(spark, sf_dir):
    return dashboard.login_heatmap(_events(spark, sf_dir))


def a9_anomaly_summary(spark, sf_dir):
    return dashboard.anomaly_summary(_score_table(spark, sf_dir))


def a10_flagged_logins(spark, sf_dir):
    return _time(_double(dashboard.flagged_logins(_score_table(spark, sf_dir)), "anomaly_score"), "event_time")


def a10_alert_table(spark, sf_dir):
    return _time(_double(dashboard.alert_table(_alerts(spark, sf_dir)), "risk_score"), "detected_at")


def _marts(spark, sf_dir) -> Store:
    """Marts after two ingests and four changes of the alerts: older ones, the rest, some withdrawn, those raised again."""
    def make():
        store = Store(prepare(spark), new_scratch(spark, "store"))
        events, alerts = _events(spark, sf_dir).withColumn("event_date", F.to_date("event_time")), _alerts(spark, sf_dir).drop("detected_date")
        columns = [F.col(f.name) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS]
        early, seen = F.col("event_time") < F.lit(CUT), F.col("detected_at") < F.lit(CUT)
        for batch, (part, found) in enumerate(((early, seen), (~early, ~seen))):
            store.write_batch("normalized_events", events.filter(part).select(*columns, "event_date"), batch, by="event_date", rebalance=True)
            store.persist_alerts(alerts.filter(found))
            marts.refresh(store)
        store.change_alerts(alerts.filter(F.col("rule_name") == detect.OFF_HOURS).select("alert_id"), withdrawn=True)
        marts.refresh(store)
        store.persist_alerts(alerts)
        store.scores.replace(_score_table(spark, sf_dir).withColumns({
            "features": F.lit(None).cast(SCORES["features"].dataType), "scored_at": F.lit(CUT)}))
        marts.refresh(store)
        return store
    return _once(spark, sf_dir, "marts", make)


def a1_mart_kpis(spark, sf_dir):
    return _double(marts.kpis(_marts(spark, sf_dir)), "avg_risk")


def a3_mart_hourly_trend(spark, sf_dir):
    return _time(marts.hourly_trend(_marts(spark, sf_dir)), "hour")


def a4_mart_by_severity(spark, sf_dir):
    return marts.count_by(_marts(spark, sf_dir), "severity")


def a5_mart_top_ips(spark, sf_dir):
    return _double(marts.top_ips(_marts(spark, sf_dir)), "max_risk")


def a6_mart_by_rule(spark, sf_dir):
    return marts.count_by(_marts(spark, sf_dir), "rule_name")


def a7_mart_risk_by_user(spark, sf_dir):
    return _double(marts.risk_by_user(_marts(spark, sf_dir)), "risk_score")


def a8_mart_login_heatmap(spark, sf_dir):
    return marts.login_heatmap(_marts(spark, sf_dir))


def q2_mart_top_attackers(spark, sf_dir):
    return marts.top_attackers(_marts(spark, sf_dir))


# ---------------------------------------------------------------- saved searches

def q1_failure_buckets(spark, sf_dir):
    return _time(searches.brute_force_buckets(_events(spark, sf_dir), 2), "bucket")


def q2_top_attackers(spark, sf_dir):
    return searches.top_attackers(_events(spark, sf_dir))


def q3_privilege_activity(spark, sf_dir):
    return _time(_double(searches.privilege_activity(_alerts(spark, sf_dir)), "risk_score"), "detected_at")


def q4_off_hours(spark, sf_dir):
    return _time(searches.off_hours_logins(_events(spark, sf_dir)), "event_time")


def q5_severity_chart(spark, sf_dir):
    return _time(searches.severity_timechart(_alerts(spark, sf_dir)), "hour")


def q6_intel_alerts(spark, sf_dir):
    return _time(_double(searches.intel_alerts(_alerts(spark, sf_dir)), "risk_score"), "detected_at")


def q7_risk_leaderboard(spark, sf_dir):
    return _double(searches.risk_leaderboard(_alerts(spark, sf_dir)), "total_risk")


def q8_travel_alerts(spark, sf_dir):
    return _time(_double(searches.travel_alerts(_alerts(spark, sf_dir)).drop("description"), "risk_score"), "detected_at")


def q9_web_surface(spark, sf_dir):
    return searches.web_attack_surface(_events(spark, sf_dir))


def q10_multi_source_ips(spark, sf_dir):
    return searches.multi_source_ips(_events(spark, sf_dir)).withColumn("sources", F.array_join("sources", ","))


def q11_time_range(spark, sf_dir):
    return _alert_out(searches.in_range(_alerts(spark, sf_dir), "detected_at", AS_OF), description=False)


def q12_alert_summary(spark, sf_dir):
    return _double(searches.alert_summary(_alerts(spark, sf_dir)), "avg_risk")


def q13_panels(spark, sf_dir):
    recent = searches.in_range(_alerts(spark, sf_dir), "detected_at", AS_OF, 24 * 7)
    return _double(searches.risk_leaderboard(recent), "total_risk")


def q13_severity_panel(spark, sf_dir):
    return dashboard.count_by(searches.in_range(_alerts(spark, sf_dir), "detected_at", AS_OF, 24 * 7), "severity")


def q13_summary_panel(spark, sf_dir):
    return _double(searches.alert_summary(searches.in_range(_alerts(spark, sf_dir), "detected_at", AS_OF, 24 * 7)), "avg_risk")


def q13_recent_panel(spark, sf_dir):
    recent = searches.in_range(_alerts(spark, sf_dir), "detected_at", AS_OF, 24 * 7)
    return _time(_double(searches.recent_alerts(recent), "risk_score"), "detected_at")


def _in_week(spark, sf_dir) -> DataFrame:
    return searches.in_range(_alerts(spark, sf_dir), "detected_at", AS_OF, 24 * 7)


def q13_hour_severity_panel(spark, sf_dir):
    return _time(searches.severity_timechart(_in_week(spark, sf_dir)), "hour")


def q13_rule_panel(spark, sf_dir):
    return dashboard.count_by(_in_week(spark, sf_dir), "rule_name")


def q13_top_ips_panel(spark, sf_dir):
    return _double(dashboard.top_ips(_in_week(spark, sf_dir)), "max_risk")


def q14_recent_alerts(spark, sf_dir):
    return _time(_double(searches.recent_alerts(_alerts(spark, sf_dir)), "risk_score"), "detected_at")


# ---------------------------------------------------------------- windows, limits, sets

def w2_previous_login(spark, sf_dir):
    return detect.login_pairs(_events(spark, sf_dir)).select("id", F.col("previous.id").alias("previous_id"))


def w3_first_sighting(spark, sf_dir):
    return build_features(_events(spark, sf_dir)).filter("is_new_source_ip = 1").select("id", "username", "src_ip")


def w4_logins_last_day(spark, sf_dir):
    return build_features(_events(spark, sf_dir)).select("id", "username", "logins_last_24h")


def w5_split_hot_users(spark, sf_dir):
    """The features with every user's history cut into slices."""
    cut = build_features(_events(spark, sf_dir), Settings(max_rows_per_task=10))
    return _time(cut, "event_time")


def w6_first_last_value(spark, sf_dir):
    alerts = detect.detect_suspicious_ip(_events(spark, sf_dir), _feed(spark, sf_dir))
    return _time(alerts.select("src_ip", "username", "detected_at"), "detected_at")


def u2_distinct_sources(spark, sf_dir):
    return _events(spark, sf_dir).select("username", "source_type").distinct()


# ---------------------------------------------------------------- model

def m1_features(spark, sf_dir):
    return _time(build_features(_events(spark, sf_dir)), "event_time")


def m2_scores(spark, sf_dir):
    out = train_and_score(build_features(_events(spark, sf_dir)))
    return out.select("id", F.round("anomaly_score", 4).alias("anomaly_score"), "is_anomaly", *FEATURE_COLUMNS)


def _score_laws(scored: DataFrame, again: DataFrame) -> DataFrame:
    """One row of what holds for scores of any seed: who is scored, their range, how many are flagged, and that a second run agrees."""
    both = scored.join(again.select("id", F.col("anomaly_score").alias("_again")), "id")
    same = both.agg(F.count_if(F.col("anomaly_score") == F.col("_again")).alias("scored_alike"))
    share = Settings().contamination
    return scored.agg(
        F.count("*").alias("logins_scored"), F.count_distinct("id").alias("ids"),
        F.min("anomaly_score").cast("double").alias("lowest"), F.round(F.max("anomaly_score").cast("double"), 4).alias("highest"),
        (F.count_if("is_anomaly") <= F.ceil(F.count("*") * share)).alias("flagged_within_share"),
        (F.coalesce(F.min(F.when(F.col("is_anomaly"), F.col("anomaly_score"))), F.lit(1)) >= F.coalesce(
            F.max(F.when(~F.col("is_anomaly"), F.col("anomaly_score"))), F.lit(0))).alias("flagged_are_highest")).crossJoin(same)


def m2_score_laws(spark, sf_dir):
    features = build_features(_events(spark, sf_dir))
    return _score_laws(train_and_score(features), train_and_score(features.repartition(5)))


def m3_score_laws(spark, sf_dir):
    store = _ingested(spark, sf_dir)
    return _score_laws(jobs.run_scoring(store), train_and_score(build_features(store.events())).withColumn(
        "anomaly_score", F.col("anomaly_score").cast("decimal(6,4)")))


def m3_score_pipeline(spark, sf_dir):
    store = _ingested(spark, sf_dir)
    return jobs.run_scoring(store).select("id", "username", "anomaly_score", "is_anomaly")


# ---------------------------------------------------------------- streams

def _event_stream(spark, sf_dir):
    schema = _raw(spark, sf_dir).schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return map_events(raw)


def _drain(spark, df: DataFrame) -> DataFrame:
    """Run a stream to the end of its input into a table."""
    out = new_scratch(prepare(spark), "stream")
    query = (df.writeStream.format("parquet").option("path", f"{out}/table")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/table")


def _line_stream(spark, sf_dir) -> DataFrame:
    """All four sources as one stream of lines."""
    folders = _log_files(prepare(spark), sf_dir).items()
    return reduce(DataFrame.unionByName, [pipelines.stream_lines(spark, source, folder) for source, folder in folders])


def t1_stream_normalise(spark, sf_dir):
    return _event_out(_drain(spark, pipelines.stream_events(_line_stream(spark, sf_dir), YEAR)))


def t2_stream_failure_counts(spark, sf_dir):
    folder = new_scratch(prepare(spark), "counts")
    counts = pipelines.failure_counts(_event_stream(spark, sf_dir), 2)
    pipelines.count_sink(counts, folder, new_scratch(spark, "checkpoint")).awaitTermination()
    return _time(pipelines.latest_counts(spark, folder), "bucket")


FILES = 3


def _arrivals(spark, sf_dir, delayed) -> list[DataFrame]:
    """The events by when they arrive: in FILES parts of time, rows of ``delayed`` (id -> seconds) later by that much."""
    events = _events(spark, sf_dir).drop("k")
    seconds = F.unix_seconds("event_time")
    low, high = events.agg(F.min(seconds), F.max(seconds)).first()
    part = F.least(F.floor((seconds + delayed(F.col("id")) - low) * FILES / (high + 1 - low)), F.lit(FILES))
    staged = materialize(events.withColumn("part", part), "arrivals", by="part")
    return [staged.where(F.col("part") == k).drop("part") for k in range(FILES + 1)]


def _beat(events: DataFrame, at: datetime) -> DataFrame:
    """One event that moves a stream's clock."""
    row = events.sparkSession.createDataFrame([(at, keyed.HEARTBEAT)], "event_time timestamp, event_type string")
    return events.limit(0).unionByName(row, allowMissingColumns=True)


def _keyed(spark, sf_dir, rule, delayed) -> tuple[Store, keyed.KeyedRun]:
    """A stream over events that arrive in several parts; it is stopped and started again after each. A heartbeat ends it."""
    store, folder = Store(prepare(spark), new_scratch(spark, "store")), new_scratch(spark, "arriving")
    run = keyed.KeyedRun(spark, rule, store.persist_alerts, new_scratch(spark, "state"), lateness=timedelta(hours=24))
    parts, checkpoint = _arrivals(spark, sf_dir, delayed), new_scratch(spark, "checkpoint")
    parts[-1] = parts[-1].unionByName(_beat(parts[0], datetime(2030, 1, 1)))
    for part in parts:
        part.write.mode("append").parquet(folder)
        run.start(spark.readStream.schema(parts[0].schema).parquet(folder), checkpoint).awaitTermination()
    return store, run


def _some_hours(event_id):
    """Every fifth event comes 20 hours late, which the stream waits for."""
    return F.when(event_id % 5 == 0, 20 * 3600).otherwise(0)


def _some_days(event_id):
    """Every seventh event comes eight days late: long after the stream has closed its hour."""
    return F.when(event_id % 7 == 0, 8 * 86400).otherwise(0)


def t3_stream_brute_force(spark, sf_dir):
    return _alert_out(_keyed(spark, sf_dir, keyed.brute_force(LOOSE), _some_hours)[0].alerts())


def _late_data(spark, sf_dir, rule) -> DataFrame:
    """What is stored once late rows were repaired, and the late rows."""
    store, run = _keyed(spark, sf_dir, rule, _some_days)
    late = run.late_events()
    late_rule.repair(store, rule, late, _events(spark, sf_dir))
    alerts = store.alerts().select(F.lit("alert").alias("what"), F.col(rule.key).alias("key"), F.col("detected_at").alias("at"),
                                   F.array_join("event_ids", ",").alias("ids"))
    return _time(alerts.unionByName(late.select(F.lit("late").alias("what"), "key", F.col("event_time").alias("at"), F.col("id").cast("string").alias("ids"))),
                 "at")


def t7_late_data(spark, sf_dir):
    return _late_data(spark, sf_dir, keyed.brute_force(LOOSE))


def t7_late_travel(spark, sf_dir):
    return _late_data(spark, sf_dir, keyed.impossible_travel())


def t4_stream_off_hours(spark, sf_dir):
    stream = pipelines.off_hours_alerts(_event_stream(prepare(spark), sf_dir))
    return _alert_out(_drain(spark, stream))


def t4_stream_intel_match(spark, sf_dir):
    stream = pipelines.intel_matches(_event_stream(prepare(spark), sf_dir), _feed(spark, sf_dir))
    return _drain(spark, stream.select("id", "src_ip", "event_type"))


def t5_stream_alert_sink(spark, sf_dir):
    """The off-hours stream stored twice over; each alert is there once."""
    store = Store(prepare(spark), new_scratch(spark, "store"))
    for _ in range(2):
        stream = pipelines.off_hours_alerts(_event_stream(spark, sf_dir))
        pipelines.alert_sink(stream, store, new_scratch(spark, "checkpoint")).awaitTermination()
    return _alert_out(store.alerts())


def t6_stream_travel(spark, sf_dir):
    return _alert_out(_keyed(spark, sf_dir, keyed.impossible_travel(), _some_hours)[0].alerts(), description=False)


def t8_scheduled_refresh(spark, sf_dir):
    """Two ticks over the log files of all sources: each takes in what has arrived, and detects on that; the last one scores."""
    store = Store(prepare(spark), new_scratch(spark, "store"))
    feed, logs, checkpoint = (new_scratch(spark, label) for label in ("feed-csv", "logs", "checkpoint"))
    _feed(spark, sf_dir).write.csv(feed, header=True)
    events, early = _events(spark, sf_dir), F.col("event_time") < F.lit(CUT)
    for tick, part in enumerate((events.filter(early), events.filter(~early))):
        as_lines(part).select("source_type", "raw_message").write.mode("append").partitionBy("source_type").text(logs)
        lines = reduce(DataFrame.unionByName, [pipelines.stream_lines(spark, s, f"{logs}/source_type={s}") for s in _SOURCES])
        pipelines.scheduled_refresh(lines, store, checkpoint, YEAR, LOOSE, feed_path=feed, score=tick == 1)
    return store.alerts().groupBy("rule_name").agg(F.count("*").alias("n"), F.sum("n_events").alias("n_events"))


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and name[0] in "snjawdqumt" and name[1].isdigit()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brute-force alerts, 3 failures of one address in a week."""
    return _alert_out(detect.detect_brute_force(_events(spark, sf_dir), SMOKE))
