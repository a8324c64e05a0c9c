"""The batch jobs: ingest, detect, score, export. Each orders its own stages over one ``Store``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators import detect
from duskwatch.operators.alerts import ALERT_COLUMNS
from duskwatch.operators.features import build_features
from duskwatch.operators.forest import train_and_score
from duskwatch.operators.intel import known_bad_ips
from duskwatch.operators.normalize import events_of, normalize, rejects_of
from duskwatch.operators.normalize.base import reject_reason
from duskwatch.plans import marts
from duskwatch.schemas import EVENTS, FEATURE_COLUMNS, RAW_LOGS
from duskwatch.session import materialize, prepare, release
from duskwatch.settings import Settings
from duskwatch.sources.export import alert_envelopes, event_envelopes, evidence_envelopes, write_envelopes
from duskwatch.sources.feed import read_feed
from duskwatch.sources.lines import read_all_lines, read_lines
from duskwatch.sources.tables import Store
from duskwatch.streaming import keyed, late


@dataclass(frozen=True)
class IngestResult:
    batch: int
    lines: int
    events: int


def event_rows(normalized: DataFrame) -> DataFrame:
    """Good lines as rows of the event table. A line gives at most one event, so they share an id."""
    good = events_of(normalized)
    values = {"id": F.col("raw_id"), "raw_log_id": F.col("raw_id"), "created_at": F.current_timestamp()}
    return good.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in EVENTS])


def numbered_lines(store: Store, staged: DataFrame, batch: int) -> DataFrame:
    """``staged`` lines with ``raw_id`` for their ``_place`` (part of the input and row in it)."""
    part = F.shiftright("_place", 33)
    # a row per task that read the input
    counts = staged.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    base, offsets = store.reserve_ids(batch, sum(r["n"] for r in counts)), []
    for r in counts:
        offsets.append((r["_part"], base))
        base += r["n"]
    first = store.spark.createDataFrame(offsets, "_part bigint, _first bigint")
    placed = staged.withColumn("_part", part).join(F.broadcast(first), "_part")
    return placed.withColumn("raw_id", F.col("_first") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_first", "_place")


def ingest(store: Store, lines: DataFrame, batch: int, year: int | None = None) -> IngestResult:
    """Store a batch of lines as raw rows, events and rejects.

    Ids are dense and given once, when the lines are staged with their place in the input: the batch's reserved range begins them, a line's part
    and place in it tell which is whose. Lines are parsed once, from there; raw rows, events and rejects are columns of that parse, so a
    lost executor or a second attempt sees the same ids. Running a batch again replaces that batch; the same files split alike get the same ids.
    """
    # by_source filters below an id would run the input once per source; staged by source each branch reads its own files
    staged = materialize(lines.withColumn("_place", F.monotonically_increasing_id()), "numbered", by="source_type")
    numbered = numbered_lines(store, staged, batch)
    parsed = materialize(normalize(numbered, year, by_source=True), "parsed")
    raw = parsed.withColumn("processed", F.col("event_type").isNotNull()).withColumn("ingested_at", F.current_timestamp())
    store.write_batch("raw_logs", raw.select(*[F.col(f.name).cast(f.dataType) for f in RAW_LOGS]), batch, by="source_type")
    marts.drop_event_mart(store, batch)
    events = event_rows(parsed).withColumn("event_date", F.to_date("event_time"))
    store.write_batch("normalized_events", events, batch, by="event_date", rebalance=True)
    marts.write_event_mart(store, batch)
    store.write_batch("rejects", rejects_of(parsed).select("raw_id", "source_type", "raw_message", "path", "reason"), batch)
    counts = parsed.agg(F.count("*"), F.count_if(reject_reason().isNull())).first()
    for table in (staged, parsed):
        release(table)
    return IngestResult(batch, *counts)


def ingest_file(store: Store, source_type: str, path: str, batch: int, year: int | None = None) -> IngestResult:
    return ingest(store, read_lines(prepare(store.spark), source_type, path), batch, year)


def ingest_all(store: Store, paths: dict[str, str], batch: int, year: int | None = None) -> IngestResult:
    """All sources at once; missing inputs are skipped."""
    return ingest(store, read_all_lines(prepare(store.spark), paths), batch, year)


def run_detection(store: Store, settings: Settings = Settings(), feed_path: str | None = None, since=None,
                  options: detect.RuleOptions = detect.RuleOptions()) -> int:
    """Load the feed, run every rule over the stored events, store what is new; returns how many.

    New evidence of group alerts is logged first. A run that dies in between leaves evidence without its alert,
    which readers do not see; never an alert without its evidence.
    """
    prepare(store.spark)
    if feed_path:
        store.upsert_intel(read_feed(store.spark, feed_path, with_place=True))
    events, intel = store.events(since), store.intel.read()
    hits = materialize(detect.group_hits(events, intel, settings, options), "group-hits")
    store.mark_alerts(detect.group_alert_ids(hits), store.log_evidence(hits))
    return store.persist_alerts(_group_alerts(hits).unionByName(
        detect.run_all_rules(events, intel, settings, [name for name in detect.RULES if name not in _logged_rules()], options)))


def _logged_rules() -> list[str]:
    """The group rules, unless a deployment put its own in their place."""
    return [name for name in detect.GROUP_RULES if detect.RULES.get(name) is detect.BUILT_IN[name]]


def _group_alerts(hits: DataFrame) -> DataFrame:
    return detect.group_alerts(hits).where(F.col("rule_name").isin(_logged_rules())).select(*ALERT_COLUMNS)


def detect_changes(store: Store, settings: Settings = Settings(), feed_path: str | None = None,
                   options: detect.RuleOptions = detect.RuleOptions(), batches: list[int] | None = None) -> int:
    """``run_detection`` for what came since the last call: the events of new ingest ``batches`` and addresses new in the feed.

    Rules that a deployment registered itself run over all events.

    Group rules log the new hits and sum up the log of the groups that grew. Keyed rules read the touched
    sessions of the touched keys (``streaming.late``) and withdraw alerts that out-of-order rows undid. Off-hours logins are looked for
    among new events only. History is read in full for new addresses of the feed alone. A batch that was ingested again is named by the caller.
    """
    spark = prepare(store.spark)
    if feed_path:
        store.upsert_intel(read_feed(spark, feed_path, with_place=True))
    now, intel = store.batches(), store.intel.read()
    seen = {r["ingest_batch"] for r in store.seen_batches.read().collect()}
    fresh = [b for b in now if b not in seen] if batches is None else batches
    events = store.events()
    changed = events.where(F.col("ingest_batch").isin(fresh)) if fresh else events.limit(0)
    known = materialize(known_bad_ips(intel).select("src_ip").distinct(), "known-ips")
    new_ips = known.join(store.seen_ips.read(), "src_ip", "left_anti")
    hits = detect.group_hits(changed, intel, settings, options)
    if not new_ips.isEmpty():
        listed = intel.join(new_ips.withColumnRenamed("src_ip", "ip"), "ip", "left_semi")
        older = detect.group_hits(events, listed, settings, options).where(F.col("rule_name") == detect.SUSPICIOUS_IP)
        hits = hits.unionByName(older).dropDuplicates(["rule_name", "id"])
    hits = materialize(hits, "group-hits")
    run = store.log_evidence(hits)
    touched = hits.select("rule_name", "group_key").distinct()
    grown = materialize(store.evidence().drop("run").join(touched, ["rule_name", "group_key"], "left_semi"), "grown-groups")
    store.mark_alerts(detect.group_alert_ids(grown), run)
    fresh_alerts = _group_alerts(grown)
    own = [name for name in detect.RULES if detect.RULES[name] is not detect.BUILT_IN.get(name)]
    if own:  # of these nothing is known but that they read all events
        fresh_alerts = fresh_alerts.unionByName(detect.run_all_rules(events, intel, settings, own, options))
    if detect.OFF_HOURS in detect.RULES and detect.OFF_HOURS not in own:
        fresh_alerts = fresh_alerts.unionByName(detect.detect_unusual_login_hours(changed, settings).select(*ALERT_COLUMNS))
    written = store.persist_alerts(fresh_alerts)
    for rule in (keyed.brute_force(settings), keyed.multiple_failed_auth(settings), keyed.impossible_travel(settings, options.ranges)):
        if rule.name in own or rule.name not in detect.RULES:
            continue
        rows = changed.where(rule.relevant).select(F.col(rule.key).alias("key"), "event_time")
        written += late.repair(store, rule, rows, events, settings.max_rows_per_task).added
    store.seen_ips.replace(known)
    store.seen_batches.replace(spark.createDataFrame([(b,) for b in now], store.seen_batches.schema))  # last: it marks the run complete
    return written


def score_rows(scored: DataFrame) -> DataFrame:
    return scored.select(
        "id", "username", "event_time", F.col("anomaly_score").cast("decimal(6,4)").alias("anomaly_score"), "is_anomaly",
        F.struct(*FEATURE_COLUMNS).alias("features"), F.current_timestamp().alias("scored_at"))


def run_scoring(store: Store, settings: Settings = Settings()) -> DataFrame:
    """Score every login and replace the score table with this run's view."""
    prepare(store.spark)
    store.scores.replace(score_rows(train_and_score(build_features(store.events(), settings), settings)))
    return store.scores.read()


def export(store: Store, path: str, what: str = "all", settings: Settings = Settings()) -> None:
    if what not in ("events", "alerts", "all"):
        raise ValueError("what must be events, alerts or all")
    if what in ("events", "all"):
        write_envelopes(event_envelopes(store.events().drop("ingest_batch", "event_date"), settings.export_index), f"{path}/events")
    if what in ("alerts", "all"):
        write_envelopes(alert_envelopes(store.alerts().drop("detected_date"), settings.export_index), f"{path}/alerts")
        write_envelopes(evidence_envelopes(store.alert_events(), store.alerts(), settings.export_index), f"{path}/alert_evidence")


def with_raw_lines(events: DataFrame, raw: DataFrame) -> DataFrame:
    """Events with the line they came from, for audit."""
    lines = raw.select(F.col("raw_id").alias("raw_log_id"), "raw_message", "path")
    return events.join(lines, "raw_log_id", "left")


