"""The six detection rules, each ``DataFrame of events -> DataFrame of alerts``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.functions.net import haversine_km, speed_kmh
from duskwatch.functions.scoring import alert_id, group_hashes
from duskwatch.functions.text import or_none, quoted_list
from duskwatch.operators import geo
from duskwatch.operators.alerts import ALERT_COLUMNS, alert_rows
from duskwatch.operators.greedy import threshold_windows
from duskwatch.operators.hot_keys import KeySplit, hot_keys_of, micros
from duskwatch.operators.intel import hint_if_small, known_bad_ips, semi_join
from duskwatch.session import materialize
from duskwatch.settings import Settings

MINUTE_US = 60 * 1_000_000

# Rule names.
BRUTE_FORCE = "brute_force_login"
TRAVEL = "impossible_travel"
SUSPICIOUS_IP = "suspicious_ip_threat_intel"
PRIVILEGE = "privilege_escalation"
OFF_HOURS = "unusual_login_hours"
MULTI_FAIL = "multiple_failed_auth"


def off_hours(settings: Settings):
    hour = F.hour("event_time")
    return (hour < settings.business_start_hour) | (hour >= settings.business_end_hour)


# Rules that keep a key's events in order: (key, rows). Their hot keys are measured before they are planned.
KEYED_RULES = {
    BRUTE_FORCE: ("src_ip", "event_type = 'login_failure' AND src_ip IS NOT NULL"),
    TRAVEL: ("username", "event_type = 'login_success' AND src_ip IS NOT NULL AND username IS NOT NULL"),
    MULTI_FAIL: ("username", "event_type IN ('login_failure', 'http_auth_failure') AND username IS NOT NULL"),
}


def detect_brute_force(events: DataFrame, settings: Settings = Settings(), hot: list | DataFrame | None = None) -> DataFrame:
    """Repeated login failures from one address within a short span."""
    k, minutes = settings.brute_force_threshold, settings.brute_force_minutes
    failures = events.filter(KEYED_RULES[BRUTE_FORCE][1])
    return brute_force_alerts(
        threshold_windows(failures, "src_ip", k, minutes * MINUTE_US, ("username",), settings.max_rows_per_task, hot), settings)


def brute_force_alerts(found: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Alerts of windows of failures (``src_ip``, ``event_time``, ``members``)."""
    k, minutes = settings.brute_force_threshold, settings.brute_force_minutes
    ip, users = F.col("src_ip"), F.array_sort(F.array_distinct(F.array_compact(F.col("members.username"))))
    return alert_rows(
        found, rule=BRUTE_FORCE, severity="high", src_ip=ip, username=F.col("members")[k - 1]["username"],
        title=F.concat(F.lit("Brute-force login attempts from "), ip),
        description=F.concat(F.lit(f"{k} failed login attempts from "), ip,
                             F.lit(f" within {minutes} minutes (targeting user(s): "), quoted_list(users), F.lit(").")),
        event_ids=F.col("members.id"), detected_at=F.col("event_time"))


def detect_multiple_failed_auth(events: DataFrame, settings: Settings = Settings(), hot: list | DataFrame | None = None) -> DataFrame:
    """Repeated authentication failures of one account over all sources."""
    k, minutes = settings.multi_fail_threshold, settings.multi_fail_minutes
    failures = events.filter(KEYED_RULES[MULTI_FAIL][1])
    return multiple_failed_auth_alerts(
        threshold_windows(failures, "username", k, minutes * MINUTE_US, ("src_ip", "source_type"), settings.max_rows_per_task, hot), settings)


def multiple_failed_auth_alerts(found: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Alerts of windows of failures (``username``, ``event_time``, ``members``)."""
    k, minutes = settings.multi_fail_threshold, settings.multi_fail_minutes
    user, sources = F.col("username"), F.array_sort(F.array_distinct(F.col("members.source_type")))
    return alert_rows(
        found, rule=MULTI_FAIL, severity="high", src_ip=F.col("members")[k - 1]["src_ip"], username=user,
        title=F.concat(F.lit("Repeated failed authentication for "), user),
        description=F.concat(F.lit(f"{k} failed authentication events for user "), user, F.lit(" across sources "),
                             quoted_list(sources), F.lit(f" within {minutes} minutes.")),
        event_ids=F.col("members.id"), detected_at=F.col("event_time"))


def login_pairs(events: DataFrame, settings: Settings = Settings(), ranges: DataFrame | None = None,
                hot: list | DataFrame | None = None) -> DataFrame:
    """Every login with its immediate predecessor of the same user, both located.

    Adds ``geo``, ``previous`` (struct), ``seconds``, ``distance_km``, ``speed_kmh``.
    ``ranges`` is an optional geo feed; the built-in ranges need no join.
    """
    logins = events.filter(KEYED_RULES[TRAVEL][1])
    split = KeySplit(logins, "username", settings.max_rows_per_task, hot=hot)
    logins = logins.select("username", "event_time", "id", "src_ip").withColumn("_at", micros())
    if ranges is None:
        logins = geo.locate(logins)
    else:
        logins = geo.locate_all(logins, ranges, max_broadcast_rows=settings.max_broadcast_rows)
    rows = split.apply(logins, context_rows=1)
    order = Window.partitionBy("username", "slice").orderBy("event_time", "id")
    rows = rows.withColumn("previous", F.lag(F.struct("id", "event_time", "src_ip", "geo")).over(order))
    return measured(rows.filter("own AND previous IS NOT NULL"))


def measured(pairs: DataFrame) -> DataFrame:
    """Located logins with their ``previous`` one: ``seconds``, ``distance_km`` and ``speed_kmh`` between them."""
    a, b = F.col("previous.geo"), F.col("geo")
    return (pairs.withColumn("seconds", (micros() - F.unix_micros("previous.event_time")) / 1e6)
            .withColumn("distance_km", haversine_km(a["lat"], a["lon"], b["lat"], b["lon"]))
            .withColumn("speed_kmh", speed_kmh(F.col("distance_km"), F.col("seconds")))
            .select("username", "event_time", "id", "src_ip", "geo", "previous", "seconds", "distance_km", "speed_kmh"))


def detect_impossible_travel(events: DataFrame, settings: Settings = Settings(),
                             ranges: DataFrame | None = None, hot: list | DataFrame | None = None) -> DataFrame:
    """Consecutive logins of a user in two cities that no flight connects in time."""
    return travel_alerts(login_pairs(events, settings, ranges, hot), settings)


def travel_alerts(pairs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Alerts of ``measured`` pairs."""
    prev, here, user = F.col("previous"), F.col("geo"), F.col("username")
    found = pairs.filter(
        (prev["geo"]["city"] != here["city"]) & (F.col("speed_kmh") > settings.max_travel_kmh))
    speed = F.col("speed_kmh")
    speed_text = F.when(speed == float("inf"), F.lit("inf")).otherwise(F.format_number(F.bround(speed, 0), 0))
    place = lambda p: F.concat(p["city"], F.lit(", "), p["country"])
    return alert_rows(
        found, rule=TRAVEL, severity="critical", src_ip=F.col("src_ip"), username=user,
        title=F.concat(F.lit("Impossible travel detected for user "), user),
        description=F.concat(user, F.lit(" logged in from "), place(prev["geo"]), F.lit(" then "), place(here), F.lit(" "),
                             F.format_string("%.1f", F.bround(F.col("seconds") / 60, 1)),
                             F.lit(" minutes later (implied speed ~"), speed_text, F.lit(" km/h).")),
        event_ids=F.array(prev["id"], F.col("id")), detected_at=F.col("event_time"))


def intel_hits(events: DataFrame, intel: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Events from an address in the threat feed."""
    return semi_join(events, known_bad_ips(intel), settings)


def _summed(rows: DataFrame, keys: list[str], shown: str) -> DataFrame:
    """Count, latest time, first non-NULL ``shown`` in time order and identity of each group.

    Partial aggregates throughout: a hot group is reduced map-side.
    """
    h1, h2 = group_hashes(F.col("id"))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_events"), F.max("event_time").alias("last_seen"),
        F.expr(f"min_by({shown}, struct(event_time, id)) FILTER (WHERE {shown} IS NOT NULL)").alias(shown),
        h1.alias("_h1"), h2.alias("_h2"))


def detect_suspicious_ip(events: DataFrame, intel: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One alert per known-bad address seen, over all its events."""
    return suspicious_ip_alerts(intel_hits(events, intel, settings))


def suspicious_ip_alerts(hits: DataFrame) -> DataFrame:
    groups = _summed(hits, ["src_ip"], "username")
    ip, n = F.col("src_ip"), F.col("n_events")
    return alert_rows(
        groups, rule=SUSPICIOUS_IP, severity="high", src_ip=ip, username=F.col("username"),
        title=F.concat(F.lit("Traffic from known-malicious IP "), ip),
        description=F.concat(n.cast("string"), F.lit(" event(s) observed from "), ip,
                             F.lit(", which matches a known-bad indicator in the threat intelligence feed.")),
        n_events=n, hashes=(F.col("_h1"), F.col("_h2")),
        multiplier=F.least(n / 3, F.lit(2.0)), detected_at=F.col("last_seen"))


def privilege_events(events: DataFrame, include_group_changes: bool = False) -> DataFrame:
    kinds = ["privilege_escalation"] + (["group_membership_change"] if include_group_changes else [])
    return events.filter(F.col("event_type").isin(*kinds) & F.col("username").isNotNull() & F.col("host").isNotNull())


def detect_privilege_escalation(events: DataFrame, settings: Settings = Settings(),
                                include_group_changes: bool = False) -> DataFrame:
    """One alert per (account, host) that used elevated privileges."""
    return privilege_alerts(privilege_events(events, include_group_changes))


def privilege_alerts(used: DataFrame) -> DataFrame:
    groups = _summed(used, ["username", "host"], "src_ip")
    user, host, n = F.col("username"), F.col("host"), F.col("n_events")
    return alert_rows(
        groups, rule=PRIVILEGE, severity="high", src_ip=F.col("src_ip"), username=user,
        title=F.concat(F.lit("Privilege escalation activity by "), user, F.lit(" on "), host),
        description=F.concat(n.cast("string"), F.lit(" privilege-escalation event(s) (sudo/admin-token) by "), user,
                             F.lit(" on "), host, F.lit(".")),
        n_events=n, hashes=(F.col("_h1"), F.col("_h2")),
        multiplier=F.least(n, F.lit(3)), detected_at=F.col("last_seen"))


def detect_unusual_login_hours(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Logins outside business hours; stateless, one alert per login."""
    found = events.filter((F.col("event_type") == "login_success") & off_hours(settings))
    user = or_none(F.col("username"))
    hours = f"({settings.business_start_hour}:00-{settings.business_end_hour}:00)"
    return alert_rows(
        found, rule=OFF_HOURS, severity="medium", src_ip=F.col("src_ip"), username=F.col("username"),
        title=F.concat(F.lit("Off-hours login by "), user),
        description=F.concat(user, F.lit(" logged in at "), F.date_format("event_time", "HH:mm"),
                             F.lit(f" UTC, outside the configured business-hours window {hours}.")),
        event_ids=F.array("id"), detected_at=F.col("event_time"))


@dataclass(frozen=True)
class RuleOptions:
    """What a deployment may set: a geo feed for travel (None: the built-in ranges), group changes as privilege use."""

    ranges: DataFrame | None = None
    include_group_changes: bool = False


# Detectors run by run_all_rules, in order: (events, intel, settings, hot keys by rule, options) -> alerts.
RULES: dict[str, Callable[..., DataFrame]] = {
    BRUTE_FORCE: lambda events, intel, s, hot, opt: detect_brute_force(events, s, hot.get(BRUTE_FORCE)),
    TRAVEL: lambda events, intel, s, hot, opt: detect_impossible_travel(events, s, opt.ranges, hot.get(TRAVEL)),
    SUSPICIOUS_IP: lambda events, intel, s, hot, opt: detect_suspicious_ip(events, intel, s),
    PRIVILEGE: lambda events, intel, s, hot, opt: detect_privilege_escalation(events, s, opt.include_group_changes),
    OFF_HOURS: lambda events, intel, s, hot, opt: detect_unusual_login_hours(events, s),
    MULTI_FAIL: lambda events, intel, s, hot, opt: detect_multiple_failed_auth(events, s, hot.get(MULTI_FAIL)),
}


BUILT_IN = dict(RULES)


def register_rule(name: str, detector: Callable[[DataFrame, DataFrame, Settings], DataFrame]) -> None:
    """Add (or replace) a detector ``(events, intel, settings) -> alerts``."""
    RULES[name] = lambda events, intel, s, hot, opt: detector(events, intel, s)


def run_all_rules(events: DataFrame, intel: DataFrame, settings: Settings = Settings(),
                  rules: list[str] | None = None, options: RuleOptions = RuleOptions()) -> DataFrame:
    """Alerts of all rules as one frame. Each rule scans only its event types and columns.

    The hot keys of all rules are measured in one pass before any rule is planned.
    """
    names = list(rules or RULES)
    keyed = {name: KEYED_RULES[name] for name in names if name in KEYED_RULES}
    hot = {}
    if keyed:
        relevant = events.filter(" OR ".join(f"({condition})" for _, condition in keyed.values()))
        hot = hot_keys_of(relevant, keyed, settings.max_rows_per_task)
    return reduce(DataFrame.unionByName,
                  [RULES[name](events, intel, settings, hot, options).select(*ALERT_COLUMNS) for name in names])


GROUP_RULES = (SUSPICIOUS_IP, PRIVILEGE)
HIT_COLUMNS = ["rule_name", "group_key", "src_ip", "username", "host", "event_time", "id"]


def group_hits(events: DataFrame, intel: DataFrame, settings: Settings = Settings(), options: RuleOptions = RuleOptions()) -> DataFrame:
    """The events the two group rules rest on, narrow: ``HIT_COLUMNS``. ``group_key`` names the group within its rule."""
    def rows(rule, found, key):
        return found.select(F.lit(rule).alias("rule_name"), key.alias("group_key"), *HIT_COLUMNS[2:])

    return rows(SUSPICIOUS_IP, intel_hits(events, intel, settings), F.col("src_ip")).unionByName(
        rows(PRIVILEGE, privilege_events(events, options.include_group_changes), F.to_json(F.struct("username", "host"))))


def group_alerts(hits: DataFrame) -> DataFrame:
    """Alerts of both group rules from ``group_hits``."""
    return suspicious_ip_alerts(hits.filter(F.col("rule_name") == SUSPICIOUS_IP)).unionByName(
        privilege_alerts(hits.filter(F.col("rule_name") == PRIVILEGE)))


def group_alert_ids(hits: DataFrame) -> DataFrame:
    """(alert_id, rule_name, group_key): the alert each group of ``group_hits`` has now. Summed map-side, whatever a group's size."""
    h1, h2 = group_hashes(F.col("id"))
    groups = hits.groupBy("rule_name", "group_key").agg(F.count("*").alias("n"), h1.alias("_h1"), h2.alias("_h2"))
    return groups.select(alert_id(F.col("rule_name"), F.col("n"), F.col("_h1"), F.col("_h2")).alias("alert_id"), "rule_name", "group_key")


def group_evidence(events: DataFrame, intel: DataFrame, settings: Settings = Settings(), options: RuleOptions = RuleOptions()) -> DataFrame:
    """Evidence of the two group rules, one row per event: (alert_id, rule_name, event_time, event_id).

    Nothing is gathered, whatever a group's size: the groups are counted, and go to the events by broadcast where they are few;
    otherwise AQE splits the event side of a hot group.
    """
    hits = materialize(group_hits(events, intel, settings, options), "group-hits")
    ids = hint_if_small(materialize(group_alert_ids(hits), "groups"), settings.max_broadcast_rows)
    return hits.join(ids, ["rule_name", "group_key"]).select("alert_id", "rule_name", "event_time", F.col("id").alias("event_id"))
