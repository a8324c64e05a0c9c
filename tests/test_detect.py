"""The rules on hand-made events."""

from datetime import datetime, timedelta

import pytest

from duskwatch.operators import detect, geo
from duskwatch.operators.alerts import alert_evidence
from duskwatch.schemas import EVENTS, GEO, INTEL
from duskwatch.settings import Settings

BASE = datetime(2026, 7, 1, 3)
S = Settings()


def events(spark, *rows):
    full = []
    for i, row in enumerate(rows, 1):
        full.append(tuple({"id": i, "severity": "low", "source_type": "linux_ssh", **row}.get(f.name) for f in EVENTS))
    return spark.createDataFrame(full, EVENTS)


def feed(spark, *ips):
    return spark.createDataFrame([(ip, "x", 90, "test") for ip in ips], INTEL)


def fail(seconds, **kw):
    return {"event_time": BASE + timedelta(seconds=seconds), "event_type": "login_failure",
            "src_ip": "45.155.204.33", "username": "svc", **kw}


def login(minutes, ip, user="noor", **kw):
    return {"event_time": BASE + timedelta(minutes=minutes), "event_type": "login_success", "src_ip": ip,
            "username": user, **kw}


def test_brute_force(spark):
    df = events(spark, *[fail(i * 20, username=None if i == 1 else f"u{i % 2}") for i in range(6)])
    (a,) = detect.detect_brute_force(df).collect()
    assert (a.rule_name, a.severity, a.src_ip, a.username) == ("brute_force_login", "high", "45.155.204.33", "u0")
    assert a.event_ids == [1, 2, 3, 4, 5] and float(a.risk_score) == 60.0 and a.status == "open"
    assert a.detected_at == BASE + timedelta(seconds=80)
    assert a.title == "Brute-force login attempts from 45.155.204.33"
    assert a.description == ("5 failed login attempts from 45.155.204.33 within 5 minutes "
                             "(targeting user(s): ['u0', 'u1']).")
    assert detect.detect_brute_force(events(spark, *[fail(i * 600) for i in range(3)])).count() == 0


def test_travel(spark):
    quick = events(spark, login(0, "10.3.0.8"), login(6, "198.51.100.140"))
    for ranges in (None, geo.sample_ranges(spark)):
        (a,) = detect.detect_impossible_travel(quick, ranges=ranges).collect()
        assert (a.severity, float(a.risk_score), a.event_ids, a.src_ip) == ("critical", 90.0, [1, 2], "198.51.100.140")
        assert a.description.startswith("noor logged in from Baltimore (Corporate HQ), US then Beijing, CN 6.0 minutes later")
    assert detect.detect_impossible_travel(events(spark, login(0, "10.3.0.8"), login(1200, "198.51.100.140"))).count() == 0
    # same city under another range; an unlocatable predecessor ends the pair; same instant is infinite speed
    edges = events(spark, login(0, "10.3.0.8", "a"), login(1, "192.168.1.1", "a"),
                   login(0, "10.3.0.8", "b"), login(1, "8.8.8.8", "b"), login(2, "198.51.100.140", "b"),
                   login(0, "10.3.0.8", "c"), login(0, "203.0.113.201", "c"),
                   login(0, "10.3.0.8", "d"), login(1, None, "d"), login(2, "203.0.113.201", "d"))
    got = {r.username: r for r in detect.detect_impossible_travel(edges).collect()}
    assert set(got) == {"c", "d"}
    assert "implied speed ~inf km/h" in got["c"].description


def test_travel_with_a_hot_user(spark):
    ips = ["10.3.0.8", "203.0.113.201", "8.8.8.8", "198.51.100.140"]
    df = events(spark, *[login((i * 37) % 5000, ips[i % 4]) for i in range(300)])
    whole = detect.detect_impossible_travel(df).select("event_ids").collect()
    cut = detect.detect_impossible_travel(df, Settings(max_rows_per_task=11)).select("event_ids").collect()
    assert len(whole) > 20 and sorted(whole) == sorted(cut)


@pytest.mark.parametrize("n,risk", [(1, 20.0), (2, 40.0), (5, 100.0), (7, 100.0)])
def test_suspicious_ip(spark, n, risk):
    rows = [{"event_time": BASE + timedelta(minutes=n - i), "event_type": "conn_allowed", "src_ip": "185.220.101.13",
             "username": None if i == n - 1 and n > 1 else f"u{i}"} for i in range(n)]
    df = events(spark, *rows, {"event_time": BASE, "event_type": "conn_allowed", "src_ip": "10.3.0.8"})
    bad = feed(spark, "185.220.101.13/32", "185.220.101.13")
    (a,) = detect.detect_suspicious_ip(df, bad).collect()
    assert float(a.risk_score) == risk and a.n_events == n
    assert sorted(r.event_id for r in detect.group_evidence(df, bad).collect()) == list(range(1, n + 1))
    assert a.detected_at == BASE + timedelta(minutes=n)
    assert a.username == (f"u{n - 2}" if n > 1 else "u0")
    assert detect.detect_suspicious_ip(df, feed(spark)).count() == 0


def test_group_alerts_keep_their_ids_in_the_evidence_rows(spark):
    rows = [{"event_time": BASE + timedelta(minutes=i), "event_type": "conn_allowed", "src_ip": ip}
            for i, ip in enumerate(["1.1.1.1"] * 5 + ["2.2.2.2"])]
    df, bad = events(spark, *rows, {"event_time": BASE, "event_type": "login_success", "username": "cy"}), feed(spark, "1.1.1.1", "2.2.2.2")
    got = {a.src_ip: a for a in detect.detect_suspicious_ip(df, bad).collect()}
    assert {k: (a.event_ids, a.n_events) for k, a in got.items()} == {"1.1.1.1": (None, 5), "2.2.2.2": (None, 1)}
    groups = detect.group_evidence(df, bad)
    want = [(got["1.1.1.1"].alert_id, i) for i in range(1, 6)] + [(got["2.2.2.2"].alert_id, 6)]
    assert sorted((r.alert_id, r.event_id) for r in groups.collect()) == sorted(want)
    both = detect.run_all_rules(df, bad, rules=[detect.SUSPICIOUS_IP, detect.OFF_HOURS])
    assert sorted(r.event_id for r in alert_evidence(both, groups).collect()) == list(range(1, 8))


def test_options_reach_the_rules(spark):
    at = lambda i, **kw: {"event_time": BASE + timedelta(minutes=i), "username": "dee", "host": "web01", **kw}
    df = events(spark, at(0, event_type="login_success", src_ip="10.9.0.1"), at(5, event_type="login_success", src_ip="10.8.0.1"),
                at(6, event_type="group_membership_change"))
    near = spark.createDataFrame([(0, "10.9.0.0/16", "AA", "Here", 0.0, 0.0), (1, "10.8.0.0/16", "BB", "There", 40.0, 120.0)], GEO)
    run = lambda **kw: {a.rule_name for a in detect.run_all_rules(df, feed(spark), options=detect.RuleOptions(**kw),
                                                                  rules=[detect.TRAVEL, detect.PRIVILEGE]).collect()}
    assert run() == set()
    assert run(ranges=near) == {detect.TRAVEL}
    assert run(include_group_changes=True) == {detect.PRIVILEGE}


@pytest.mark.parametrize("limits", [dict(max_broadcast_rows=1), dict(max_broadcast_rows=1, max_rows_per_task=4)])
def test_feeds_and_groups_too_large_to_broadcast(spark, limits):
    """The ways around a broadcast give the same alerts: big feed, hot address in it, many large groups."""
    rows = [{"event_time": BASE + timedelta(minutes=i), "event_type": "privilege_escalation", "username": f"u{ip}", "host": "h",
             "src_ip": ip} for i, ip in enumerate(["1.1.1.1"] * 9 + ["2.2.2.2"] * 6 + ["3.3.3.3"] * 5 + ["4.4.4.4"] * 2 + ["5.5.5.5"] * 7)]
    df, bad = events(spark, *rows), feed(spark, "1.1.1.1", "2.2.2.2", "3.3.3.3", "4.4.4.4")
    near = Settings(**limits)
    for run in (lambda s: detect.detect_suspicious_ip(df, bad, s), lambda s: detect.detect_privilege_escalation(df, s)):
        plain, got = ({a.alert_id: a for a in run(s).collect()} for s in (Settings(), near))
        assert got == plain and len(got) >= 4
    ids = [sorted(map(tuple, detect.group_evidence(df, bad, s).collect())) for s in (Settings(), near)]
    assert ids[0] == ids[1] and len(ids[0]) == 22 + 29


def test_privilege(spark):
    use = lambda i, **kw: {"event_time": BASE + timedelta(minutes=i), "event_type": "privilege_escalation",
                           "host": "web01", "username": "agarcia", **kw}
    df = events(spark, use(0), use(2, host=None), use(3, username=None), use(1, src_ip="10.0.0.12"),
                use(4, username="bo"), use(5, username="zed", event_type="group_membership_change"))
    got = {a.username: a for a in detect.detect_privilege_escalation(df).collect()}
    assert set(got) == {"agarcia", "bo"}
    assert (float(got["agarcia"].risk_score), got["agarcia"].n_events, got["agarcia"].src_ip) == (100.0, 2, "10.0.0.12")
    assert float(got["bo"].risk_score) == 60.0 and got["bo"].host is None
    assert detect.detect_privilege_escalation(df, include_group_changes=True).count() == 3


def test_off_hours(spark):
    at = lambda h, m=0, user="teodor": {"event_time": datetime(2026, 7, 1, h, m), "event_type": "login_success", "username": user}
    got = detect.detect_unusual_login_hours(events(spark, at(3, 5), at(6), at(10), at(21, 59), at(22), at(5, 59, None))).collect()
    assert sorted(a.event_ids[0] for a in got) == [1, 5, 6]
    first = next(a for a in got if a.event_ids == [1])
    assert first.title == "Off-hours login by teodor" and float(first.risk_score) == 30.0
    assert first.description == "teodor logged in at 03:05 UTC, outside the configured business-hours window (6:00-22:00)."
    assert next(a for a in got if a.event_ids == [6]).title == "Off-hours login by None"


def test_multiple_failed(spark):
    rows = [fail(i * 180, username="ines", src_ip="103.21.244.60",
                 **({"source_type": "web_server", "event_type": "http_auth_failure"} if i == 9 else {})) for i in range(10)]
    (a,) = detect.detect_multiple_failed_auth(events(spark, *rows, fail(0, username=None))).collect()
    assert (a.username, a.src_ip, float(a.risk_score)) == ("ines", "103.21.244.60", 60.0)
    assert a.description == ("10 failed authentication events for user ines across sources "
                             "['linux_ssh', 'web_server'] within 60 minutes.")


def test_locate_by_feed_prefers_the_first_range(spark):
    from duskwatch.schemas import GEO
    ranges = spark.createDataFrame([(1, "10.0.0.0/8", "A", "wide", 0.0, 0.0), (0, "10.1.0.0/16", "B", "narrow", 1.0, 1.0),
                                    (2, "10.1.2.0/24", "C", "late", 2.0, 2.0), (3, "0.0.0.0/0", "D", "rest", 3.0, 3.0)], GEO)
    ips = spark.createDataFrame([("10.1.2.3",), ("10.9.9.9",), ("11.0.0.1",), ("300.1.1.1",), ("::1",), ("01.2.3.4",)], "src_ip string")
    got = {r.src_ip: r.geo and r.geo.city for r in geo.locate_all(ips, ranges).collect()}
    assert got == {"10.1.2.3": "narrow", "10.9.9.9": "wide", "11.0.0.1": "rest", "300.1.1.1": None, "::1": None, "01.2.3.4": None}


def test_all_rules_together_with_hot_keys(spark):
    """run_all_rules measures hot keys once for all rules; results do not depend on where it cuts."""
    import random
    rng = random.Random(8)
    rows = [{"event_time": BASE + timedelta(minutes=rng.randrange(2000)), "username": rng.choice(["hot"] * 4 + ["b", None]),
             "src_ip": rng.choice(["203.0.113.201", "10.3.0.8", "203.0.113.201", "198.51.100.140", None]), "host": "h",
             "event_type": rng.choice(["login_failure", "login_success", "http_auth_failure", "privilege_escalation"])} for _ in range(700)]
    df, bad = events(spark, *rows), feed(spark, "203.0.113.201")
    near = Settings(brute_force_minutes=60, multi_fail_threshold=4)
    cut = Settings(brute_force_minutes=60, multi_fail_threshold=4, max_rows_per_task=15)
    whole = sorted(map(str, detect.run_all_rules(df, bad, near).collect()))
    assert sorted(map(str, detect.run_all_rules(df, bad, cut).collect())) == whole and len(whole) > 100
    assert len({r.rule_name for r in detect.run_all_rules(df, bad, near).select("rule_name").collect()}) == 6


def test_own_rule(spark):
    df = events(spark, fail(0))
    detect.register_rule("own", lambda e, intel, s: detect.detect_unusual_login_hours(
        e.withColumn("event_type", detect.F.lit("login_success")), s))
    try:
        assert detect.run_all_rules(df, feed(spark), rules=["own"]).count() == 1
    finally:
        del detect.RULES["own"]
