"""End to end on log files: ingest, detect twice, score, export.

Four days of one site, in which every rule has something to find: guesses at made-up accounts from one address over two
sources, an account in two cities, administration on two hosts, one late login, and a build account whose password expired.
"""

import json
from datetime import datetime, timedelta

import pytest

from duskwatch.operators import detect
from duskwatch.plans import dashboard, jobs, searches
from duskwatch.schemas import INTEL
from duskwatch.settings import Settings
from duskwatch.sources.lines import read_lines
from duskwatch.sources.tables import Store

DAY = datetime(2026, 3, 10)


def win(t, code, user, ip):
    return f"{t:%Y-%m-%dT%H:%M:%SZ} EventID={code} Account={user} LogonType=3 SourceIP={ip} Workstation=APP-02 Status=x"


def ssh(t, what):
    return f"{t:%b} {t.day:2d} {t:%H:%M:%S} db9 {what}"


def files():
    at = lambda h, m=0, s=0, d=0: DAY + timedelta(days=d, hours=h, minutes=m, seconds=s)
    windows, linux, firewall, web = [], [], [], []
    for d in range(4):
        for i, (user, ip) in enumerate([("noor", "172.16.4.9"), ("wanda", "172.16.4.20"), ("teodor", "192.168.7.3"), ("lu", "192.168.7.8")]):
            windows.append(win(at(7, 30 + 7 * i, d=d), 4624, user, ip))
            firewall.append(f"{at(12, 5 * i, d=d):%Y-%m-%dT%H:%M:%SZ},edge2,ALLOW,TCP,{ip},10.0.0.10,8443")
    for i in range(21):  # four full windows of five, and one failure left over
        if i % 2:
            linux.append(ssh(at(15, 40, 12 * i), f"sshd[{i}]: Failed password for invalid user ora{i % 3} from 185.220.101.77 port {i} ssh2"))
        else:
            windows.append(win(at(15, 40, 12 * i), 4625, f"guest{i % 3}", "185.220.101.77"))
    windows += [win(at(11, 30), 4624, "noor", "172.16.4.9"), win(at(11, 52), 4624, "noor", "45.155.204.201"),
                win(at(13, 5), 4672, "wanda", "172.16.4.20"), win(at(13, 9), 4728, "wanda", "172.16.4.20"),
                win(at(23, 20, d=3), 4624, "teodor", "192.168.7.3")]
    for m in (2, 3, 44):
        linux.append(ssh(at(9, m), "sudo: wanda : TTY=pts/2 ; PWD=/srv ; USER=root ; COMMAND=/usr/bin/systemctl"))
    for i in range(7):
        linux.append(ssh(at(16, 3 * i), f"sshd[{i}]: Failed password for build from 103.21.244.17 port {i} ssh2"))
    for i in range(4):
        web.append(f'103.21.244.17 - build [{at(16, 25 + 5 * i):%d/%b/%Y:%H:%M:%S} +0000] "GET /artifacts HTTP/1.1" 401 9 "-" "agent"')
    web += ["", "   ", "garbage"]
    return {"windows_auth": windows, "linux_ssh": linux, "firewall": firewall, "web_server": web}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("logs")
    paths = {}
    for source, lines in files().items():
        (root / f"{source}.log").write_text("\n".join(lines) + "\n")
        paths[source] = str(root / f"{source}.log")
    (root / "feed.csv").write_text("ip,category,confidence,source\n185.220.101.77,guessing,70,f\n45.155.204.201,proxy,60,f\n"
                                   "103.21.244.17,spam,55,f\n185.220.101.77,scanner,50,f\n")
    made = Store(spark, str(tmp_path_factory.mktemp("store")))
    made.feed, made.paths = str(root / "feed.csv"), paths
    made.result = jobs.ingest_all(made, {**paths, "windows_auth": paths["windows_auth"]}, batch=0, year=2026)
    return made


def test_ingest(store):
    n = sum(map(len, files().values()))
    assert (store.result.lines, store.result.events) == (n - 2, n - 3)
    raw = store.raw_logs().collect()
    assert len({r.raw_id for r in raw}) == n - 2 and sum(r.processed for r in raw) == n - 3
    (reject,) = store.rejects().collect()
    assert reject.raw_message == "garbage" and reject.reason == "unparsed"
    with_lines = jobs.with_raw_lines(store.events(), store.raw_logs()).filter("event_type = 'group_membership_change'").collect()
    assert len(with_lines) == 1 and "EventID=4728" in with_lines[0].raw_message
    recent = store.events(since=datetime(2026, 3, 12))
    assert recent.count() == 2 * 2 * 4 + 1
    assert "event_date" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_running_a_batch_again_replaces_it(store):
    again = jobs.ingest_all(store, store.paths, batch=0, year=2026)
    assert again == store.result and store.events().count() == again.events


def test_an_older_batch_with_more_lines_takes_no_ids_of_later_ones(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"))
    for run, (batch, n) in enumerate([(0, 3), (1, 3), (0, 6), (1, 3)]):
        path = tmp_path / f"fw{run}.log"
        path.write_text("".join(f"line {i}\n" for i in range(n)))
        jobs.ingest_file(made, "firewall", str(path), batch=batch)
    ids = [r.raw_id for r in made.raw_logs().collect()]
    assert len(ids) == len(set(ids)) == 9


def test_unknown_source_and_missing_file(spark, store):
    with pytest.raises(ValueError):
        read_lines(spark, "mainframe", "/nowhere")
    from duskwatch.sources.lines import read_all_lines
    assert read_all_lines(spark, {"firewall": "/no/such/file.log"}).count() == 0


def test_detection_is_complete_and_idempotent(store):
    assert jobs.run_detection(store, feed_path=store.feed) > 0
    by_rule = {}
    for a in store.alerts().collect():
        by_rule.setdefault(a.rule_name, []).append(a)
    assert {r: len(v) for r, v in by_rule.items()} == {
        "brute_force_login": 4, "impossible_travel": 1, "suspicious_ip_threat_intel": 3,
        "privilege_escalation": 2, "unusual_login_hours": 1, "multiple_failed_auth": 1}
    assert [a.username for a in by_rule["unusual_login_hours"]] == ["teodor"]
    assert {(a.src_ip, a.n_events) for a in by_rule["suspicious_ip_threat_intel"]} == {
        ("185.220.101.77", 21), ("45.155.204.201", 1), ("103.21.244.17", 11)}
    assert jobs.run_detection(store, feed_path=store.feed) == 0
    assert store.alerts().count() == 12


def test_feed_upsert_keeps_the_last_row_and_the_first_stamp(spark, store):
    before = {r.ip: r for r in store.intel.read().collect()}
    assert before["185.220.101.77"].category == "scanner" and len(before) == 3
    n = store.upsert_intel(spark.createDataFrame([("185.220.101.77", "tor", 1, "g"), ("9.9.9.9", "new", 2, "g")], INTEL))
    after = {r.ip: r for r in store.intel.read().collect()}
    assert n == 2 and len(after) == 4
    assert (after["185.220.101.77"].category, after["185.220.101.77"].added_at) == ("tor", before["185.220.101.77"].added_at)


def test_every_stored_alert_has_its_events(store):
    counts = {r.alert_id: r["count"] for r in store.alert_events().groupBy("alert_id").count().collect()}
    assert counts == {a.alert_id: a.n_events for a in store.alerts().collect()}
    before = store.evidence().count()
    assert jobs.run_detection(store) == 0 and store.evidence().count() == before


def test_scores_replace(store):
    first = jobs.run_scoring(store, Settings(forest_trees=20))
    jobs.run_scoring(store, Settings(forest_trees=20))
    assert first.count() == store.scores.read().count() == 19
    assert store.scores.versions() == [0, 1]
    (summary,) = dashboard.anomaly_summary(store.scores.read()).collect()
    assert summary.logins_scored == 19 and summary.flagged >= 1


def test_dashboard_and_searches(store):
    alerts = store.alerts()
    (k,) = dashboard.kpis(store.events(), alerts, store.scores.read()).collect()
    assert (k.total_events, k.open_alerts, k.critical_alerts) == (store.result.events, 12, 1)
    trend = dashboard.hourly_trend(alerts).collect()
    assert sum(r.alert_count for r in trend) == 12 and any(r.alert_count == 0 for r in trend)
    assert all(b.hour - a.hour == timedelta(hours=1) for a, b in zip(trend, trend[1:]))
    chart = searches.severity_timechart(alerts).collect()
    assert sum(r.high for r in chart) == 10 and len(chart) == len(trend)
    assert searches.brute_force_buckets(store.events()).first()["count"] == 21
    assert dashboard.filter_alerts(alerts, ["critical"], ["impossible_travel"]).count() == 1
    assert searches.in_range(alerts, "detected_at", datetime(2026, 3, 11, 15, 0)).count() == 7
    assert searches.recent_alerts(alerts, 3).count() == 3


def test_empty_tables(spark, tmp_path):
    empty = Store(spark, str(tmp_path))
    (k,) = dashboard.kpis(empty.events(), empty.alerts(), empty.scores.read()).collect()
    assert tuple(k) == (0, 0, 0, 0.0, 0)
    assert jobs.run_detection(empty) == 0 and dashboard.hourly_trend(empty.alerts()).count() == 0


def test_export(spark, store, tmp_path):
    jobs.export(store, str(tmp_path / "out"))
    events = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/events")).collect()]
    alerts = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/alerts")).collect()]
    assert len(events) == store.result.events and len(alerts) == 12
    fw = next(e for e in events if e["sourcetype"] == "siem:firewall")
    assert fw["index"] == "siem" and fw["event"]["dst_port"] == "8443" and fw["event"]["username"] is None
    assert "event_time" not in fw["event"] and isinstance(fw["time"], float)
    ids = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/alert_evidence")).collect()]
    assert len(ids) == sum(int(a["event"]["n_events"]) for a in alerts) and all(i["sourcetype"] == "siem:alert:evidence" for i in ids)
    travel = next(a for a in alerts if a["event"]["rule_name"] == "impossible_travel")
    assert travel["sourcetype"] == "siem:alert" and travel["event"]["risk_score"] == "90.00"
    assert travel["time"] == datetime.fromisoformat("2026-03-10T11:52:00+00:00").timestamp()
