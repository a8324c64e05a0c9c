"""Detection on what changed gives what detection on everything gives, and writes only what is new."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import detect
from duskwatch.plans import jobs
from duskwatch.schemas import EVENTS, INTEL
from duskwatch.settings import Settings
from duskwatch.sources.tables import Store
from duskwatch.streaming import keyed, late

S = Settings(brute_force_threshold=3, brute_force_minutes=45, multi_fail_threshold=4, multi_fail_minutes=90)
BASE = datetime(2026, 3, 2)
KINDS = ["login_failure"] * 3 + ["login_success", "http_auth_failure", "privilege_escalation", "conn_allowed"]


def batch_of(spark, number, n, start_hour, hours, ips=("10.0.0.7", "203.0.113.77", "198.51.100.88", "45.155.204.9", None)):
    pick = random.Random(number)
    rows = [(number * 10_000 + k, BASE + timedelta(hours=start_hour, seconds=pick.randrange(hours * 3600)), pick.choice(["windows_auth", "linux_ssh"]),
             pick.choice(["web7", "db3"]), pick.choice(["ines", "omar", "lu", None]), pick.choice(ips), pick.choice(KINDS)) for k in range(n)]
    plain = spark.createDataFrame(rows, "id long, event_time timestamp, source_type string, host string, username string, src_ip string, event_type string")
    return plain.select(*[F.col(f.name) if f.name in plain.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS],
                        F.to_date("event_time").alias("event_date"))


def put(store, events, batch):
    store.write_batch("normalized_events", events, batch, by="event_date", rebalance=True)


def feed(spark, *ips):
    return spark.createDataFrame([(ip, "scanner", 80, "list") for ip in ips], INTEL)


def shown(alerts):
    return sorted(map(str, alerts.drop("detected_date").collect()))


def evidence_files(store):
    folder = f"{store.root}/alert_evidence"
    from pathlib import Path
    return {f: f.stat().st_size for f in Path(folder).rglob("*.parquet")}


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    """One store that detects on changes after each batch, one that runs every rule over everything after each batch."""
    made = [Store(spark, str(tmp_path_factory.mktemp(name))) for name in ("changes", "whole")]
    sizes = []
    for number, (n, start, hours) in enumerate([(400, 0, 60), (60, 60, 10)]):
        for store in made:
            store.upsert_intel(feed(spark, "203.0.113.77"))
            put(store, batch_of(spark, number, n, start, hours), number)
        jobs.detect_changes(made[0], S)
        jobs.run_detection(made[1], S)
        sizes.append(evidence_files(made[0]))
    return made, sizes


def test_changes_agree_with_everything(stores):
    (changes, whole), _ = stores
    got = shown(changes.alerts())
    assert got == shown(whole.alerts()) and len(got) > 60
    assert {r.rule_name for r in changes.alerts().collect()} == set(detect.BUILT_IN)


def test_nothing_new_writes_nothing(stores):
    (changes, whole), sizes = stores
    before = shown(changes.alerts()), changes.evidence().count(), changes.marks().count()
    assert jobs.detect_changes(changes, S) == 0 and jobs.run_detection(changes, S) == 0
    assert (shown(changes.alerts()), changes.evidence().count(), changes.marks().count()) == before


def test_evidence_is_logged_once(stores):
    (changes, _), sizes = stores
    log = changes.evidence()
    assert log.count() == log.select("rule_name", "id").distinct().count()
    assert all(earlier.items() <= later.items() for earlier, later in zip(sizes, sizes[1:]))  # nothing is written again
    rows = [r["count"] for r in log.groupBy("run").count().orderBy("run").collect()]
    assert rows[0] > 4 * rows[1]


def test_every_version_of_a_group_alert_has_its_events(stores):
    for store in stores[0]:
        alerts = {a.alert_id: a for a in store.alerts().collect()}
        ids = {}
        for r in store.alert_events().collect():
            ids.setdefault(r.alert_id, set()).add(r.event_id)
        assert {k: len(v) for k, v in ids.items()} == {k: a.n_events for k, a in alerts.items()}
        versions = [a for a in alerts.values() if a.rule_name == detect.SUSPICIOUS_IP]
        assert len(versions) >= 2  # one address, and it grew
        small, large = sorted(versions, key=lambda a: a.n_events)[:2]
        assert ids[small.alert_id] < ids[large.alert_id]


def test_a_new_address_of_the_feed_reaches_history(spark, stores):
    (changes, whole), _ = stores
    for store in (changes, whole):
        store.upsert_intel(feed(spark, "198.51.100.88"))
    assert jobs.detect_changes(changes, S) == jobs.run_detection(whole, S) == 1
    assert shown(changes.alerts()) == shown(whole.alerts())


def test_rows_out_of_order_withdraw_what_they_undo(spark, tmp_path):
    """A batch that falls between events of earlier ones changes windows already reported."""
    store = Store(spark, str(tmp_path / "store"))
    events = [batch_of(spark, 20, 300, 0, 30), batch_of(spark, 21, 60, 0, 30)]
    for number, part in enumerate(events):
        put(store, part, number)
        jobs.detect_changes(store, S)
    keyed = [detect.BRUTE_FORCE, detect.MULTI_FAIL, detect.TRAVEL]
    want = detect.run_all_rules(events[0].unionByName(events[1]), feed(spark, "9.9.9.9"), S, keyed)
    assert shown(store.alerts().where(F.col("rule_name").isin(keyed))) == shown(want)
    assert store._withdrawn().count() > 0


def test_own_rules_run_with_the_others(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    put(store, batch_of(spark, 30, 40, 0, 5), 0)
    before = dict(detect.RULES)
    try:
        detect.register_rule(detect.OFF_HOURS, lambda events, intel, s: detect.detect_privilege_escalation(events, s))
        jobs.detect_changes(store, S)
        assert detect.OFF_HOURS not in {r.rule_name for r in store.alerts().collect()}
    finally:
        detect.RULES.clear()
        detect.RULES.update(before)


def test_sessions_are_those_of_a_loop_over_all_rows(spark):
    pick, reach = random.Random(5), 1000
    rows, low = [], -3_000_000
    for key in ("a", "b", "c"):
        at = low
        for _ in range(150):
            at += pick.choice([0, 1, 7, 400, 999, 1000, 1001, 5000])
            rows.append((key, at))
    touched = [(key, at) for key, at in rows if pick.random() < 0.05] + [("a", low - 1), ("d", 0), (None, 5)]
    want = set()
    for key in ("a", "b", "c"):
        sessions = []
        for at in sorted(a for k, a in rows if k == key):
            if not sessions or at - sessions[-1][-1] > reach:
                sessions.append([])
            sessions[-1].append(at)
        for own, behind in zip(sessions, [*sessions[1:], [None]]):
            if any(k == key and a in own for k, a in touched):
                want.add((key, own[0], behind[0], own[-1]))
    timed = lambda rows: spark.createDataFrame(rows, "key string, at long").selectExpr("*", "timestamp_micros(at) AS event_time")
    parts = late.stretches(timed(rows).repartition(4), "key", reach)
    got = late.touched_sessions(parts, timed(touched), "key", reach)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 10
    assert got.count() == len(want) and parts.count() < len(rows)


@pytest.mark.parametrize("few", [200_000, 0])
def test_a_repair_that_reads_further_reads_each_row_once_and_writes_it_once(spark, tmp_path, monkeypatch, few):
    """A session many times as long as what is read at first, and a day long before the late row."""
    rows = [(k, BASE + timedelta(minutes=10 * k), "lu", "10.0.0.7", "linux_ssh", "login_failure") for k in range(400)]
    rows += [(1000 + k, BASE - timedelta(days=9, minutes=k), "lu", "10.0.0.7", "linux_ssh", "login_failure") for k in range(5)]
    rows += [(2000 + k, BASE + timedelta(hours=k), "omar", "10.0.0.8", "linux_ssh", "login_failure") for k in range(60)]
    events = spark.createDataFrame(rows, "id long, event_time timestamp, username string, src_ip string, source_type string, event_type string")
    written, whole = [], late.materialize
    monkeypatch.setattr(late, "_FEW", few, raising=False)
    monkeypatch.setattr(late, "materialize", lambda df, label, by=None: written.append((label, whole(df, label, by))) or written[-1][1])
    rule, store = keyed.brute_force(S), Store(spark, str(tmp_path / "store"))
    new = events.where("id = 200").select(F.col("src_ip").alias("key"), "event_time")
    done = late.repair(store, rule, new, events, first_span=timedelta(hours=1))
    want = detect.detect_brute_force(events.where("id < 1000"), S)
    assert shown(store.alerts()) == shown(want) and done == late.Repaired(0, want.count()) and done.added > 100
    by_row = [df for _, df in written if "id" in df.columns]
    assert sum(df.count() for df in by_row) == 400  # no row is written twice, nor one of another session or key
    steps = [df for label, df in written if label == "stretches"]
    assert len(steps) > 3 and max(df.count() for df in steps) < 100
