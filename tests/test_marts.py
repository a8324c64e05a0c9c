"""Marts give what the panels give on the stored tables, and ids stay with their batch."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from duskwatch.plans import dashboard, jobs, marts, searches
from duskwatch.settings import Settings
from duskwatch.sources.lines import read_lines
from duskwatch.sources.tables import Store

START = datetime(2026, 5, 4, 8)
S = Settings(brute_force_threshold=3, brute_force_minutes=60, multi_fail_threshold=4, multi_fail_minutes=600)


def lines(day, n):
    """Of one day: failures of a few accounts from a few addresses, a success now and then, a line that is none."""
    at = lambda i: START + timedelta(days=day, minutes=7 * i)
    return [f"{at(i):%Y-%m-%dT%H:%M:%SZ} EventID={4624 if i % 6 == 0 else 4625} Account=acct{i % 4} LogonType=3 "
            f"SourceIP=10.9.{day}.{i % 3} Workstation=W Status=x" for i in range(n)] + ["not a line"]


def shown(df):
    return sorted(map(str, df.collect()))


def agree(store):
    events, alerts, scores = store.events(), store.alerts(), store.scores.read()
    want = dashboard.kpis(events, alerts, scores).first().asDict()
    got = marts.kpis(store).first().asDict()
    assert got.pop("avg_risk") == pytest.approx(want.pop("avg_risk")) and got == want
    assert shown(marts.hourly_trend(store)) == shown(dashboard.hourly_trend(alerts))
    assert shown(marts.top_ips(store)) == shown(dashboard.top_ips(alerts))
    risk = lambda df: sorted((r["username"], float(r["risk_score"])) for r in df.collect())
    assert risk(marts.risk_by_user(store)) == risk(dashboard.risk_by_user(alerts))
    for column in ("severity", "rule_name"):
        assert shown(marts.count_by(store, column)) == shown(dashboard.count_by(alerts, column))
    assert shown(marts.login_heatmap(store)) == shown(dashboard.login_heatmap(events))
    assert shown(marts.top_attackers(store)) == shown(searches.top_attackers(events))
    return got


def test_marts_follow_the_stored_tables(spark, tmp_path):
    store, files = Store(spark, str(tmp_path / "store")), tmp_path / "logs"
    files.mkdir()
    marts.refresh(store)
    assert agree(store)["total_events"] == 0  # empty tables
    for day, n in enumerate((60, 90)):
        (files / f"{day}.log").write_text("\n".join(lines(day, n)))
        jobs.ingest(store, read_lines(spark, "windows_auth", str(files / f"{day}.log")), batch=day)
        jobs.run_detection(store, S)
        marts.refresh(store)
        agree(store)
    assert agree(store)["total_events"] == 150 and store.alerts().count() > 10
    # a day whose alerts are all withdrawn, then raised again
    first = store.alerts().where(F.col("detected_date") == F.lit(START.date()))
    assert store.change_alerts(first.select("alert_id"), withdrawn=True) > 0
    marts.refresh(store)
    gone = agree(store)["open_alerts"]
    jobs.run_detection(store, S)
    marts.refresh(store)
    assert agree(store)["open_alerts"] > gone
    # a batch whose mart went missing, as when its ingest died, is summed up by the next refresh
    marts.drop_event_mart(store, 0)
    assert marts.kpis(store).first()["total_events"] == 90
    marts.refresh(store)
    agree(store)


def test_a_batch_that_is_run_again_keeps_its_ids(spark, tmp_path):
    store, files = Store(spark, str(tmp_path / "store")), tmp_path / "logs"
    files.mkdir()

    def ingest(batch, n):
        (files / f"{batch}.log").write_text("\n".join(lines(batch, n)))
        return jobs.ingest(store, read_lines(spark, "windows_auth", str(files / f"{batch}.log")), batch=batch)

    ids = lambda batch: {r["raw_message"]: r["raw_id"] for r in store.raw_logs().where(F.col("ingest_batch") == batch).collect()}
    for batch, n in enumerate((40, 30, 20)):
        ingest(batch, n)
    before = [ids(b) for b in range(3)]
    assert sorted(i for own in before for i in own.values()) == list(range(40 + 30 + 20 + 3))
    assert jobs.run_detection(store, S) > 0
    ingest(0, 40)
    assert [ids(b) for b in range(3)] == before and jobs.run_detection(store, S) == 0
    ingest(1, 12)  # fewer lines stay inside the range
    assert max(ids(1).values()) <= max(before[1].values())
    ingest(0, 70)  # more get a range of their own
    assert min(ids(0).values()) == 93 and ids(2) == before[2]
    assert ingest(3, 0).events == 0 and len(ids(3)) == 1
    every = [i for b in range(4) for i in ids(b).values()]
    assert len(every) == len(set(every))
