"""A stream over many small files gives what the batch operators give on all of them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import detect
from duskwatch.plans import searches
from duskwatch.schemas import EVENTS, INTEL
from duskwatch.settings import Settings
from duskwatch.sources.tables import Store
from duskwatch.streaming import keyed, pipelines
from duskwatch.streaming import late as late_rule

BASE = datetime(2026, 7, 1)
S = Settings(brute_force_threshold=3, brute_force_minutes=30, multi_fail_threshold=4, multi_fail_minutes=90)


def make_events(spark, n=800):
    rng = random.Random(5)
    ips = ["10.0.0.5", "203.0.113.9", "198.51.100.23", "8.8.8.8", None]
    kinds = ["login_failure"] * 3 + ["login_success", "http_auth_failure"]
    rows = [(i, BASE + timedelta(minutes=rng.randrange(3 * 1440)), rng.choice(["windows_auth", "linux_ssh", "web_server"]),
             rng.choice(["ann", "bob", "cy", None]), rng.choice(ips), rng.choice(kinds)) for i in range(n)]
    plain = spark.createDataFrame(rows, "id long, event_time timestamp, source_type string, username string, src_ip string, event_type string")
    return plain.selectExpr(*[f.name if f.name in plain.columns else f"cast(NULL as {f.dataType.simpleString()}) as {f.name}" for f in EVENTS])


@pytest.fixture(scope="module")
def arriving(spark, tmp_path_factory):
    """Events in files of roughly rising time, out of order by up to about half a day."""
    folder = str(tmp_path_factory.mktemp("arriving"))
    df = make_events(spark).cache()
    for hour in range(0, 90, 18):
        part = df.filter(f"floor((unix_seconds(event_time) - {int((BASE - datetime(1970, 1, 1)).total_seconds())}) / 3600 / 18) * 18 "
                         f"+ CASE WHEN id % 5 = 0 THEN 18 ELSE 0 END = {hour}")
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.read.schema(EVENTS).parquet(folder)


def shown(alerts):
    columns = ["alert_id", "rule_name", "src_ip", "username", "title", "description", "event_ids", "detected_at"]
    return sorted(map(str, alerts.select(*columns).collect()))


@pytest.mark.parametrize("make,batch", [
    (keyed.brute_force, detect.detect_brute_force),
    (keyed.multiple_failed_auth, detect.detect_multiple_failed_auth),
    (keyed.impossible_travel, detect.detect_impossible_travel)])
def test_keyed_state_and_repair_equal_batch(spark, tmp_path, make, batch):
    """Parts of time, each with rows of hours and of a day before; the stream stops and starts again after each."""
    events = make_events(spark, 600).repartition(4).cache()
    rule, store = make(S), Store(spark, str(tmp_path / "store"))
    run = keyed.KeyedRun(spark, rule, store.persist_alerts, str(tmp_path / "state"), timedelta(hours=13), timedelta(minutes=30))
    hours = "floor((unix_seconds(event_time) - unix_seconds(timestamp'2026-07-01')) / 3600)"
    arrives = f"floor(({hours} + CASE WHEN id % 5 = 0 THEN 11 WHEN id % 11 = 0 THEN 40 ELSE 0 END) / 30)"
    folder = str(tmp_path / "in")
    for part in range(4):
        rows = events.filter(f"{arrives} = {part}")
        if part == 3:
            beat = spark.createDataFrame([(BASE + timedelta(days=9), keyed.HEARTBEAT)], "event_time timestamp, event_type string")
            rows = rows.unionByName(beat, allowMissingColumns=True)
        rows.coalesce(1).write.mode("append").parquet(folder)
        run.start(pipelines.stream_event_table(spark, folder, maxFilesPerTrigger=1), str(tmp_path / "ck")).awaitTermination()
    late = run.late_events()
    ids = [r.id for r in late.collect()]
    assert len(ids) == len(set(ids)) and 5 < len(ids) < 120
    in_time = events.filter(~events.id.isin(ids))
    assert shown(store.alerts()) == shown(batch(in_time, S)) != shown(batch(events, S))
    done = late_rule.repair(store, rule, late, events, max_rows=50, first_span=timedelta(hours=1))
    assert shown(store.alerts()) == shown(batch(events, S)) and done.added + done.withdrawn > 0
    assert late_rule.repair(store, rule, late, events) == late_rule.Repaired(0, 0)
    # an alert that was withdrawn and is raised again holds again, once
    assert store.change_alerts(store.alerts().limit(1), withdrawn=True) == 1
    assert store.alerts().count() == batch(events, S).count() - 1
    store.persist_alerts(batch(events, S))
    assert shown(store.alerts()) == shown(batch(events, S))


def test_folds_agree_with_batch_rules(spark):
    events = make_events(spark, 400).filter("event_type = 'login_failure' AND src_ip IS NOT NULL").orderBy("event_time", "id").collect()
    rows = [{"at": int((r.event_time - BASE).total_seconds() * 1e6), "id": r.id, "src_ip": r.src_ip} for r in events]
    for k in (1, 2, 3, 6):
        fold = keyed.Threshold(k, 4 * 3600 * 10**6)
        whole, rest = fold([], rows)
        found, open_rows = [], []
        for cut in range(0, len(rows), 7):  # in pieces as in one go
            some, open_rows = fold(open_rows, rows[cut:cut + 7])
            found += some
        assert (found, open_rows) == (whole, rest) and len(open_rows) <= k - 1
        assert all(len(w) == k and w[-1]["at"] - w[0]["at"] <= fold.reach_us for w in whole) and whole
    pairs, last = keyed.Previous(10**12)([], rows)
    assert last == rows[-1:] and all(a["src_ip"] != b["src_ip"] for a, b in pairs)


def test_a_micro_batch_writes_what_it_brings(spark, tmp_path):
    """Thousands of rows wait; a few more cost a few bytes of state."""
    store, folder, checkpoint = Store(spark, str(tmp_path / "store")), str(tmp_path / "in"), tmp_path / "ck"
    run = keyed.KeyedRun(spark, keyed.brute_force(S), store.persist_alerts, str(tmp_path / "state"))

    def arrive(first, n):
        rows = spark.range(first, first + n).selectExpr(
            "id", "timestamp'2026-07-01' + make_dt_interval(0, 0, 0, id % 3000) AS event_time", "'linux_ssh' AS source_type",
            "concat('user', id) AS username", "concat('10.0.0.', id % 4) AS src_ip", "'login_failure' AS event_type")
        before = sum(f.stat().st_size for f in checkpoint.rglob("*") if f.is_file())
        rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS]).write.mode(
            "append").parquet(folder)
        run.start(pipelines.stream_event_table(spark, folder), str(checkpoint)).awaitTermination()
        return sum(f.stat().st_size for f in checkpoint.rglob("*") if f.is_file()) - before

    arrive(0, 10)
    many, few = arrive(10, 20_000), arrive(20_010, 10)
    assert few < many / 4 and store.alerts().count() == 0


def test_late_rows_are_kept_with_their_batch(spark, tmp_path):
    row = lambda i, hour: (i, datetime(2026, 7, 1) + timedelta(hours=hour), "linux_ssh", "eve", "10.0.0.1", "login_success")
    store = Store(spark, str(tmp_path / "store"))
    run = keyed.KeyedRun(spark, keyed.impossible_travel(), store.persist_alerts, str(tmp_path / "state"), timedelta(hours=2))
    folder = str(tmp_path / "in")
    for rows in [[row(1, 0), row(2, 9)], [row(3, 8), row(4, 5), row(5, 10)]]:
        spark.createDataFrame(rows, "id long, event_time timestamp, source_type string, username string, src_ip string, event_type string").write.mode(
            "append").parquet(folder)
        stream = spark.readStream.schema("id long, event_time timestamp, source_type string, username string, src_ip string, event_type string").parquet(folder)
        run.start(stream, str(tmp_path / "ck")).awaitTermination()
    assert [r.id for r in run.late_events().collect()] == [4]
    assert late_rule.repair(store, run.rule, run.late_events().limit(0), run.late_events()) == late_rule.Repaired(0, 0)


def test_counts_and_stateless_rules(spark, arriving, tmp_path):
    folder, all_events = arriving
    def drain(df, name, mode="append"):
        q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
             .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.table(name)
    stream = lambda: pipelines.stream_event_table(spark, folder, maxFilesPerTrigger=2)
    got = drain(pipelines.failure_counts(stream(), 2, "1 hour", "37 hours"), "counts")
    kept = str(tmp_path / "kept")
    pipelines.count_sink(pipelines.failure_counts(stream(), 2, "1 hour", "37 hours"), kept, str(tmp_path / "kept-ck")).awaitTermination()
    want = {tuple(r) for r in searches.brute_force_buckets(all_events, 2, "1 hour").select("src_ip", "bucket", "count").collect()}
    got = {tuple(r) for r in got.collect()}
    assert got and got <= want  # buckets younger than the watermark are still open
    assert {tuple(r) for r in pipelines.latest_counts(spark, kept).collect()} == want
    assert all(w in got for w in want if w[1] < BASE + timedelta(hours=30))
    intel = spark.createDataFrame([("203.0.113.9", "x", 1, "y")], INTEL)
    hits = drain(pipelines.intel_matches(stream(), intel).select("id"), "hits")
    assert sorted(hits.collect()) == sorted(detect.intel_hits(all_events, intel).select("id").collect())
    store = Store(spark, str(tmp_path / "store"))
    for ck in ("a", "b"):  # the second stream repeats every alert
        pipelines.alert_sink(pipelines.off_hours_alerts(stream()), store, str(tmp_path / ck)).awaitTermination()
    assert store.alerts().count() == detect.detect_unusual_login_hours(all_events).count() > 5


def test_lines_stream_and_refresh(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    line = "2026-07-01T03:{:02d}:00Z EventID=4625 Account=root LogonType=3 SourceIP=203.0.113.55 Workstation=W Status=x\n"
    (folder / "a.log").write_text("".join(line.format(i) for i in range(3)) + "junk\n\n")
    store = Store(spark, str(tmp_path / "store"))
    lines = lambda: pipelines.stream_lines(spark, "windows_auth", str(folder))
    refresh = lambda: pipelines.scheduled_refresh(lines(), store, str(tmp_path / "ck"))
    assert refresh() == 0
    (folder / "b.log").write_text("".join(line.format(i) for i in range(3, 5)))
    assert refresh() == 1
    assert store.raw_logs().count() == 6 and store.events().count() == 5 and store.rejects().count() == 1
    assert store.raw_logs().select("raw_id").distinct().count() == 6
    q = (pipelines.stream_events(lines()).writeStream.format("memory").queryName("parsed")
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("parsed").count() == 5


class _Counted:
    """A handle whose state is in memory and counts its calls."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def _state(self, kept):
        outer = self

        class State:
            def __getattr__(self, name):
                outer.calls += 1
                return getattr(kept, name)
        return State()

    def getMapState(self, *_):
        class Map(dict):
            def updateValue(self, key, value):
                self[key] = value

            def getValue(self, key):
                return self.get(key)

            removeKey, keys, exists = dict.pop, lambda self: list(dict.keys(self)), lambda self: bool(self)
        return self._state(Map())

    def getValueState(self, *_):
        class Value:
            held = None
            get, exists = lambda self: self.held, lambda self: self.held is not None

            def update(self, value):
                self.held = value

            def clear(self):
                self.held = None
        return self._state(Value())

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


@pytest.mark.parametrize("n", [12, 700])
def test_a_key_with_few_rows_costs_few_calls_of_its_state(n):
    """Rows of a month, each in an hour of its own; the fold sees all of them, and the state is empty in the end."""
    import pandas as pd
    from types import SimpleNamespace
    hour = 3_600_000
    rng = random.Random(n)
    rows = [{"at": at * hour * 1000, "id": i, "username": "ann", "src_ip": rng.choice(["10.0.0.1", "8.8.8.8"]), "source_type": "linux_ssh",
             "event_type": "login_success"} for i, at in enumerate(rng.sample(range(1000, 1720), n))]
    fold = keyed.Previous(40 * hour * 1000)
    handle, state = _Counted(), keyed.KeyedState(fold, 24 * hour, hour)
    state.init(handle)
    at = lambda clock: SimpleNamespace(getCurrentWatermarkInMs=lambda: clock)
    assert not list(state.handleInputRows(("ann",), iter([pd.DataFrame(rows)]), at(0)))
    got = []
    for clock in (1300 * hour, 1500 * hour, 9000 * hour):
        for due in sorted(t for t in handle.timers if t <= clock):
            handle.timers.discard(due)
            got += [w for out in state.handleExpiredTimer(("ann",), at(clock), None) for w in out["rows"]]
    want = fold([], sorted(rows, key=lambda r: r["at"]))[0]
    assert [[r["id"] for r in keyed.json.loads(w)] for w in got] == [[r["id"] for r in w] for w in want] and want
    assert not handle.timers and state.head.get() is None and not state.waiting.keys()
    assert handle.calls <= 30 if n == 12 else handle.calls <= 4 * n


@pytest.mark.parametrize("fold", [keyed.Previous(40 * 3600 * 10**6), keyed.Threshold(3, 60 * 3600 * 10**6)])
def test_a_cell_of_many_keys_gives_what_its_keys_give(fold):
    """Rows of 500 keys come in any order, some late; the clock moves by hours or days. Calls do not grow with the keys, and nothing stays behind."""
    import pandas as pd
    from types import SimpleNamespace
    hour = 3_600_000
    rng = random.Random(5)
    rows = [{"cell": 1, "key": f"user{rng.randrange(500)}", "at": rng.randrange(200 * hour) * 1000, "id": i, "username": None,
             "src_ip": rng.choice(["10.0.0.1", "8.8.8.8"]), "source_type": "linux_ssh", "event_type": "login_success"} for i in range(6000)]
    rows.sort(key=lambda r: r["at"] + (rng.randrange(20 * hour) if rng.random() < .95 else 90 * hour) * 1000)
    handle, state = _Counted(), keyed.KeyedState(fold, 24 * hour, hour)
    state.init(handle)
    clock, late, got = 0, set(), []
    cuts = [0, 40, 1500, 1600, 1610, 2400, 3000, 5200, 5900, 6000, 6000]
    for first, last in zip(cuts, cuts[1:]):
        at = SimpleNamespace(getCurrentWatermarkInMs=lambda: clock)
        if first < last:
            for out in state.handleInputRows((1,), iter([pd.DataFrame(rows[first:(first + last) // 2]), pd.DataFrame(rows[(first + last) // 2:last])]), at):
                assert set(out["kind"]) == {"late"}
                late |= {r["id"] for some in out["rows"] for r in keyed.json.loads(some)}
        clock = max([clock, *(r["at"] // 1000 for r in rows[first:last])]) if first < last else 9000 * hour
        for due in sorted(t for t in handle.timers if t <= clock):
            handle.timers.discard(due)
            for out in state.handleExpiredTimer((1,), at, None):
                got += [(k, tuple(r["id"] for r in keyed.json.loads(w))) for k, w in zip(out["key"], out["rows"])]
    want = []
    for key in {r["key"] for r in rows}:
        own = sorted((r for r in rows if r["key"] == key and r["id"] not in late), key=lambda r: (r["at"], r["id"]))
        want += [(key, tuple(r["id"] for r in window)) for window in fold([], own)[0]]
    assert sorted(got) == sorted(want) and want and 50 < len(late) < 600
    assert not handle.timers and state.head.get() is None and not state.waiting.keys() and not state.open.keys()
    assert handle.calls < 1000  # three a key and micro-batch were 7,000


def test_the_state_has_no_row_for_each_key(spark, tmp_path, monkeypatch):
    """600 accounts in four cells: a micro-batch calls the state for four."""
    monkeypatch.setattr(keyed, "_CELLS", 4)
    events = spark.range(600).selectExpr(
        "id", "timestamp'2026-07-01' + make_dt_interval(0, 0, 0, id) AS event_time", "'linux_ssh' AS source_type", "concat('user', id) AS username",
        "'10.0.0.1' AS src_ip", "'login_success' AS event_type")
    folder, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "store"))
    events.write.parquet(folder)
    run = keyed.KeyedRun(spark, keyed.impossible_travel(), store.persist_alerts, str(tmp_path / "state"))
    query = run.start(spark.readStream.schema(events.schema).parquet(folder), str(tmp_path / "ck"))
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert 0 < held[0] <= 4 * 8
