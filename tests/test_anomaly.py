"""Features against a plain count, and what any isolation forest must satisfy."""

import random
from datetime import datetime, timedelta

import pytest

from duskwatch.operators.features import build_features, ranked_logins
from duskwatch.operators.forest import train_and_score
from duskwatch.operators.hot_keys import micros
from duskwatch.schemas import EVENTS, FEATURE_COLUMNS
from duskwatch.settings import Settings

BASE = datetime(2026, 7, 1, 9)
HOUR, DAY = timedelta(hours=1), timedelta(hours=24)


def frame(spark, rows):
    return spark.createDataFrame([tuple({"severity": "low", **r}.get(f.name) for f in EVENTS) for r in rows], EVENTS)


def login(i, at, user, ip, kind="login_success"):
    return {"id": i, "event_time": at, "username": user, "src_ip": ip, "event_type": kind}


def brute(rows):
    logins = sorted((r for r in rows if r["event_type"] == "login_success" and r["username"]),
                    key=lambda r: (r["event_time"], r["id"]))
    out, seen = {}, set()
    for j, r in enumerate(logins):
        u, t = r["username"], r["event_time"]
        failed = sum(f["event_type"] == "login_failure" and f["username"] == u and t - HOUR < f["event_time"] <= t for f in rows)
        prior = sum(p["username"] == u and t - DAY < p["event_time"] <= t for p in logins[:j])
        new = (u, r["src_ip"]) not in seen
        seen.add((u, r["src_ip"]))
        out[r["id"]] = (t.hour, t.weekday(), int(new), failed, prior, int(t.hour < 6 or t.hour >= 22))
    return out


def random_rows(seed, n):
    rng = random.Random(seed)
    return [login(i, BASE + timedelta(minutes=rng.randrange(4000) * (1 if seed % 2 else 2)), rng.choice(["hot"] * 4 + ["a", "b", None]),
                  rng.choice(["1.1.1.1", "2.2.2.2", "3.3.3.3", None]), rng.choice(["login_success", "login_success", "login_failure", "http_request"]))
            for i in range(n)]


@pytest.mark.parametrize("seed,max_rows", [(1, 10_000), (2, 60), (3, 9)])
def test_features_match_a_plain_count(spark, seed, max_rows):
    rows = random_rows(seed, 600)
    got = {r.id: tuple(r[c] for c in FEATURE_COLUMNS)
           for r in build_features(frame(spark, rows), Settings(max_rows_per_task=max_rows)).collect()}
    assert got == brute(rows) and len(got) > 200


def test_logins_of_one_instant_are_cut(spark):
    """Ten times what a task may hold at one microsecond, ids in two clumps, beside others before and after."""
    rng = random.Random(6)
    rows = random_rows(7, 150)
    for i in range(500):
        rows.append(login((1 << 33) * (i % 2) + 10_000 + i, BASE + DAY, "hot", rng.choice(["1.1.1.1", "9.9.9.9", None]),
                          "login_failure" if i % 5 == 0 else "login_success"))
    features = build_features(frame(spark, rows), Settings(max_rows_per_task=50))
    assert {r.id: tuple(r[c] for c in FEATURE_COLUMNS) for r in features.collect()} == brute(rows)
    logins = frame(spark, rows).filter("event_type = 'login_success' AND username = 'hot'").withColumn("_at", micros())
    ranked = ranked_logins(logins, ["hot"], 50)
    per_task = [r["count"] for r in ranked.groupBy("username", "slice").count().collect()]
    assert len(per_task) >= 8 and max(per_task) <= 100
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, logins.count() + 1))


def test_many_hot_users_are_a_table(spark, monkeypatch):
    """More hot users than a plan may name: they are joined, also where few or none are hot; no plan names them."""
    from duskwatch.operators import hot_keys as hk
    monkeypatch.setattr(hk, "_LISTED", 3)
    rng = random.Random(8)
    rows = [login(i, BASE + timedelta(minutes=rng.randrange(6000)), f"user-{i % 12}" if i < 240 else rng.choice([f"rare-{i}", None]),
                  rng.choice(["1.1.1.1", "2.2.2.2", None]), rng.choice(["login_success", "login_success", "login_failure"])) for i in range(500)]
    events = frame(spark, rows)
    hot = hk.hot_keys(events, "username", 9)
    assert sorted(r["_hot"] for r in hot.collect()) == sorted(f"user-{i}" for i in range(12))
    features = build_features(events, Settings(max_rows_per_task=9))
    assert "user-" not in features._jdf.queryExecution().optimizedPlan().toString()
    assert {r.id: tuple(r[c] for c in FEATURE_COLUMNS) for r in features.collect()} == brute(rows)
    some = hk.hot_keys_of(events, {"any": ("username", "true"), "none": ("username", "src_ip = 'x'")}, 9)
    assert some["none"] == [] and some["any"].count() == 12
    assert hk.without_hot(events, "username", hot).count() + hk.only_hot(events, "username", hot).count() == len(rows)


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.999, 1.0])
def test_weighted_percentile_is_exact(spark, p):
    from duskwatch.operators import forest
    rng = random.Random(9)
    values = [round(rng.gauss(0, 1), 4) * 10 ** rng.choice([0, 0, 0, -12, 6]) for _ in range(3000)] + [-0.25] * 500
    rows = spark.createDataFrame([(v, rng.randint(1, 5)) for v in values], "value double, weight long")
    want = rows.selectExpr(f"percentile(value, {p}D, weight) AS p").first().p
    bins, forest._BINS = forest._BINS, 16  # several passes
    try:
        assert forest.weighted_percentile(rows, p) == want
    finally:
        forest._BINS = bins
    assert forest.weighted_percentile(rows, p) == want and forest.weighted_percentile(rows.limit(0), p) is None


def test_no_logins(spark):
    out = build_features(frame(spark, []))
    assert out.columns == ["id", "username", "event_time", "src_ip", *FEATURE_COLUMNS] and out.count() == 0


def test_scores(spark):
    rows = [login(i, BASE + timedelta(days=i // 16, hours=i % 8), f"user{i % 4}", "10.0.0.5") for i in range(160)]
    odd = datetime(2026, 7, 5, 3)
    rows += [login(1000 + i, odd - timedelta(minutes=i), "user0", "203.0.113.55", "login_failure") for i in range(8)]
    rows += [login(2000, odd, "user0", "203.0.113.55")]
    features = build_features(frame(spark, rows))
    small = Settings(forest_trees=60)
    scored = train_and_score(features, small).orderBy("anomaly_score", ascending=False).collect()
    assert len(scored) == 161 and all(0 <= r.anomaly_score <= 1 for r in scored)
    assert scored[0].id == 2000 and scored[0].is_anomaly
    assert 1 <= sum(r.is_anomaly for r in scored) <= 9  # 5 % of 161, fewer with ties at the cut
    again = train_and_score(features.repartition(13, "src_ip", "id"), small).collect()
    assert {r.id: r.anomaly_score for r in again} == {r.id: r.anomaly_score for r in scored}


def test_samples_of_a_large_table_are_whole_and_come_from_a_bounded_pool(spark):
    from duskwatch.operators.forest import training_rows
    rows = [login(i, BASE + timedelta(minutes=i), f"user{i % 4}", "10.0.0.5") for i in range(2000)]
    few = Settings(forest_trees=10, forest_sample=16)
    got = training_rows(build_features(frame(spark, rows)), 2000, few).collect()
    per_tree = {}
    for r in got:
        per_tree.setdefault(r.tree, set()).add(r.id)
    assert len(got) == 160 and set(map(len, per_tree.values())) == {16}
    assert 100 < len({r.id for r in got}) and len({frozenset(ids) for ids in per_tree.values()}) == 10


def test_too_few_rows(spark):
    out = train_and_score(build_features(frame(spark, [login(1, BASE, "u", "1.1.1.1")]))).collect()
    assert [(r.anomaly_score, r.is_anomaly) for r in out] == [(0.0, False)]


def test_scores_match_a_walk_by_hand(spark):
    """Node table walked row by row, cut-off and scale from all rows, against the weighted vector way."""
    import math
    from duskwatch.operators.forest import grow_forest, training_rows
    features = build_features(frame(spark, random_rows(4, 400)))
    few = Settings(forest_trees=25, forest_sample=32, contamination=0.1)
    rows = features.collect()
    nodes = {}
    for r in grow_forest(training_rows(features, len(rows), few), len(rows), few).collect():
        nodes[r.tree, r.node] = r
    assert len({t for t, _ in nodes}) == 25 and max(r.depth for r in nodes.values()) <= 5
    mean = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    scores = {}
    for r in rows:
        total = 0.0
        for t in range(25):
            at = nodes[t, 0]
            while at.feature >= 0:
                at = nodes[t, at.left if r[FEATURE_COLUMNS[at.feature]] <= at.threshold else at.right]
            total += at.depth + mean(at.size)
        scores[r.id] = 2 ** (-total / 25 / mean(32))
    low, high = min(scores.values()), max(scores.values())
    ranked = sorted(-s for s in scores.values())
    at = 0.1 * (len(ranked) - 1)
    cut = ranked[int(at)] + (at - int(at)) * (ranked[int(at) + 1] - ranked[int(at)])
    got = {r.id: r for r in train_and_score(features, few).collect()}
    assert set(got) == set(scores)
    for i, s in scores.items():
        assert got[i].anomaly_score == pytest.approx((s - low) / (high - low + 1e-9), abs=1e-9)
        if abs(-s - cut) > 1e-12:
            assert got[i].is_anomaly == (-s < cut)
    assert 0 < sum(r.is_anomaly for r in got.values()) <= 0.1 * len(rows) + 1
