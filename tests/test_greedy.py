"""Threshold windows against a plain loop, with keys kept whole and keys cut into slices."""

import random
from datetime import datetime, timedelta

import pytest

from duskwatch.operators.greedy import threshold_windows

BASE = datetime(2026, 7, 1)


def loop(rows, k, span):
    """One key: scan in order, keep the events still within the span, start anew after an alert."""
    out, open_ = [], []
    for t, i in sorted(rows):
        open_.append((t, i))
        while t - open_[0][0] > span:
            open_.pop(0)
        if len(open_) >= k:
            out.append([e[1] for e in open_])
            open_ = []
    return out


def make(seed, n, keys, hours, burst):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(keys)}"
        at = rng.random() * hours * 3600
        if rng.random() < burst:
            at = (at // 7200) * 7200 + rng.random() * 300
        rows.append((i * 7919 % 100003, key, BASE + timedelta(seconds=int(at) if seed % 2 else at)))
    return rows


@pytest.mark.parametrize("seed,k,span_s,max_rows", [
    (1, 5, 300, 10_000), (2, 5, 300, 40), (3, 3, 60, 10), (4, 2, 900, 7), (5, 10, 3600, 25),
    (6, 1, 60, 30), (7, 40, 14400, 60), (8, 5, 900, 3)])
def test_matches_a_loop(spark, seed, k, span_s, max_rows):
    rows = make(seed, 900, 9, 48, 0.6)
    df = spark.createDataFrame(rows, "id long, src_ip string, event_time timestamp").repartition(5)
    got = {}
    for r in threshold_windows(df, "src_ip", k, span_s * 1_000_000, max_rows=max_rows).collect():
        ids = [m.id for m in r.members]
        assert ids[-1] == r.id and len(ids) == k
        got.setdefault(r.src_ip, []).append((r.event_time, r.id, ids))
    want_total = 0
    for key in {r[1] for r in rows}:
        want = loop([(t, i) for i, kk, t in rows if kk == key], k, timedelta(seconds=span_s))
        want_total += len(want)
        assert [ids for *_, ids in sorted(got.get(key, []))] == want, key
    assert want_total > 0


def test_all_events_of_a_burst_in_one_second(spark):
    rows = [(i, "hot", BASE + timedelta(seconds=i // 200)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, src_ip string, event_time timestamp")
    got = threshold_windows(df, "src_ip", 5, 300_000_000, max_rows=50).orderBy("event_time", "id").collect()
    assert [[m.id for m in r.members] for r in got] == [list(range(i, i + 5)) for i in range(0, 1000, 5)]


def test_threshold_must_be_positive(spark):
    df = spark.createDataFrame([(1, "a", BASE)], "id long, src_ip string, event_time timestamp")
    with pytest.raises(ValueError):
        threshold_windows(df, "src_ip", 0, 1)


def test_slices_are_bounded_even_when_all_rows_share_a_timestamp(spark):
    from duskwatch.operators.hot_keys import KeySplit, micros
    from pyspark.sql import functions as F
    rows = [(i, "hot", BASE) for i in range(1000)] + [(i, "cold", BASE) for i in range(1000, 1020)]
    df = spark.createDataFrame(rows, "id long, src_ip string, event_time timestamp").withColumn("_at", micros())
    cut = KeySplit(df, "src_ip", 100).apply(df).groupBy("src_ip", "slice", "slice_base", "slice_rows").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("src_ip", "slice").collect()
    assert [r.n for r in cut if r.src_ip == "cold"] == [20]
    hot = [r for r in cut if r.src_ip == "hot"]
    assert all(r.n == r.slice_rows <= 150 for r in hot) and len(hot) >= 7
    assert [r.slice_base for r in hot] == [r.lo for r in hot]
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("shape", ["spread", "few timestamps", "years"])
def test_slices_of_any_shape_are_contiguous(spark, shape, ties, monkeypatch):
    """Slices follow each other in (time, id), none much over the limit, ranks are global."""
    from duskwatch.operators import hot_keys as hk
    from pyspark.sql import functions as F
    rng = random.Random(3)
    at = {"spread": lambda: BASE + timedelta(microseconds=rng.randrange(3_000_000)),
          "few timestamps": lambda: BASE + timedelta(seconds=rng.choice([0, 0, 0, 0, 1, 90])),
          "years": lambda: BASE + timedelta(seconds=rng.randrange(9 * 365 * 86400))}[shape]
    if shape == "years":
        monkeypatch.setattr(hk, "_MAX_TICKS", 20)
    rows = [(rng.randrange(-10**18, 10**18), "hot", at()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "id long, src_ip string, event_time timestamp").withColumn("_at", hk.micros())
    got = hk.KeySplit(df, "src_ip", 200, ties_together=ties).apply(df).groupBy("slice", "slice_base", "slice_rows").agg(
        F.count("*").alias("n"), F.min(F.struct("event_time", "id")).alias("lo"),
        F.max(F.struct("event_time", "id")).alias("hi")).orderBy("slice").collect()
    assert sum(r.n for r in got) == 3000 and all(r.n == r.slice_rows for r in got)
    assert all(tuple(a.hi) < tuple(b.lo) and a.slice_base + a.n == b.slice_base for a, b in zip(got, got[1:]))
    if not (ties and shape == "few timestamps"):
        assert max(r.n for r in got) <= 400 and len(got) >= 8


def test_a_burst_with_ids_in_two_clumps_is_cut(spark):
    """One instant, ids of two input partitions: far apart, dense in themselves."""
    from duskwatch.operators.hot_keys import KeySplit, micros
    from pyspark.sql import functions as F
    rows = [(i + clump * 2**33, "hot", BASE) for clump in (0, 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, src_ip string, event_time timestamp").withColumn("_at", micros())
    sizes = [r["count"] for r in KeySplit(df, "src_ip", 100).apply(df).groupBy("slice").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 200
    got = threshold_windows(df.drop("_at"), "src_ip", 7, 0, max_rows=100).orderBy("id").collect()
    ids = [r[0] for r in rows]
    assert [[m.id for m in r.members] for r in got] == [ids[i:i + 7] for i in range(0, 1995, 7)]


def test_long_sessions_are_folded_in_parts(spark, monkeypatch):
    from duskwatch.operators import greedy
    monkeypatch.setattr(greedy, "_OPEN", 3)
    rows = [(i, "a", BASE + timedelta(seconds=i)) for i in range(500)] + [(i, "b", BASE + timedelta(hours=i)) for i in range(500, 520)]
    df = spark.createDataFrame(rows, "id long, src_ip string, event_time timestamp")
    got = threshold_windows(df, "src_ip", 4, 10_000_000).orderBy("event_time").collect()
    assert [[m.id for m in r.members] for r in got] == [list(range(i, i + 4)) for i in range(0, 500, 4)]


@pytest.mark.parametrize("seed,k,span_s", [(11, 1, 60), (12, 2, 900), (13, 5, 3600), (14, 40, 86400)])
def test_what_is_folded_is_bounded_however_long_a_session(spark, monkeypatch, seed, k, span_s):
    """Blocks of three candidates, groups of three blocks: a fold holds no more, and picks what a loop over the session picks."""
    from duskwatch.operators import greedy
    from duskwatch.operators.hot_keys import KeySplit, micros
    from pyspark.sql import functions as F
    monkeypatch.setattr(greedy, "_OPEN", 3)
    rows = make(seed, 700, 3, 24, 0.3)
    df = spark.createDataFrame(rows, "id long, src_ip string, event_time timestamp").repartition(3)
    whole = KeySplit(df, "src_ip", 10_000).whole(df.withColumn("_at", micros()))
    blocks = greedy.blocks_of(greedy.candidates(whole, "src_ip", k, span_s * 1_000_000, []), "src_ip")
    sizes = blocks.groupBy("src_ip").agg(F.count("*").alias("n"), F.max(F.size("rows")).alias("most")).collect()
    assert max(r.most for r in sizes) <= 3 and max(r.n for r in sizes) > 27  # more blocks than three groups of groups
    got = {}
    for r in threshold_windows(df, "src_ip", k, span_s * 1_000_000).collect():
        got.setdefault(r.src_ip, []).append((r.event_time, r.id, [m.id for m in r.members]))
    for key in {r[1] for r in rows}:
        assert [ids for *_, ids in sorted(got.get(key, []))] == loop([(t, i) for i, kk, t in rows if kk == key], k, timedelta(seconds=span_s)), key
