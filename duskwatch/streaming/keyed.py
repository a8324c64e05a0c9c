"""Stateful rules as keyed state: the addresses or accounts of a cell share one state, moved on by event-time timers.

A key's cell is a hash of it. A row waits in the cell's state, in the part of the event-time bucket it belongs to, until the bucket
closes: when an event of the rule came that is ``lateness`` newer than the bucket's end. A timer then puts the bucket's rows, in order of
(time, id), through the rule's fold key by key, whose own state of a key is small: the at most k-1 failures since the last alert, or the
last login. So a micro-batch writes what it brought and what its timers touched, whatever else is waiting. A row of a bucket that has
closed is late: it comes out beside the alerts and is kept for ``late.repair``. Alerts are exactly the batch rule's on the rows that were not late.

The clock is the newest event of earlier micro-batches (Spark's watermark). So that Spark hands late rows to the state instead of
dropping them, it runs on a column that lies ``_FAR`` ahead of the event time and is allowed to lag as much; only rows older than that are dropped.
Events of type ``heartbeat`` move the clock and nothing else. State lives in RocksDB under the stream's checkpoint.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from duskwatch.functions.net import EARTH_RADIUS_KM
from duskwatch.operators import detect, geo
from duskwatch.session import materialize, release
from duskwatch.settings import Settings

HEARTBEAT = "heartbeat"
_FAR = 36_500  # days
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
FIELDS = ("at", "id", "username", "src_ip", "source_type", "event_type")  # of a row in state
_MEMBER = "struct<at:bigint,id:bigint,username:string,src_ip:string,source_type:string,event_type:string>"
_OUT = "kind string, key string, rows string"
Row = dict


# ---------------------------------------------------------------- folds

@dataclass(frozen=True)
class Threshold:
    """k events within ``reach_us``, counting anew after each alert."""

    k: int
    reach_us: int

    def __call__(self, open_rows: list[Row], rows: list[Row]) -> tuple[list[list[Row]], list[Row]]:
        """(windows found, rows still open)."""
        found = []
        for row in rows:
            open_rows = [*open_rows[-(self.k - 1):], row] if self.k > 1 else [row]
            if len(open_rows) == self.k and row["at"] - open_rows[0]["at"] <= self.reach_us:
                found.append(open_rows)
                open_rows = []
        return found, open_rows[-(self.k - 1):] if self.k > 1 else []


@dataclass(frozen=True)
class Previous:
    """Every row with the one before it, if that lies within ``reach_us`` and came from another address."""

    reach_us: int

    def __call__(self, open_rows: list[Row], rows: list[Row]) -> tuple[list[list[Row]], list[Row]]:
        every = open_rows + rows
        found = [[a, b] for a, b in zip(every, every[1:]) if b["at"] - a["at"] <= self.reach_us and a["src_ip"] != b["src_ip"]]
        return found, every[-1:]


# ---------------------------------------------------------------- rules

@dataclass(frozen=True)
class Rule:
    """A keyed rule: its batch form, and the fold and projection that give the same on a stream.

    No alert rests on two neighbouring rows of a key that lie more than ``fold.reach_us`` apart.
    """

    name: str
    key: str
    relevant: str
    fold: Threshold | Previous
    alerts: Callable[[DataFrame], DataFrame]
    detect: Callable[[DataFrame], DataFrame]


def _parsed(out: DataFrame) -> DataFrame:
    """What the state gave out: (kind, key, event_time and id of the last member, members)."""
    members = F.transform(F.from_json("rows", f"array<{_MEMBER}>"), lambda r: F.struct(
        r["id"].alias("id"), F.timestamp_micros(r["at"]).alias("event_time"), r["username"].alias("username"), r["src_ip"].alias("src_ip"),
        r["source_type"].alias("source_type"), r["event_type"].alias("event_type")))
    return out.select("kind", "key", members.alias("members"))


def _found(parsed: DataFrame, key: str) -> DataFrame:
    last = F.element_at("members", -1)
    return parsed.select(F.col("key").alias(key), last["event_time"].alias("event_time"), last["id"].alias("id"), "members")


def brute_force(settings: Settings = Settings()) -> Rule:
    key, relevant = detect.KEYED_RULES[detect.BRUTE_FORCE]
    return Rule(detect.BRUTE_FORCE, key, relevant, Threshold(settings.brute_force_threshold, settings.brute_force_minutes * detect.MINUTE_US),
                lambda found: detect.brute_force_alerts(_found(found, key), settings), lambda df: detect.detect_brute_force(df, settings))


def multiple_failed_auth(settings: Settings = Settings()) -> Rule:
    key, relevant = detect.KEYED_RULES[detect.MULTI_FAIL]
    return Rule(detect.MULTI_FAIL, key, relevant, Threshold(settings.multi_fail_threshold, settings.multi_fail_minutes * detect.MINUTE_US),
                lambda found: detect.multiple_failed_auth_alerts(_found(found, key), settings),
                lambda df: detect.detect_multiple_failed_auth(df, settings))


def impossible_travel(settings: Settings = Settings(), ranges: DataFrame | None = None) -> Rule:
    """No two logins further apart than the limit speed needs for half the globe can alert. ``ranges`` is a geo feed."""
    key, relevant = detect.KEYED_RULES[detect.TRAVEL]
    reach = timedelta(hours=math.pi * EARTH_RADIUS_KM / settings.max_travel_kmh + 1 / 60)

    def alerts(found: DataFrame) -> DataFrame:
        located = lambda df: geo.locate(df) if ranges is None else geo.locate_all(
            df, ranges, max_broadcast_rows=settings.max_broadcast_rows)
        pairs = _found(found, key).withColumn("before", F.col("members")[0])
        pairs = located(pairs.withColumn("src_ip", F.col("before.src_ip"))).withColumnRenamed("geo", "geo_before")
        # written, so that what follows reads two places and does not work each out at every mention
        pairs = materialize(located(pairs.withColumn("src_ip", F.col("members")[1]["src_ip"])), "located-pairs")
        previous = F.struct("before.id", "before.event_time", "before.src_ip", F.col("geo_before").alias("geo"))
        return detect.travel_alerts(detect.measured(pairs.withColumn("previous", previous)), settings)

    return Rule(detect.TRAVEL, key, relevant, Previous(int(reach.total_seconds() * 1e6)), alerts,
                lambda df: detect.detect_impossible_travel(df, settings, ranges))


# ---------------------------------------------------------------- the state

_CELLS = 4096  # of keys; a checkpoint's state lies in these cells, so another number needs a new checkpoint
_HELD = 64  # waiting rows a head holds itself, rows of an entry of ``waiting`` with sparse buckets, keys of a slot of ``open``
_GIVEN = 1000  # windows given out at a time


class _Open:
    """The fold's open rows of a cell's keys during one call: a slot that is needed is read once and written once."""

    def __init__(self, state, head: dict):
        self.state, self.head, self.slots, self.before = state, head, {}, {}

    def _slot(self, at: int) -> dict[str, list[Row]]:
        if at not in self.slots:
            held = self.state.getValue((at,)) if self.head["keys"] else None
            self.slots[at] = json.loads(held[0]) if held else {}
            self.before[at] = len(self.slots[at])
        return self.slots[at]

    def _at(self, key: str) -> int:
        return zlib.crc32(key.encode()) % self.head["slots"]

    def slot_of(self, key: str) -> dict[str, list[Row]]:
        return self._slot(self._at(key))

    def write(self, forgets: Callable[[list[Row]], int], clock: int) -> None:
        """Keep what may not be forgotten yet, in more slots once there are many keys."""
        head = self.head
        kept = {at: {key: rows for key, rows in slot.items() if rows and forgets(rows) > clock} for at, slot in self.slots.items()}
        head["keys"] += sum(len(slot) - self.before[at] for at, slot in kept.items())
        head["until"] = max([head["until"], *(forgets(rows) for slot in kept.values() for rows in slot.values())])
        if head["keys"] > _HELD * head["slots"]:
            every = {at: kept[at] if at in kept else self._slot(at) for at in range(head["slots"])}
            head["slots"] = 1 << (head["keys"] // _HELD).bit_length()
            kept = {at: {} for at in every}
            for key, rows in (item for slot in every.values() for item in slot.items()):
                kept.setdefault(self._at(key), {})[key] = rows
        for at, slot in kept.items():
            if slot:
                self.state.updateValue((at,), (json.dumps(slot),))
            elif self.before.get(at):
                self.state.removeKey((at,))


class KeyedState(StatefulProcessor):
    """Rows of the keys of one cell. A call of the state, and of this class, costs far more than a row, so a cell costs few, whatever its keys.

    ``head`` holds the waiting rows while they are few, and the one timer that is set. Many waiting rows go to ``waiting`` by (bucket, part):
    whole buckets, sparse ones together under the first of them. ``open`` holds the fold's open rows by key, in as many slots as
    its keys need, so what a closing bucket writes does not grow with the cell. Rows without a ``key`` are of one key, the cell's.
    """

    def __init__(self, fold, lateness_ms: int, bucket_ms: int):
        self.fold, self.lateness_ms, self.bucket_ms = fold, lateness_ms, bucket_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket bigint, part bigint", "rows string")
        self.open = handle.getMapState("open", "slot bigint", "rows string")
        self.head = handle.getValueState("head", "head string")

    def _closes(self, bucket: int) -> int:
        """The clock (ms) at which a bucket closes."""
        return (bucket + 1) * self.bucket_ms + self.lateness_ms

    def _forgets(self, open_rows: list[Row]) -> int:
        """The clock (ms) from which no row that is yet to come can reach the open ones."""
        return (open_rows[-1]["at"] + self.fold.reach_us) // 1000 + self.lateness_ms + self.bucket_ms + 1

    def _buckets(self, rows: list[Row]) -> dict[int, list[Row]]:
        out: dict[int, list[Row]] = {}
        for row in rows:
            out.setdefault(row["at"] // (self.bucket_ms * 1000), []).append(row)
        return out

    def _read(self) -> dict:
        """Waiting ``rows``; how many entries of ``waiting`` were ever ``put`` and how many are ``left``; how many ``keys`` lie in the ``slots`` of
        ``open``, and when all may be forgotten (``until``, ms); the ``timer`` (ms)."""
        held = self.head.get()
        return json.loads(held[0]) if held else {"rows": [], "put": 0, "left": 0, "keys": 0, "slots": 1, "until": 0, "timer": None}

    def _set_timer(self, head: dict, at: int) -> None:
        if head["timer"] is None or at < head["timer"]:
            self.handle.registerTimer(at)
            head["timer"] = at

    def _put_away(self, head: dict) -> None:
        """Waiting rows of the head to ``waiting`` once they are many. An entry of several buckets has at most ``_HELD`` rows."""
        if len(head["rows"]) <= _HELD:
            return
        entries: list[tuple[int, list[Row]]] = []
        for bucket, some in sorted(self._buckets(head["rows"]).items()):
            if entries and len(entries[-1][1]) + len(some) <= _HELD:
                entries[-1][1].extend(some)
            else:
                entries.append((bucket, some))
        for first, some in entries:
            self.waiting.updateValue((first, head["put"]), (json.dumps(some),))
            head["put"] += 1
            head["left"] += 1
        head["rows"] = []

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock = timerValues.getCurrentWatermarkInMs()
        head = self._read()
        came = False
        for frame in rows:
            names = ("key", *FIELDS)
            frame = frame if "key" in frame else frame.assign(key=key[0])
            own = [{n: None if v is None or v != v else v for n, v in zip(names, values)} for values in zip(*(frame[n].tolist() for n in names))]
            late = []
            for bucket, some in self._buckets([row for row in own if row["event_type"] != HEARTBEAT]).items():
                if self._closes(bucket) <= clock:
                    late += some
                    continue
                came = True
                head["rows"] += some
                self._set_timer(head, self._closes(bucket))
            if late:
                yield pd.DataFrame({"kind": "late", "key": [row["key"] for row in late], "rows": [json.dumps([row]) for row in late]})
            self._put_away(head)
        if came:
            self.head.update((json.dumps(head),))

    def _folded(self, opened: _Open, rows: list[Row]) -> list[tuple[str, str]]:
        """(key, window) of what is found in closed rows that all lie behind those folded before."""
        by_key: dict[str, list[Row]] = {}
        for row in sorted(rows, key=lambda r: (r["at"], r["id"])):
            by_key.setdefault(row["key"], []).append(row)
        out = []
        for key, some in by_key.items():
            slot = opened.slot_of(key)
            found, slot[key] = self.fold(slot.get(key, []), some)
            out += [(key, json.dumps(window)) for window in found]
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        clock = timerValues.getCurrentWatermarkInMs()
        head = self._read()
        if head["timer"] is None or head["timer"] > clock:  # an earlier one did what was due
            return
        places = sorted((int(p[0]), int(p[1])) for p in self.waiting.keys()) if head["left"] else []
        opened, windows = _Open(self.open, head), []
        ready, held = {}, []  # closed rows by bucket, rows that go on waiting

        def sort_in(rows: list[Row]) -> None:
            for bucket, some in self._buckets(rows).items():
                if self._closes(bucket) <= clock:
                    ready.setdefault(bucket, []).extend(some)
                else:
                    held.extend(some)

        def fold_before(bucket: float) -> None:
            done = [b for b in ready if b < bucket]
            windows.extend(self._folded(opened, [row for b in done for row in ready.pop(b)]))

        def given() -> pd.DataFrame:
            out = pd.DataFrame({"kind": "found", "key": [name for name, _ in windows], "rows": [window for _, window in windows]})
            windows.clear()
            return out

        sort_in(head["rows"])
        for place in places:
            if self._closes(place[0]) > clock:
                break
            fold_before(place[0])  # entries that follow have no row before this bucket
            if len(windows) >= _GIVEN:
                yield given()
            sort_in(json.loads(self.waiting.getValue(place)[0]))
            self.waiting.removeKey(place)
            head["left"] -= 1
        fold_before(math.inf)
        if windows:
            yield given()
        opened.write(self._forgets, clock)
        ahead = [*self._buckets(held), *[bucket for bucket, _ in places if self._closes(bucket) > clock]]
        head["rows"], head["timer"] = held, None
        self._put_away(head)
        if ahead:
            self._set_timer(head, self._closes(min(ahead)))
        elif head["keys"] and head["until"] > clock:
            self._set_timer(head, head["until"])
        else:
            if head["keys"]:
                self.open.clear()
            self.head.clear()
            return
        self.head.update((json.dumps(head),))

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- the stream

def found_and_late(events: DataFrame, rule: Rule, lateness: timedelta, bucket: timedelta) -> DataFrame:
    """A stream of (kind, key, rows): what the fold finds, and late rows."""
    relevant = f"(({rule.relevant}) OR event_type = '{HEARTBEAT}')"
    ms = lambda span: int(span.total_seconds() * 1000)
    rows = (events.filter(relevant)
            .select(F.coalesce(rule.key, F.lit("")).alias("key"), F.unix_micros("event_time").alias("at"),
                    F.coalesce("id", F.lit(-1)).alias("id"), *FIELDS[2:],
                    (F.col("event_time") + F.expr(f"interval {_FAR} days")).alias("clock"))
            .withWatermark("clock", f"{_FAR} days"))
    cells = rows.withColumn("cell", F.pmod(F.xxhash64("key"), F.lit(_CELLS)))
    return cells.groupBy("cell").transformWithStateInPandas(KeyedState(rule.fold, ms(lateness), ms(bucket)), _OUT, "Append", "EventTime")


LATE = T.StructType([T.StructField(n, t) for n, t in [
    ("rule_name", T.StringType()), ("key", T.StringType()), ("id", T.LongType()), ("event_time", T.TimestampType()), ("username", T.StringType()),
    ("src_ip", T.StringType()), ("source_type", T.StringType()), ("event_type", T.StringType()), ("batch", T.LongType())]])


class KeyedRun:
    """Runs one ``Rule`` over a stream of events into ``sink``; late rows are kept under ``folder``.

    A replayed micro-batch starts from the same state; its late rows take their own folder's place and the sink drops alerts it has.
    """

    def __init__(self, spark: SparkSession, rule: Rule, sink: Callable[[DataFrame], object], folder: str,
                 lateness: timedelta = timedelta(hours=24), bucket: timedelta = timedelta(hours=1)):
        self.spark, self.rule, self.sink, self.lateness, self.bucket = spark, rule, sink, lateness, bucket
        self.folder = folder.rstrip("/")

    def _store(self, df: DataFrame, batch: int) -> None:
        staged = materialize(_parsed(df), "keyed")  # the state moves on once, however many readers there are
        kinds = {r["kind"] for r in staged.select("kind").distinct().collect()}
        if "late" in kinds:
            (staged.where("kind = 'late'").select(F.lit(self.rule.name).alias("rule_name"), "key", F.col("members")[0].alias("r")).select("rule_name", "key", "r.*")
             .write.mode("overwrite").parquet(f"{self.folder}/late/batch={batch}"))
        if "found" in kinds:
            self.sink(self.rule.alerts(staged.where("kind = 'found'")))
        release(staged)

    def start(self, events: DataFrame, checkpoint: str, trigger: dict | None = None):
        for name, value in _CONF.items():
            self.spark.conf.set(name, value)
        self.spark.createDataFrame([], T.StructType(LATE.fields[:-1])).write.mode("ignore").parquet(f"{self.folder}/late/batch=-1")
        return (found_and_late(events, self.rule, self.lateness, self.bucket).writeStream.foreachBatch(self._store)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())

    def late_events(self) -> DataFrame:
        """Relevant rows that came after their bucket had closed, with the micro-batch they came in."""
        return self.spark.read.schema(LATE).parquet(f"{self.folder}/late")
