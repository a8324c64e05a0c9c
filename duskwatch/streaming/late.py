"""Repair after late data: what a late row touches is worked out anew, nothing else.

A keyed rule never alerts across a pause of more than its reach between two neighbouring events of a key, so a late row can change alerts
only within its *session*: the events around it up to the next such pause on either side. Of the keys that had late rows, the
sessions that hold one are found, the batch rule runs on their events, and the result is held against the
stored alerts of those sessions: what no longer holds is withdrawn, what is new is stored. Both are idempotent, so a repair that died is run again.

Sessions are found from each key's first and last row per stretch of time, read from ``first_span`` around the late rows on. If a session touches
the edge of what was read it may be longer, and what lies up to twice as far is read as well, until no session does. Then their events are read, once.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.operators.alerts import ALERT_COLUMNS, not_stored
from duskwatch.operators.hot_keys import micros
from duskwatch.session import materialize
from duskwatch.sources.tables import Store
from duskwatch.streaming.keyed import FIELDS, Rule

_FEW = 200_000  # late stretches whose keys are broadcast


@dataclass(frozen=True)
class Repaired:
    withdrawn: int
    added: int


def stretches(rows: DataFrame, key: str, reach_us: int) -> DataFrame:
    """(key, bucket, low, high) in microseconds: a key's first and last row in each bucket of time that has one.

    A bucket is no wider than ``reach_us``, so no session ends inside one and these tell all sessions. Summed map-side, however many rows a key has.
    """
    at = micros()
    return (rows.groupBy(key, (at - F.pmod(at, F.lit(max(int(reach_us), 1)))).alias("bucket"))
            .agg(F.min(at).alias("low"), F.max(at).alias("high")))


def touched_sessions(parts: DataFrame, late: DataFrame, key: str, reach_us: int) -> DataFrame:
    """(key, start, end, last) in microseconds of the sessions that hold a row of ``late`` (key, at); ``end`` belongs to the next one, if any.

    A session starts at a row more than ``reach_us`` behind its predecessor; ``last`` is its last row. What is ordered whole per key
    are its ``stretches`` (``parts``) and late rows.
    """
    order, of_key = Window.partitionBy(key).orderBy("low"), Window.partitionBy(key)
    before = parts.withColumn("_before", F.lag("high").over(order)).withColumn("_top", F.max("high").over(of_key))
    starts = before.where(F.col("_before").isNull() | (F.col("low") - F.col("_before") > reach_us)).select(
        key, F.col("low").alias("at"), F.lit(True).alias("starts"), "_before", "_top")
    both = starts.unionByName(late.select(key, "at", F.lit(False).alias("starts")).distinct(), allowMissingColumns=True)
    # at one instant a start comes before the late row that is it
    line = Window.partitionBy(key).orderBy("at", F.col("starts").desc())
    so_far, after = line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(1, Window.unboundedFollowing)
    start, newest = F.when(F.col("starts"), F.col("at")), lambda c: F.last(c, ignorenulls=True).over(so_far)
    placed = (both.withColumn("start", newest(start)).withColumn("end", F.first(start, ignorenulls=True).over(after))
              .withColumn("last", F.coalesce(F.first("_before", ignorenulls=True).over(after), newest("_top"))))
    return placed.where("NOT starts AND start IS NOT NULL").select(key, "start", "end", "last").distinct()


def inside(df: DataFrame, sessions: DataFrame, key: str, time: str) -> DataFrame:
    """Rows of ``df`` in one of the sessions; those of a key do not overlap."""
    at, s = F.unix_micros(F.col(time)), sessions.select(F.col(key).alias("_key"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    return df.join(s, (df[key] == F.col("_key")) & (at >= F.col("_start")) & (F.col("_end").isNull() | (at < F.col("_end"))), "left_semi")


def touched_rows(events: DataFrame, late: DataFrame, rule: Rule, first_span: timedelta) -> tuple[DataFrame, DataFrame] | None:
    """(sessions with late rows, all their events in the columns a keyed rule reads), read no further than they reach."""
    key, reach = rule.key, rule.fold.reach_us
    # what all late rows of a stretch touch, its first and its last one touch
    late = materialize(stretches(late.select(F.col("key").alias(key), "event_time"), key, reach).select(
        key, F.explode(F.array_distinct(F.array("low", "high"))).alias("at")), "late")
    bounds = late.agg(F.min("at"), F.max("at"), F.count("*")).first()
    if bounds[0] is None:
        return None
    keys, few = late.select(key).distinct(), bounds[2] <= _FEW
    relevant, time = events.filter(rule.relevant), F.col("event_time")
    at = lambda us: F.timestamp_micros(F.lit(us))
    parts = table = None
    span = max(int(first_span.total_seconds() * 1e6), reach)
    while True:
        low, high = bounds[0] - span, bounds[1] + span
        more = relevant.filter(time.between(at(low), at(high)))
        if parts is not None:  # only what was not read before
            more = more.filter((time < at(known[0])) | (time > at(known[1])))
        if few:
            read = stretches(more.join(F.broadcast(keys), key, "left_semi"), key, reach)
        else:  # rows are summed before they meet the keys, so no key's rows meet in one task
            read = stretches(more, key, reach).join(keys, key, "left_semi")
        if parts is not None:
            read = parts.unionByName(read).groupBy(key, "bucket").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        parts, known = materialize(read, "stretches"), (low, high)
        # what lies beyond the rows that were read belongs to no session of theirs, also where no next one was read
        sessions = materialize(touched_sessions(parts, late, key, reach).withColumn(
            "end", F.coalesce("end", F.lit(high + 1))), "sessions")
        edge = sessions.agg(F.min("start"), F.max("last")).first()
        if edge[0] is not None and (edge[0] - reach < low or edge[1] + reach > high):
            table = table or relevant.agg(F.min(micros()), F.max(micros())).first()
            if (edge[0] - reach < low and low > table[0]) or (edge[1] + reach > high and high < table[1]):
                span *= 2
                continue
        # the rule gives the same on the columns that a stream keeps of a row
        own = relevant.filter(time.between(*map(at, edge[:2] if edge[0] is not None else known))).select(
            *[c for c in events.columns if c in (*FIELDS, "event_time")])
        return sessions, materialize(inside(own, sessions, key, "event_time"), "touched-rows")


def repair(store: Store, rule: Rule, late: DataFrame, events: DataFrame | None = None, max_rows: int = 5_000_000,
           first_span: timedelta = timedelta(days=3)) -> Repaired:
    """Bring the stored alerts of ``rule`` to what the batch rule gives, given its ``late`` rows (key, event_time), which ``events`` holds by now.

    ``max_rows`` has no effect any more: rows are summed before anything is ordered by key; the rule itself cuts its hot keys.
    """
    touched = touched_rows(store.events() if events is None else events, late, rule, first_span)
    if touched is None:
        return Repaired(0, 0)
    sessions, rows = touched
    holds = materialize(rule.detect(rows).select(*ALERT_COLUMNS), "holds")
    of_rule = store.alerts().where(F.col("rule_name") == rule.name)
    stored = materialize(inside(of_rule, sessions, rule.key, "detected_at").select("alert_id"), "stored")
    withdrawn = store.change_alerts(stored.join(holds.select("alert_id"), "alert_id", "left_anti"), withdrawn=True)
    return Repaired(withdrawn, store.persist_alerts(not_stored(holds, stored)))
