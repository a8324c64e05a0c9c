"""Behaviour of each login against the history of its user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.operators.detect import off_hours
from duskwatch.operators.hot_keys import KeySplit, hot_keys, micros, only_hot, without_hot
from duskwatch.schemas import FEATURE_COLUMNS
from duskwatch.session import materialize
from duskwatch.settings import Settings

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
_FAILURE, _LOGIN = 0, 1


def build_features(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per login with a user: (id, username, event_time, src_ip, six features).

    * ``is_new_source_ip``: first login of this user from this address;
    * ``failed_attempts_1h``: the user's failures in (t-1h, t];
    * ``logins_last_24h``: the user's earlier logins in (t-24h, t].

    Both counts are differences of running counts, so no frame is ever re-summed.
    """
    history = (events.filter(F.col("event_type").isin("login_success", "login_failure") & F.col("username").isNotNull())
               .select("id", "username", "event_time", "src_ip", micros().alias("_at"),
                       F.when(F.col("event_type") == "login_failure", _FAILURE).otherwise(_LOGIN).alias("_kind")))
    hot = hot_keys(history, "username", settings.max_rows_per_task)
    if hot:
        counted = _whole_users(without_hot(history, "username", hot)).unionByName(_cut_users(only_hot(history, "username", hot), hot, settings))
    else:
        counted = _whole_users(history)
    return counted.select(
        "id", "username", "event_time", "src_ip",
        F.hour("event_time").alias("hour_of_day"), F.weekday("event_time").alias("day_of_week"),
        F.col("is_new_source_ip").cast("int"), F.col("failed_attempts_1h").cast("int"),
        F.col("logins_last_24h").cast("int"), off_hours(settings).cast("int").alias("is_off_hours"),
    ).select("id", "username", "event_time", "src_ip", *FEATURE_COLUMNS)


def _count_until(window, kind: int, shift: int) -> Column:
    """Rows of ``kind`` at or before ``time - shift``."""
    return F.coalesce(F.sum((F.col("_kind") == kind).cast("bigint")).over(
        window.rangeBetween(Window.unboundedPreceding, -shift)), F.lit(0))


def _whole_users(history: DataFrame) -> DataFrame:
    """One shuffle by user; the three windows only re-sort inside it."""
    by_time = Window.partitionBy("username").orderBy("_at")
    in_order = Window.partitionBy("username", "_kind").orderBy("_at", "id")
    per_ip = Window.partitionBy("username", "_kind", "src_ip").orderBy("_at", "id")
    return (history
            .withColumn("failed_attempts_1h", _count_until(by_time, _FAILURE, 0) - _count_until(by_time, _FAILURE, HOUR_US))
            .withColumn("_logins_until", _count_until(by_time, _LOGIN, DAY_US))
            .withColumn("logins_last_24h", F.row_number().over(in_order) - 1 - F.col("_logins_until"))
            .withColumn("is_new_source_ip", (F.row_number().over(per_ip) == 1).cast("int"))
            .filter(F.col("_kind") == _LOGIN)
            .select("id", "username", "event_time", "src_ip", "is_new_source_ip", "failed_attempts_1h", "logins_last_24h"))


def ranked_logins(logins: DataFrame, hot: list | DataFrame, max_rows: int) -> DataFrame:
    """Logins with ``rank``, their place (from 1) among the user's by (time, id), and the slice they were ranked in, of about ``max_rows`` rows."""
    order = Window.partitionBy("username", "slice").orderBy("_at", "id")
    return (KeySplit(logins, "username", max_rows, hot=hot).apply(logins)
            .withColumn("rank", F.col("slice_base") + F.row_number().over(order))
            .select("id", "username", "event_time", "src_ip", "_at", "slice", "rank"))


def _counts_at(history: DataFrame, hot: list | DataFrame, max_rows: int) -> DataFrame:
    """(username, _at, failed_attempts_1h, logins_until) of every instant with a login; ``logins_until`` counts those up to a day before.

    Rows of one instant are one row with their counts, summed map-side. An instant with logins also sends probes to one day and
    one hour before it. Instants and probes, at most three to an instant, are cut along time; the counts of earlier slices and
    the running counts inside a slice give what each of them has behind it, an instant itself included.
    """
    is_kind = lambda kind: F.count_if(F.col("_kind") == kind)
    instants = history.groupBy("username", "_at").agg(is_kind(_LOGIN).alias("l"), is_kind(_FAILURE).alias("f"))
    sent = lambda order, shift, l, f: F.struct(
        F.lit(order).cast("bigint").alias("id"), (F.col("_at") - shift).alias("_at"), l.alias("l"), f.alias("f"))
    nothing = F.lit(0).cast("bigint")
    itself = sent(0, 0, F.col("l"), F.col("f"))
    probes = F.array(itself, sent(1, DAY_US, nothing, nothing), sent(2, HOUR_US, nothing, nothing))
    line = (instants.select("username", F.col("_at").alias("login_at"), (F.col("l") > 0).alias("asks"),
                            F.inline(F.when(F.col("l") > 0, probes).otherwise(F.array(itself))))
            .withColumn("event_time", F.timestamp_micros("_at")))
    line = materialize(line, "instants")
    rows = KeySplit(line, "username", max_rows, hot=hot).apply(line)
    earlier = Window.partitionBy("username").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("username", "slice").agg(F.sum("l").alias("l"), F.sum("f").alias("f"))
              .select("username", "slice", F.coalesce(F.sum("l").over(earlier), F.lit(0)).alias("_l0"),
                      F.coalesce(F.sum("f").over(earlier), F.lit(0)).alias("_f0")))
    running = Window.partitionBy("username", "slice").orderBy("_at", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = (rows.withColumn("l", F.sum("l").over(running)).withColumn("f", F.sum("f").over(running)).filter("asks")
            .join(before, ["username", "slice"]))
    logins, failures, kind = F.col("_l0") + F.col("l"), F.col("_f0") + F.col("f"), F.col("id")
    return seen.groupBy("username", F.col("login_at").alias("_at")).agg(
        F.sum(F.when(kind == 0, failures).when(kind == 2, -failures).otherwise(0)).alias("failed_attempts_1h"),
        F.sum(F.when(kind == 1, logins).otherwise(0)).alias("logins_until"))


def _cut_users(history: DataFrame, hot: list | DataFrame, settings: Settings) -> DataFrame:
    """The same numbers for users with too many rows for one task, however many of them share an instant."""
    history = materialize(history, "hot-history")
    logins = history.filter(F.col("_kind") == _LOGIN)
    ranked = materialize(ranked_logins(logins, hot, settings.max_rows_per_task), "ranked-logins")
    # what holds at an instant goes to every slice that has rows of it, so an instant's logins stay spread
    counts = ranked.select("username", "slice", "_at").distinct().join(
        _counts_at(history, hot, settings.max_rows_per_task), ["username", "_at"])
    # First login of each (user, address): a partial aggregate, so a hot pair is reduced map-side.
    first = (logins.groupBy("username", "src_ip").agg(F.min(F.struct("event_time", "id")).alias("m"))
             .select(F.col("username").alias("_user"), F.col("src_ip").alias("_ip"), F.col("m.id").alias("_id"),
                     F.col("m.event_time").alias("_time")))
    same = (F.col("id").eqNullSafe(F.col("_id")) & (F.col("username") == F.col("_user")) & (F.col("event_time") == F.col("_time"))
            & F.col("src_ip").eqNullSafe(F.col("_ip")))
    return (ranked.join(counts, ["username", "slice", "_at"]).join(first, same, "left")
            .select("id", "username", "event_time", "src_ip", F.col("_user").isNotNull().cast("int").alias("is_new_source_ip"),
                    "failed_attempts_1h", (F.col("rank") - 1 - F.col("logins_until")).alias("logins_last_24h")))
