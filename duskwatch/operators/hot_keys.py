"""Splitting a key that is too big for one task into ordered slices.

A window function puts all rows of one key into one task. When a single address
or account holds a large share of the table that task never ends. ``KeySplit``
cuts such a key along (time, id) into slices of about ``max_rows`` rows; every
other key stays whole as slice 0. Results stay exact because each slice knows

* ``slice_base``: how many rows of the key come before it, so ranks are global,
* its halo: the rows right before it, repeated as context (``own = False``), so
  ``lag`` and row frames see across the cut.

What is worked out per hot key is a row count per time bucket (at most about
``_MAX_TICKS`` of them), kept as a written table. A bucket that is itself too big is cut
finer, at measured quantiles of its times; an instant that is too big by itself is cut
at measured quantiles of its ids. So a burst that shares one timestamp is cut as well,
however its times and ids are spread. Only two numbers reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.session import materialize

SECOND = 1_000_000
_MAX_TICKS = 1_000_000  # time buckets per hot key
_PIECES = 4  # of a burst, per max_rows
_MAX_PIECES = 4096
_INSTANT = 1 << 20  # places of a tick inside one instant
_LISTED = 1000  # hot keys that are named in a plan; more are a table

_MEMBER = "struct<slice:bigint,slice_base:bigint,slice_rows:bigint,own:boolean>"


def micros(column: str = "event_time") -> Column:
    return F.unix_micros(F.col(column))


def hot_keys(df: DataFrame, key: str, max_rows: int) -> list | DataFrame:
    """Values of ``key`` with more than ``max_rows`` rows: a list, or a written table (``_hot``) where they are more than ``_LISTED``."""
    return hot_keys_of(df, {"only": (key, "true")}, max_rows)["only"]


def hot_keys_of(df: DataFrame, wanted: dict[str, tuple[str, str]], max_rows: int) -> dict[str, list | DataFrame]:
    """``hot_keys`` for several (key, row condition) pairs, in one pass over ``df``; in a second one if some are to be written.

    Counts are exact and summed map-side; only a key and a number are shuffled. What is gathered is at most ``_LISTED``
    keys per pair: a list is part of every plan that names it, so longer ones are tables that are joined.
    """
    entry = lambda name, key, holds: F.when(F.expr(holds), F.struct(
        F.lit(name).alias("name"), F.col(key).cast("string").alias("key")))
    entries = F.array(*[entry(name, *pair) for name, pair in wanted.items()])
    found = (df.select(F.explode(entries).alias("_e")).filter("_e.key IS NOT NULL").groupBy("_e.name", "_e.key")
             .agg(F.count("*").alias("n")).filter(F.col("n") > max_rows))
    few = found.limit(_LISTED + 1).collect()
    if len(few) <= _LISTED:
        return {name: sorted(r["key"] for r in few if r["name"] == name) for name in wanted}
    written = materialize(found.select("name", F.col("key").alias("_hot")), "hot-keys")
    out = {}
    for name in wanted:
        own = written.filter(F.col("name") == name).select("_hot")
        first = [r["_hot"] for r in own.limit(_LISTED + 1).collect()]
        out[name] = sorted(first) if len(first) <= _LISTED else own
    return out


def only_hot(df: DataFrame, key: str, hot: list | DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among ``hot``."""
    if isinstance(hot, list):
        return df.filter(F.col(key).isin(hot))
    return df.join(hot, F.col(key).cast("string") == F.col("_hot"), "left_semi")


def without_hot(df: DataFrame, key: str, hot: list | DataFrame) -> DataFrame:
    """All other rows, those without a key as well."""
    if isinstance(hot, list):
        return df.filter(~F.coalesce(F.col(key).isin(hot), F.lit(False))) if hot else df
    return df.join(hot, F.col(key).cast("string") == F.col("_hot"), "left_anti")


class KeySplit:
    """How the keys of ``df`` (``key``, ``event_time``, ``id``, ...) are spread over tasks.

    Measured and written once when built; ``apply`` is then used on the same rows. ``hot`` gives
    the hot keys where they are known already. With ``ties_together`` a slice is never
    cut inside one timestamp.
    """

    def __init__(self, df: DataFrame, key: str, max_rows: int, hot: list | DataFrame | None = None,
                 ties_together: bool = False):
        self.key, self.max_rows, self._ties_together = key, max_rows, ties_together
        self.hot = hot_keys(df, key, max_rows) if hot is None else hot
        if self.hot:
            slim = only_hot(df, key, self.hot).select(key, micros().alias("_at"), "id")
            self._rows = materialize(slim, "hot-rows")
            first, last = self._rows.agg(F.min("_at"), F.max("_at")).first()
            self._grain = max(1, math.ceil((last - first) / _MAX_TICKS / SECOND)) * SECOND
            self._times, self._ids = self._measure_bursts()
            self._ticks = materialize(self._count_ticks(), "ticks")

    def _bucket(self) -> Column:
        return (F.floor(F.col("_at") / self._grain) * self._grain).cast("bigint")

    def _measure_bursts(self) -> tuple[DataFrame | None, DataFrame | None]:
        """Cut points of buckets with more than max_rows rows, by time, and of instants with more than that, by id."""
        key, counted = self.key, self._rows.groupBy(self.key, self._bucket().alias("_bucket")).agg(F.count("*").alias("n"))
        over = materialize(counted.filter(F.col("n") > self.max_rows), "bursts")
        most = over.agg(F.max("n")).first()[0]
        if most is None:
            return None, None
        pieces = min(_MAX_PIECES, _PIECES * math.ceil(most / self.max_rows))
        quantiles = lambda c: F.array_sort(F.array_distinct(F.percentile_approx(
            c, [k / pieces for k in range(1, pieces)], max(10_000, 20 * pieces))))
        rows = self._rows.withColumn("_bucket", self._bucket()).join(over.drop("n"), [key, "_bucket"])
        times = materialize(rows.groupBy(key, "_bucket").agg(quantiles("_at").alias("_time_cuts")), "time-cuts")
        if self._ties_together:
            return times, None
        # an instant that holds that many rows is a cut point itself
        instants = rows.join(times, [key, "_bucket"]).filter(F.array_contains("_time_cuts", F.col("_at")))
        ids = instants.groupBy(key, "_at").agg(F.count("*").alias("n"), quantiles("id").alias("_id_cuts")).filter(F.col("n") > self.max_rows)
        return times, materialize(ids.drop("n"), "id-cuts")

    def _ticked(self, rows: DataFrame) -> DataFrame:
        """Add (_t, _sub): the grain a row is counted and cut on. Monotone in (time, id)."""
        zero = F.lit(0).cast("bigint")
        out = rows.withColumn("_t", self._bucket())
        if self._times is None:
            return out.withColumn("_sub", zero)
        # a place between two cut points, or on one
        place = lambda cuts, c: F.coalesce(
            F.size(F.filter(cuts, lambda x: x < F.col(c))) + F.size(F.filter(cuts, lambda x: x <= F.col(c))), F.lit(0)).cast("bigint")
        held = lambda cuts: F.coalesce(F.col(cuts), F.array().cast("array<bigint>"))
        cut = out.join(self._times.withColumnRenamed("_bucket", "_t"), [self.key, "_t"], "left")
        inner = zero
        if self._ids is not None:
            cut, inner = cut.join(self._ids, [self.key, "_at"], "left"), place(held("_id_cuts"), "id")
        return cut.select(*rows.columns, "_t", (place(held("_time_cuts"), "_at") * _INSTANT + inner).alias("_sub"))

    def _count_ticks(self) -> DataFrame:
        key = self.key
        by_time = Window.partitionBy(key).orderBy("_t", "_sub")
        before = F.coalesce(F.sum("n").over(by_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        in_slice = Window.partitionBy(key, "slice")
        return (self._ticked(self._rows).groupBy(key, "_t", "_sub").agg(F.count("*").alias("n"))
                .withColumn("before", before)
                .withColumn("slice", F.floor(F.col("before") / self.max_rows).cast("bigint"))
                .withColumn("slice_base", F.min("before").over(in_slice))
                .withColumn("slice_rows", F.sum("n").over(in_slice)))

    def slice_list(self) -> DataFrame:
        """(key, slice, slice_base, slice_rows): one row per slice of each hot key."""
        return self._ticks.select(self.key, "slice", "slice_base", "slice_rows").distinct()

    def plan(self, context_rows: int) -> DataFrame:
        """For every (hot key, tick): the slice its rows belong to and those they are context of."""
        key, ticks = self.key, self._ticks
        own = F.struct("slice", "slice_base", "slice_rows", F.lit(True).alias("own"))
        out = [F.col(key).alias("_pkey"), F.col("_t").alias("_pt"), F.col("_sub").alias("_psub")]
        if context_rows == 0:
            return ticks.select(*out, F.array(own).alias("_members"))
        # A tick ending at position p is context of each slice whose base lies in [p, p + context).
        nothing, member = F.lit(None).cast(_MEMBER), F.struct(
            "slice", "slice_base", "slice_rows", F.lit(False).alias("own"))
        ends = ticks.select(key, "_t", "_sub", (F.col("before") + F.col("n")).alias("pos"),
                            own.alias("own_slice"), nothing.alias("start"))
        starts = ticks.filter(F.col("before") == F.col("slice_base")).select(
            key, F.lit(None).cast("bigint").alias("_t"), F.lit(None).cast("bigint").alias("_sub"),
            F.col("before").alias("pos"), nothing.alias("own_slice"), member.alias("start"))
        ahead = Window.partitionBy(key).orderBy("pos").rangeBetween(0, context_rows - 1)
        return (ends.unionByName(starts).withColumn("context_of", F.collect_list("start").over(ahead))
                .filter("_t IS NOT NULL")
                .select(*out, F.concat(F.array("own_slice"), "context_of").alias("_members")))

    def whole(self, df: DataFrame) -> DataFrame:
        """Rows of the keys that are not cut, as slice 0, with ``slice_base`` 0, ``slice_rows`` NULL and ``own`` true."""
        zero = F.lit(0).cast("bigint")
        return without_hot(df, self.key, self.hot).select("*", zero.alias("slice"), zero.alias("slice_base"),
                                                F.lit(None).cast("bigint").alias("slice_rows"), F.lit(True).alias("own"))

    def cut(self, df: DataFrame, context_rows: int = 0) -> DataFrame:
        """Rows of the keys that are cut, with their slice; every slice also gets its context, with ``own`` false."""
        rows, plan = self._ticked(only_hot(df, self.key, self.hot)), self.plan(context_rows)
        # No broadcast hint: the plan has a row per (hot key, tick). AQE broadcasts it when it
        # is small and otherwise hashes on (key, tick), which no hot key can dominate.
        cut = rows.join(plan, (rows[self.key] == plan["_pkey"]) & (rows["_t"] == plan["_pt"])
                        & (rows["_sub"] == plan["_psub"]))
        return cut.select(*[rows[c] for c in df.columns], F.inline("_members"))

    def apply(self, df: DataFrame, context_rows: int = 0) -> DataFrame:
        """Add ``slice``, ``slice_base``, ``slice_rows`` (NULL for a whole key) and ``own``.

        ``df`` needs ``key``, ``id`` and ``_at`` (micros). With ``context_rows`` = c every
        slice also gets at least the c rows before it, with ``own = False``.
        """
        return self.whole(df).unionByName(self.cut(df, context_rows)) if self.hot else self.whole(df)
