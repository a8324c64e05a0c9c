"""Non-overlapping threshold windows: k events of one key within a time span.

Scanning a key in time order, an alert is raised at the first event that is the
k-th or later within the span, and counting starts anew after it. Two facts make
this a distributed job rather than a loop:

* counting grows by one event at a time, so an alert always holds exactly k
  events: row r is a *candidate* iff ``time[r] - time[r-k+1] <= span``, which is
  one ``lag``. Ordinary traffic ends here, inside the shuffle's own task;
* alerts are the candidates picked greedily with ranks at least k apart. A candidate
  k or more ranks behind the one before it is free of all earlier picks. Those of a whole key are
  folded in blocks of bounded size, in native expressions. Of a key that is cut, all that
  a slice of rows must know about the past is how many events came since the last
  pick, capped at k-1: k states. So the slices of a hot key are worked on
  independently for every state, the slices' state maps are chained (one small
  row per slice), and the picks of the state that really arrived are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskwatch.operators.hot_keys import KeySplit, micros
from duskwatch.session import materialize

_LAG_LIMIT = 32


def candidates(rows: DataFrame, key: str, threshold: int, span_us: int, carry: list[str]) -> DataFrame:
    """Rows that end a window of ``threshold`` events within the span, with its members. ``rows`` are spread over slices."""
    k = threshold
    order = Window.partitionBy(key, "slice").orderBy("event_time", "id")
    member = F.struct("id", "event_time", *carry)
    if k <= _LAG_LIMIT:
        members = F.array(*[F.lag(member, i).over(order) for i in range(k - 1, 0, -1)], member)
        first_at = F.lag("_at", k - 1).over(order) if k > 1 else F.col("_at")
    else:
        members = F.collect_list(member).over(order.rowsBetween(-(k - 1), 0))
        first_at = F.lag("_at", k - 1).over(order)
    rank = F.col("slice_base") + F.sum(F.col("own").cast("bigint")).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    return (rows.withColumn("rank", rank).withColumn("_first_at", first_at).withColumn("members", members)
            .filter("own").filter(F.col("_at") - F.col("_first_at") <= span_us)
            .select(key, "slice", "slice_base", "slice_rows", "rank", "event_time", "id", "members"))


def _follow(ranks: np.ndarray, k: int, base: int, state: int, jump: np.ndarray) -> list[int]:
    """Positions picked when ``state`` events are open at the start of the slice."""
    at, out = int(np.searchsorted(ranks, base + k - state)), []
    while at < len(ranks):
        out.append(at)
        at = int(jump[at])
    return out


def _pick(k: int):
    def pick(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        ranks = group["rank"].to_numpy()
        base = group["slice_base"][0].as_py()
        jump = np.searchsorted(ranks, ranks + k)
        taken, state_of = [], []
        for state in range(k):
            picks = _follow(ranks, k, base, state, jump)
            taken += picks
            state_of += [state] * len(picks)
        out = group.take(pa.array(taken, pa.int64()))
        return out.append_column("entry_state", pa.array(state_of, pa.int64()))
    return pick


_OPEN = 64  # candidates of a block, and blocks of a group


def blocks_of(found: DataFrame, key: str) -> DataFrame:
    """(key, slice, _block, rows): the candidates of whole keys in order, at most ``_OPEN`` to a block."""
    order = Window.partitionBy(key, "slice").orderBy("event_time", "id")
    block = F.floor((F.row_number().over(order) - 1) / _OPEN)
    return found.withColumn("_block", block).groupBy(key, "slice", "_block").agg(
        F.array_sort(F.collect_list(F.struct("rank", "event_time", "id", "members"))).alias("rows"))


def fold_sessions(found: DataFrame, key: str, k: int) -> DataFrame:
    """The candidates of whole keys that are picked: (key, event_time, id, members).

    A fold copies what it carries at every step, so nothing is folded that grows with a session. A key's candidates are cut into blocks;
    all that a block must know of those before it is the first rank that is free, which lies less than k behind its own first one: k states.
    Blocks are folded for every state, their maps are chained within groups of blocks, the groups' over the key, and each block is
    folded once more from the state that really arrived. ``found`` is clustered by (key, slice), which this keeps, so nothing is shuffled.
    """
    blocks = blocks_of(found, key)
    kind = blocks.schema["rows"].dataType.simpleString()
    in_group = Window.partitionBy(key, "slice", "_group").orderBy("_block")
    line = Window.partitionBy(key, "slice").orderBy("_group", "_block")
    earlier = (Window.unboundedPreceding, -1)
    from_each_state = lambda base, run: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda state: run(base + state))
    # the rank that is free once a block or group is behind, given the one that was free before it
    passed = lambda free, block: block["exits"][F.greatest(free - block["base"], F.lit(0))]
    after = lambda free, row: F.when(row["rank"] < free, free).otherwise(row["rank"] + k)
    exits = F.aggregate("rows", from_each_state(F.col("_base"), lambda free: free),
                        lambda states, row: F.transform(states, lambda free: after(free, row)))
    whole = from_each_state(F.col("_first"), lambda free: F.aggregate(F.concat("_earlier", F.array("_exits")), free, passed))
    chained = (blocks.withColumn("_group", F.floor(F.col("_block") / _OPEN)).withColumn("_base", F.col("rows")[0]["rank"])
               .withColumn("_more", F.lead("_block").over(line).isNotNull())
               .withColumn("_exits", F.when(F.col("_more"), F.struct(F.col("_base").alias("base"), exits.alias("exits"))))
               .withColumn("_earlier", F.collect_list("_exits").over(in_group.rowsBetween(*earlier)))
               .withColumn("_first", F.first("_base").over(in_group))
               .withColumn("_whole", F.when(F.col("_more") & (F.col("_block") % _OPEN == _OPEN - 1), F.struct(
                   F.col("_first").alias("base"), whole.alias("exits"))))
               .withColumn("_groups", F.collect_list("_whole").over(line.rowsBetween(*earlier))))
    entered = F.aggregate("_earlier", F.aggregate("_groups", F.lit(0).cast("bigint"), passed), passed)
    nothing = F.struct(entered.alias("free"), F.array().cast(kind).alias("taken"))
    pick = lambda acc, row: F.when(row["rank"] < acc["free"], acc).otherwise(
        F.struct((row["rank"] + k).alias("free"), F.concat(acc["taken"], F.array(row)).alias("taken")))
    picked = F.aggregate("rows", nothing, pick, lambda acc: acc["taken"])
    return chained.select(key, F.inline(picked)).select(key, "event_time", "id", "members")


def _exits(k: int):
    """State left behind by a slice, for each state it may be entered in."""
    def exits(group: pa.Table) -> pa.Table:
        ranks = np.sort(group["rank"].to_numpy())
        base, rows = group["slice_base"][0].as_py(), group["slice_rows"][0].as_py()
        jump = np.searchsorted(ranks, ranks + k)
        out = []
        for state in range(k):
            picks = _follow(ranks, k, base, state, jump)
            since = base + rows - int(ranks[picks[-1]]) if picks else state + rows
            out.append(min(since, k - 1))
        return pa.table({group.column_names[0]: group[group.column_names[0]].slice(0, 1),
                         "slice": group["slice"].slice(0, 1),
                         "exit_states": pa.array([out], pa.list_(pa.int64()))})
    return exits


def _chain(k: int):
    """Walk one key's slices in order; a slice without candidates only adds its rows."""
    def chain(group: pa.Table) -> pa.Table:
        group = group.sort_by("slice")
        state, entered = 0, []
        for rows, exit_states in zip(group["slice_rows"].to_pylist(), group["exit_states"].to_pylist()):
            entered.append(state)
            state = exit_states[state] if exit_states else min(state + rows, k - 1)
        return pa.table({group.column_names[0]: group[group.column_names[0]], "slice": group["slice"],
                         "entry_state": pa.array(entered, pa.int64())})
    return chain


def threshold_windows(events: DataFrame, key: str, threshold: int, span_us: int,
                      carry: tuple[str, ...] = (), max_rows: int = 5_000_000, hot: list | DataFrame | None = None) -> DataFrame:
    """One row per alert: ``key``, ``event_time`` and ``id`` of its last event, ``members``.

    ``members`` holds the k events in order, each with ``id``, ``event_time`` and the
    ``carry`` columns. Ties in time are ordered by ``id``. ``hot`` gives the hot keys
    where they are known already.
    """
    if threshold < 1:
        raise ValueError("threshold must be at least 1")
    carry = [c for c in carry if c != key]
    keyed = events.filter(F.col(key).isNotNull())
    split = KeySplit(keyed, key, max_rows, hot=hot)
    rows = keyed.select(key, "event_time", "id", *carry).withColumn("_at", micros())
    # Clustered by (key, slice) already by the window, so neither way adds a shuffle; a group is the
    # candidates of one slice, at most about max_rows.
    cold = fold_sessions(candidates(split.whole(rows), key, threshold, span_us, carry), key, threshold)
    if not split.hot:
        return cold
    cut = materialize(candidates(split.cut(rows, threshold - 1), key, threshold, span_us, carry), "candidates")
    key_type = cut.schema[key].dataType.simpleString()
    exits = cut.select(key, "slice", "slice_base", "slice_rows", "rank").groupBy(key, "slice").applyInArrow(
        _exits(threshold), f"{key} {key_type}, slice bigint, exit_states array<bigint>")
    entered = (split.slice_list().join(exits, [key, "slice"], "left")
               .select(key, "slice", "slice_rows", "exit_states")
               .groupBy(key).applyInArrow(_chain(threshold), f"{key} {key_type}, slice bigint, entry_state bigint"))
    schema = T.StructType(cut.schema.fields + [T.StructField("entry_state", T.LongType())])
    picked = cut.groupBy(key, "slice").applyInArrow(_pick(threshold), schema).join(entered, [key, "slice", "entry_state"], "left_semi")
    return cold.unionByName(picked.select(key, "event_time", "id", "members"))
