"""Operator 7: packing documents into sequences by bin completion over the table of lengths.

However many documents there are, pieces have at most ``capacity`` different lengths, so how many pieces there
are of each length (at most ``capacity`` rows) describes the whole problem. ``plan_sequences`` works on that table alone:
around the largest length left it enumerates fillings, leaves out those that another one dominates, repeats a filling as often as the counts
allow and prunes by the waste that a better solution could still afford. Best fit, balanced pairs and fullest fillings give the first
incumbents; the search then starts from an incumbent's last steps and takes in more of them. It is bounded (``NODE_BUDGET`` and
``NODES_A_LENGTH`` fillings in all, ``FILLINGS`` of up to four pieces plus best fit in a node), so a plan may use more sequences than the least possible. The plan is a list of (filling, repetitions). A repetition stops when a length of the filling has fewer
pieces left than one more filling needs, so the plan is bounded by the number of lengths, too, and not by the number of documents. Spark then places every piece by its rank among the pieces of its length.

Defined cases: a null text is empty and holds the end id alone; a document longer than ``capacity`` is cut into
pieces of ``capacity`` ids and a rest; rows that share a doc_id are packed separately; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.batches import byte_slices, byte_texts
from duskwatch.llm.tokens import TEXT_BYTES, WordTokens
from duskwatch.llm.tables import settle

NODE_BUDGET, NODES_A_LENGTH = 20_000, 10  # fillings tried by the search after the first incumbents; bounds the driver's work
FILLINGS = 12  # undominated fillings looked at in one node

Plan = list[tuple[tuple[int, ...], int]]


def _best_fit(largest: int, counts: dict[int, int], sizes: list[int], capacity: int) -> tuple[int, ...]:
    """Largest first, then always the largest piece that still fits."""
    used, room, left = [largest], capacity - largest, dict.fromkeys([largest], 1)
    at = bisect_right(sizes, room) - 1
    while at >= 0:
        size = sizes[at]
        if size <= room and counts[size] - left.get(size, 0) > 0:
            used.append(size)
            left[size] = left.get(size, 0) + 1
            room -= size
            at = min(at, bisect_right(sizes, room) - 1)
        else:
            at -= 1
    return tuple(used)


def _fillings(largest: int, counts: dict[int, int], sizes: list[int], capacity: int, waste: int) -> list[tuple[int, ...]]:
    """Undominated fillings around ``largest`` that waste at most ``waste``: fullest first, then fewest pieces.

    A filling is dominated if one of its pieces, or two together, could be exchanged for a larger single piece that
    fits: the larger piece is harder to place elsewhere. Fillings of up to three further pieces are enumerated, then best fit completes.
    """
    room, found = capacity - largest, set()
    have = lambda *s: all(counts.get(x, 0) >= s.count(x) + (x == largest) for x in s)
    top = bisect_right(sizes, room)
    for i in range(top - 1, -1, -1):
        one = sizes[i]
        if not have(one):
            continue
        if one == room:
            return [(largest, one)]  # one piece that fills the rest dominates all
        rest = room - one
        tried = 0
        for j in range(min(i, bisect_right(sizes, rest) - 1), -1, -1):
            two = sizes[j]
            if have(one, two):
                more, third = rest - two, bisect_right(sizes, rest - two) - 1
                if more and third >= 0 and sizes[min(third, j)] and have(one, two, sizes[min(third, j)]):
                    found.add((largest, one, two, sizes[min(third, j)]))
                else:
                    found.add((largest, one, two))
                tried += 1
                if tried >= 4 or more == 0:
                    break
        if not tried:
            found.add((largest, one))
        if len(found) >= 8 * FILLINGS:
            break
    found.add(_best_fit(largest, counts, sizes, capacity))
    found.add(_balanced(largest, counts, sizes, capacity))
    done = {_complete(f, counts, sizes, capacity) for f in found}
    kept: list[tuple[int, ...]] = []
    for f in sorted((f for f in done if capacity - sum(f) <= waste), key=lambda f: (capacity - sum(f), len(f), [-x for x in f])):
        if not any(dominates(g, f) for g in kept):
            kept.append(f)
            if len(kept) == FILLINGS:
                break
    return kept


def dominates(one: tuple[int, ...], two: tuple[int, ...]) -> bool:
    """Whether the pieces of ``two`` can be dealt to the pieces of ``one`` so that none holds more than its own size (Martello and Toth)."""
    small = list(two)
    big = list(one)
    for x in one:  # what both have stays where it is
        if x in small:
            small.remove(x)
            big.remove(x)
    if len(small) > 6:
        return False

    def deal(k: int, room: list[int]) -> bool:
        return k == len(small) or any(small[k] <= r and deal(k + 1, room[:i] + [r - small[k]] + room[i + 1:]) for i, r in enumerate(room))

    return deal(0, big)


def _balanced(largest: int, counts: dict[int, int], sizes: list[int], capacity: int) -> tuple[int, ...]:
    """The largest piece with one piece that fills the rest, or else the two most alike that do, or else best fit.

    Pieces in the middle are then used up evenly, and what is left over at the end still has small and large ones.
    """
    room = capacity - largest
    free = lambda s: counts.get(s, 0) - (s == largest)
    if room <= 0 or free(room) > 0:
        return (largest, room) if room > 0 else (largest,)
    for i in range(bisect_right(sizes, room // 2) - 1, -1, -1):
        small = sizes[i]
        large = room - small
        if free(small) > (small == large) and free(large) > 0:
            return largest, large, small
    return _best_fit(largest, counts, sizes, capacity)


def _complete(filling: tuple[int, ...], counts: dict[int, int], sizes: list[int], capacity: int) -> tuple[int, ...]:
    used, room = list(filling), capacity - sum(filling)
    at = bisect_right(sizes, room) - 1
    while at >= 0 and room:
        size = sizes[at]
        if size <= room and counts[size] > used.count(size):
            used.append(size)
            room -= size
            at = min(at, bisect_right(sizes, room) - 1)
        else:
            at -= 1
    return tuple(sorted(used, reverse=True))


def _take(filling: tuple[int, ...], counts: dict[int, int], sizes: list[int]) -> tuple[int, dict[int, int], list[int]]:
    times = min(counts[s] // filling.count(s) for s in set(filling))
    counts = dict(counts)
    for s in filling:
        counts[s] -= times
    left = [s for s in sizes if counts[s]]
    return times, counts, left


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound: pieces over half a sequence need one each, and the others the room beside them."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    sizes = np.array(sorted(counts), np.int64)
    number = np.array([counts[s] for s in sizes.tolist()], np.int64)
    for k in sorted({int(s) for s in sizes if s <= capacity // 2} | {0}):
        big, half = sizes > capacity - k, (sizes <= capacity - k) & (sizes > capacity / 2)
        small = (sizes >= k) & (sizes <= capacity / 2)
        room = int((number[half] * (capacity - sizes[half])).sum())
        over = int((number[small] * sizes[small]).sum()) - room
        best = max(best, int(number[big | half].sum()) + max(0, -(-over // capacity)))
    return best


def plan_sequences(counts: dict[int, int], capacity: int, budget: int = NODE_BUDGET) -> Plan:
    """Fillings and how often each is used, covering ``counts`` exactly."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    bound = lower_bound(counts, capacity)

    def dive(counts, sizes, choose) -> Plan:
        plan = []
        while sizes:
            filling = choose(sizes[-1], counts, sizes)
            times, counts, sizes = _take(filling, counts, sizes)
            plan.append((filling, times))
        return plan

    sizes = sorted(counts)
    ways = (lambda big, c, s: _best_fit(big, c, s, capacity), lambda big, c, s: _balanced(big, c, s, capacity),
            lambda big, c, s: _fillings(big, c, s, capacity, capacity)[0])
    incumbent: Plan = []
    for choose in ways:
        plan = dive(counts, sizes, choose)
        if not incumbent or used(plan) < used(incumbent):
            incumbent = plan
        if used(incumbent) == bound:
            return incumbent
    # Waste gathers where the pieces run out, so the search starts from the end: the last steps of the incumbent are solved
    # anew, then more of them, and whatever gets better is kept.
    nodes, steps = budget + NODES_A_LENGTH * len(sizes), 4
    while nodes > 0 and used(incumbent) > bound:
        head, tail = incumbent[:-steps], incumbent[-steps:]
        left: dict[int, int] = {}
        for filling, times in tail:
            for size in filling:
                left[size] = left.get(size, 0) + times
        better, spent = _search(left, capacity, tail, nodes if not head else nodes // 4)
        nodes -= spent
        incumbent = head + better
        if not head:
            break
        steps *= 2
    return incumbent


def used(plan: Plan) -> int:
    return sum(t for _, t in plan)


def _search(counts: dict[int, int], capacity: int, incumbent: Plan, budget: int) -> tuple[Plan, int]:
    """(the best plan found for ``counts``, fillings tried): depth first, pruned by the waste a better plan could afford."""
    bound, total = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    # A stack entry holds its parent's table and what to do to it, so the search keeps one table per level.
    stack, nodes = [(counts, sorted(counts), None, None, 0, 0)], 0
    while stack and nodes < budget and used(incumbent) > bound:
        now, left, filling, path, spent, wasted = stack.pop()
        if filling:
            times, now, left = _take(filling, now, left)
            path, spent, wasted = (path, filling, times), spent + times, wasted + times * (capacity - sum(filling))
        if not left:
            if spent < used(incumbent):
                incumbent = []
                while path:
                    path, *step = path
                    incumbent.append(tuple(step))
                incumbent.reverse()
            continue
        afford = (used(incumbent) - 1) * capacity - total - wasted  # what a better solution may still waste
        if afford >= 0:
            fillings = _fillings(left[-1], now, left, capacity, afford)
            nodes += len(fillings)
            stack.extend((now, left, f, path, spent, wasted) for f in reversed(fillings))
    return incumbent, nodes


def _places(plan: Plan) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length: (first rank, rank after the last, first sequence, pieces of it in a filling, offset of its first)."""
    places, ranks, sequence = {}, {}, 0
    for filling, times in plan:
        offset = 0
        for size in sorted(set(filling), reverse=True):
            uses = filling.count(size)
            begin = ranks.get(size, 0)
            ranks[size] = begin + uses * times
            places.setdefault(size, []).append((begin, ranks[size], sequence, uses, offset))
            offset += uses * size
        sequence += times
    return places


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Every piece with chunk (the task that cut it) and nth (its number among the task's pieces of its length)."""
    def cut(batches):
        tokens, chunk, seen = WordTokens.shared(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for part in byte_slices(batches, "text", TEXT_BYTES):
            ids, n_ids = tokens.encode(byte_texts(part, "text"), end_id)
            data, ends = ids.astype("<u4").tobytes(), np.cumsum(n_ids)
            pieces = -(-n_ids // capacity)
            owner = np.repeat(np.arange(len(n_ids)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            length = np.minimum(capacity, n_ids[owner] - start)
            first = (ends - n_ids)[owner] + start
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())]
            order = np.argsort(length, kind="stable")
            run = length[order]
            fresh = np.concatenate([[True], run[1:] != run[:-1]])
            begin = np.flatnonzero(fresh)
            nth = np.empty(len(run), np.int64)
            nth[order] = np.arange(len(run)) - begin[np.cumsum(fresh) - 1] + seen[run]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([chunk] * len(owner), pa.int64()), pa.array(nth, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "nth"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk bigint, nth bigint")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    pieces = settle(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    per_chunk = pieces.groupBy("chunk", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = {size: np.array(rows, np.int64).T for size, rows in _places(plan_sequences(counts, capacity)).items()}
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_chunk.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for size in np.unique(length).tolist():
                own = np.flatnonzero(length == size)
                begin, _, first, uses, at = places[size]
                k = np.searchsorted(begin, rank[own], side="right") - 1
                step = rank[own] - begin[k]
                sequence[own], offset[own] = first[k] + step // uses[k], at[k] + step % uses[k] * size
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(starts, ["chunk", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                    "sequence_id bigint, offset bigint")
