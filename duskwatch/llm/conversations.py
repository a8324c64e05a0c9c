"""Operator 12: repair of conversation structure with Four-Russians block tables.

A conversation's rows are kept, re-roled, deleted or joined by inserted turns so that the role initials read ``(s?(ua)+)?`` at the
least cost; of the cheapest edits the ASCII-least sequence is taken. What the rest of a conversation costs is a vector over the four states of that pattern
(nothing yet, after s, after u, after a). Less its minimum there are only a few such vectors, so the step over a row is a small table, and so is
the step over every block of ``BLOCK`` rows' symbols: both are worked out once per worker. A conversation is processed backward, a block a lookup;
blocks are then expanded backward into the vectors at each of their rows, from which the moves are traced forward, ties settled by letter.

Rows are sorted by range over (conversation, turn), so a conversation of any size is spread over tasks. What lies whole inside a task is settled there. Of
longer ones, and those at a task's edge, every segment of at most ``segment_rows`` gives a map from each vector to the one before
it; the maps, a few bytes each, are chained backward, the states forward, and the segments are then traced apart.

Defined cases: a null role or text is one space, a null turn sorts first, rows without a conversation id are one conversation;
rows of equal turns are taken by role, then by the text's XXH64; identical rows are duplicates but for one; texts of any length are carried whole; roles are told
by their first character, an empty one is illegal everywhere; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.batches import worker_cache
from duskwatch.llm.tables import settle

BLOCK = 4
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_INSERT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # the state an inserted turn leads to
_NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_A, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
_BLANKS = " \t\n\v\f\r"
# Symbols: 0 must go; else 1 + 2 * role class + truncated.
_CLASSES = "sua"
N_SYMBOLS = 9
LEGAL = ("su", "ua", "au")


def symbol(role: str, must_go: bool, truncated: bool) -> int:
    kind = _CLASSES.find(role[:1]) if role[:1] else -1
    return 0 if must_go else 1 + 2 * (kind if kind >= 0 else 3) + truncated


def _turn(state: int) -> str:
    """The role that a turn put after ``state`` has."""
    return "assistant" if state == AFTER_U else "user"


def _moves(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after it) of the edits that use up a row, by letter."""
    out = [("D", DELETE, state)]
    if sym:
        kind, extra = (sym - 1) // 2, TRUNCATED * ((sym - 1) % 2)
        if kind < 3 and (state, _CLASSES[kind]) in _NEXT:
            out.append(("K", KEEP + extra, _NEXT[state, _CLASSES[kind]]))
        out.append(("R", REROLE + extra, _INSERT[state]))
    return out


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(2):  # more than two inserted turns come back to where they began
        costs = [min(c, INSERT + costs[_INSERT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


@dataclass
class Tables:
    """Steps over one symbol and over a block, on numbered normalised vectors, and the moves they imply."""

    vectors: list[tuple[int, ...]]
    next1: np.ndarray  # [symbol, vector]
    cost1: np.ndarray
    next_block: np.ndarray  # [block of symbols, vector]
    cost_block: np.ndarray
    moves: list  # [symbol][vector behind the row][state] -> (letters, state)
    last: list  # [state] -> letters after the last row

    @classmethod
    def make(cls) -> "Tables":
        end = _with_inserts([0, 99, 99, 0])
        vectors, steps, moves = [end], {}, {}
        for v, vector in enumerate(vectors):  # grows while new vectors turn up
            for sym in range(N_SYMBOLS):
                before = _with_inserts([min(cost + vector[then] for _, cost, then in _moves(sym, s)) for s in range(4)])
                low = min(before)
                normal = tuple(c - low for c in before)
                if normal not in vectors:
                    vectors.append(normal)
                steps[sym, v] = vectors.index(normal), low
                moves[sym, v] = [cls._first(sym, s, before, vector) for s in range(4)]
        n = len(vectors)
        table = lambda k: np.array([[steps[s, v][k] for v in range(n)] for s in range(N_SYMBOLS)], np.int32)
        next1, cost1 = table(0), table(1)
        next_block, cost_block = next1, cost1
        for _ in range(BLOCK - 1):  # one more symbol in front: applied after the rest
            cost_block = np.concatenate([cost_block + cost1[s][next_block] for s in range(N_SYMBOLS)])
            next_block = np.concatenate([next1[s][next_block] for s in range(N_SYMBOLS)])
        last = []
        for s in range(4):
            letters = ""
            while end[s]:
                letters, s = letters + "I", _INSERT[s]
            last.append(letters)
        return cls(vectors, next1, cost1, next_block, cost_block, [[moves[s, v] for v in range(n)] for s in range(N_SYMBOLS)], last)

    @staticmethod
    def _first(sym: int, state: int, before: tuple[int, ...], behind: tuple[int, ...]) -> tuple[str, int]:
        """Letters up to and with the one that uses the row up, ASCII-least among the cheapest, and the state then."""
        letters = ""
        while True:
            options = _moves(sym, state) + [("I", INSERT, None)]
            for letter, cost, then in sorted(options, key=lambda o: o[0]):
                if before[state] == cost + (before[_INSERT[state]] if letter == "I" else behind[then]):
                    break
            letters += letter
            if letter != "I":
                return letters, then
            state = _INSERT[state]

    @classmethod
    def shared(cls) -> "Tables":
        cache = worker_cache()
        if "repair tables" not in cache:
            cache["repair tables"] = cls.make()
        return cache["repair tables"]

    def _blocks(self, syms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols in front of the first whole block, block numbers)."""
        head = len(syms) % BLOCK
        rest = syms[head:].reshape(-1, BLOCK).astype(np.int64)
        return syms[:head], rest @ N_SYMBOLS ** np.arange(BLOCK - 1, -1, -1)

    def span(self, syms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind the rows: the vector before them, and the cost between."""
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        head, blocks = self._blocks(syms)
        for steps, costs, numbers in ((self.next_block, self.cost_block, blocks), (self.next1, self.cost1, head)):
            for k in numbers[::-1].tolist():
                cost += costs[k][at]
                at = steps[k][at]
        return at, cost

    def behind_rows(self, syms: np.ndarray, vector: int) -> list[int]:
        """The vector behind every row, given the one behind the last."""
        head, blocks = self._blocks(syms)
        edges = [vector]
        for k in blocks[::-1].tolist():
            edges.append(int(self.next_block[k][edges[-1]]))
        out, symbols = [], syms.tolist()
        for k, edge in enumerate(edges):  # blocks from the last to the first, then the head
            own = symbols[len(symbols) - (k + 1) * BLOCK:len(symbols) - k * BLOCK] if k < len(blocks) else symbols[:len(head)]
            for sym in own[::-1]:
                out.append(edge)
                edge = int(self.next1[sym][edge])
        return out[::-1]

    def trace(self, syms: np.ndarray, vector: int, state: int, end: bool) -> tuple[list[str], int]:
        """Letters of every row (with inserts before it; what follows the last is a further item if ``end``) and the state after them."""
        out = []
        for sym, behind in zip(syms.tolist(), self.behind_rows(syms, vector)):
            letters, state = self.moves[sym][behind][state]
            out.append(letters)
        if end:
            out.append(self.last[state])
        return out, state

    def cost(self, vector: int) -> int:
        return self.vectors[vector][START]


def apply_edits(edits: list[str], roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    """Repaired roles and texts; ``state`` is the one before the first row."""
    out: tuple[list[str], list[str]] = ([], [])
    for k, letters in enumerate(edits):
        for letter in letters:
            if letter == "D":
                continue
            role = roles[k] if letter == "K" else _turn(state)
            out[0].append(role)
            out[1].append("" if letter == "I" else texts[k])
            state = _NEXT[state, role[0]]
    return out


# ---------------------------------------------------------------- rows in order

_STATS = ["n_rows", "blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns"]
_SEGMENT = ("conv_id bigint, seg bigint, whole boolean, first_initial string, last_initial string, " + ", ".join(f"{s} bigint" for s in _STATS)
            + ", syms binary, steps array<int>, costs array<bigint>, cost bigint, audit string, roles array<string>, texts array<string>")
_SEGMENTS = pa.schema(
    [("conv_id", pa.int64()), ("seg", pa.int64()), ("whole", pa.bool_()), ("first_initial", pa.string()), ("last_initial", pa.string())]
    + [(s, pa.int64()) for s in _STATS]
    + [("syms", pa.binary()), ("steps", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())), ("cost", pa.int64()), ("audit", pa.string()),
       ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _segment(tables: Tables, number: int, rows: list[tuple], whole: bool) -> dict:
    """One run of a conversation's rows (conv_id, turn, role, text, duplicate); repaired if it is the whole conversation."""
    count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    syms, before = [], None
    for _, _, role, text, seen in rows:
        end = text.rstrip(_BLANKS)
        cut = not seen and bool(end) and end[-1] not in ".!?"
        fault = "blank" if not end else "duplicate" if seen else "truncated" if cut else None
        if fault:
            count[fault] += 1
        syms.append(symbol(role, not end or seen, cut))
        count["illegal"] += before is not None and before + role[:1] not in LEGAL
        before = role[:1]
    turns = [r[1] for r in rows if r[1] is not None]
    roles, texts, syms = [r[2] for r in rows], [r[3] for r in rows], np.array(syms, np.int8)
    out = {"conv_id": rows[0][0], "seg": number, "whole": whole, "first_initial": roles[0][:1], "last_initial": before, "n_rows": len(rows), **count,
           "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
           "turns": len(set(turns))}
    steps, costs = tables.span(syms)
    if not whole:
        return out | {"syms": syms.tobytes(), "steps": steps, "costs": costs, "roles": roles, "texts": texts}
    edits, _ = tables.trace(syms, 0, START, True)
    roles, texts = apply_edits(edits, roles, texts, START)
    return out | {"cost": int(costs[0]) + tables.cost(int(steps[0])), "audit": "".join(edits), "roles": roles, "texts": texts}


def _segments(segment_rows: int, segment_bytes: int):
    def run(batches):
        tables, number = Tables.shared(), TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        held, parts, first = 0, 0, True
        for batch in batches:
            out = []
            for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "duplicate")]):
                other = bool(rows) and row[0] != rows[0][0]
                if other or len(rows) >= segment_rows or held > segment_bytes:
                    # the first conversation of a task may have begun in the task before it
                    out.append(_segment(tables, number, rows, other and not parts and not first))
                    number, rows, held, parts = number + 1, [], 0, 0 if other else parts + 1
                    first = first and not other
                rows.append(row)
                held += len(row[3])
            if out:
                yield pa.RecordBatch.from_pylist(out, _SEGMENTS)
        if rows:  # the last one may go on in the next task
            yield pa.RecordBatch.from_pylist([_segment(tables, number, rows, False)], _SEGMENTS)
    return run


def _by_conversation(batches, columns: list[str]):
    """The rows of each conversation, which come sorted by (conv_id, seg)."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.select(columns).to_pylist():
            if rows and row["conv_id"] != rows[0]["conv_id"]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


_BEHIND = "conv_id bigint, seg bigint, behind int, last boolean, total bigint"


def _chain_back(batches):
    """The vector behind every segment, from the end of its conversation; the whole cost stands at the first segment."""
    tables = Tables.shared()
    kind = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("behind", pa.int32()), ("last", pa.bool_()), ("total", pa.int64())])
    for rows in _by_conversation(batches, ["conv_id", "seg", "steps", "costs"]):
        vector, total, out = 0, 0, []
        for row in rows[::-1]:
            out.append({"conv_id": row["conv_id"], "seg": row["seg"], "behind": vector, "last": not out, "total": 0})
            total += row["costs"][vector]
            vector = row["steps"][vector]
        out[-1]["total"] = total + tables.cost(vector)
        yield pa.RecordBatch.from_pylist(out, kind)


def _exits(batches):
    """The state every segment is left in, for each it may be entered in."""
    tables = Tables.shared()
    for batch in batches:
        rows = batch.to_pylist()
        exits = [[tables.trace(np.frombuffer(r["syms"], np.int8), r["behind"], s, False)[1] for s in range(4)] for r in rows]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "seg", "behind", "last", "total")], pa.array(exits, pa.list_(pa.int32()))],
                                         ["conv_id", "seg", "behind", "last", "total", "exits"])


def _chain_on(batches):
    """The state every segment is entered in."""
    kind = pa.schema([("seg", pa.int64()), ("behind", pa.int32()), ("last", pa.bool_()), ("total", pa.int64()), ("state", pa.int32())])
    for rows in _by_conversation(batches, ["conv_id", "seg", "behind", "last", "total", "exits"]):
        state, out = START, []
        for row in rows:
            out.append({**{c: row[c] for c in ("seg", "behind", "last", "total")}, "state": state})
            state = row["exits"][state]
        yield pa.RecordBatch.from_pylist(out, kind)


def _repair_segments(batches):
    tables = Tables.shared()
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            edits, _ = tables.trace(np.frombuffer(r["syms"], np.int8), r.pop("behind"), r["state"], r.pop("last"))
            roles, texts = apply_edits(edits, r["roles"], r["texts"], r.pop("state"))
            out.append(r | {"cost": r.pop("total"), "audit": "".join(edits), "roles": roles, "texts": texts, "syms": None, "steps": None, "costs": None})
        yield pa.RecordBatch.from_pylist(out, _SEGMENTS)


def repair(rows: DataFrame, segment_rows: int = 4096, segment_bytes: int = 4 << 20) -> DataFrame:
    """Conversations after repair, most of them one row, long ones several in order of ``seg``.

    conv_id, seg, cost and audit of the edits (a long conversation's cost stands at its first row), repaired ``roles`` and ``texts``,
    and the numbers of the rows before: n_rows, blank, duplicate, truncated, illegal, turns and the like.
    """
    space = F.lit(" ")
    rows = settle(rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                              F.coalesce(F.col("text").cast("string"), space).alias("text"))
                  .withColumn("rid", F.monotonically_increasing_id()), "turns")
    # the first of equal rows; only those that repeat are joined back, without their texts
    said = rows.select("conv_id", "role", F.md5("text").alias("said"), F.struct("turn", "rid").alias("at"))
    repeated = said.groupBy("conv_id", "role", "said").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("said").alias("_said"), "first")
    gone = said.join(repeated, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("said") == F.col("_said"))).where(
        "at > first").select(F.col("at.rid").alias("rid"), F.lit(True).alias("duplicate"))
    marked = rows.join(gone, "rid", "left").withColumn("duplicate", F.coalesce("duplicate", F.lit(False)))
    order = ["conv_id", "turn", "role", "_hash", "rid"]
    ordered = marked.withColumn("_hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    segments = settle(ordered.mapInArrow(_segments(segment_rows, segment_bytes), _SEGMENT), "segments")

    parts = segments.where("not whole")
    chain = lambda df: df.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    behind = chain(parts.select("conv_id", "seg", "steps", "costs")).mapInArrow(_chain_back, _BEHIND)
    exits = parts.select("seg", "syms").join(behind, "seg").mapInArrow(_exits, "conv_id bigint, seg bigint, behind int, last boolean, total bigint, exits array<int>")
    entered = chain(exits).mapInArrow(_chain_on, "seg bigint, behind int, last boolean, total bigint, state int")
    mended = parts.join(entered, "seg").select(*segments.columns, "behind", "last", "total", "state").mapInArrow(_repair_segments, _SEGMENT)
    return segments.where("whole").unionByName(mended).drop("syms", "steps", "costs", "whole")


# ---------------------------------------------------------------- one row a conversation

_SUMMARY = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _summaries(batches):
    """Numbers of every conversation and the digest of its repaired ``role:text`` lines, a row at a time."""
    done: list[dict] = []
    now: dict | None = None
    lines = None

    def close():
        done.append({"conv_id": now["conv_id"], "gaps": now["last"] - now["first"] + 1 - now["turns"] if now["turns"] else 0,
                     **{c: now[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")},
                     "audit": "".join(now["audit"]), "repaired_sha256": lines.hexdigest()})

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or r["conv_id"] != now["conv_id"]:
                if now is not None:
                    close()
                now = {"conv_id": r["conv_id"], "first": None, "last": None, "initial": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0,
                       "illegal": 0, "cost": 0, "audit": [], "empty": True}
                lines = hashlib.sha256()
            for c in ("blank", "duplicate", "truncated", "illegal", "cost"):
                now[c] += r[c]
            if now["initial"] is not None:
                now["illegal"] += now["initial"] + r["first_initial"] not in LEGAL
            now["initial"] = r["last_initial"]
            if r["turns"]:
                now["turns"] += r["turns"] - (now["last"] == r["first_turn"])
                now["first"] = r["first_turn"] if now["first"] is None else now["first"]
                now["last"] = r["last_turn"]
            now["audit"].append(r["audit"])
            for role, text in zip(r["roles"], r["texts"]):
                lines.update(f"{'' if now['empty'] else chr(10)}{role}:{text}".encode())
                now["empty"] = False
    if now is not None:
        close()
    yield pa.RecordBatch.from_pylist(done, pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _SUMMARY.split(", ")]))


def summarize(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``; one with no rows in ``repaired`` has zeros and the digest of nothing."""
    found = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(_summaries, _SUMMARY)
    every = conversations.select(F.col("conv_id").cast("bigint").alias("_conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows with the damage that a hash of ``conv_id:turn`` deals out: dropped, emptied, without end marks, repeated, or given to the user."""
    space = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    return (rows.select("conv_id", "turn", "role", "text", kind.alias("_kind")).where("_kind != 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(part("role")).alias("role"), text.alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy"))
