"""Operator 12 against a uniform-cost search over all edits, and its block tables against single steps."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from duskwatch.llm.conversations import BLOCK, N_SYMBOLS, START, Tables, damage, repair, summarize

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    """Conversations after damage, in order."""
    found = {}
    shown = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        own, kind = found.setdefault(conv, []), zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", shown(text)) if kind == 2 else shown(text)
        row = (turn, "user" if kind == 4 else shown(role), text)
        own += [row] * {0: 0, 3: 2}.get(kind, 1)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    for own in found.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], signed(xxhash.xxh64_intdigest(r[2].encode(), 42))))
    return found


def cheapest(rows, kinds):
    """(cost, audit, lines): the first goal a search by (cost, audit) reaches."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, k, state, lines = heapq.heappop(heap)
        if (k, state) in seen:
            continue
        seen.add((k, state))
        if k == len(rows) and state in ("", "a"):
            return cost, audit, lines
        edits = [(3, "I", 0, role, "") for role in ("user", "assistant")]
        if k < len(rows):
            _, role, text = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, state, lines))
            if kinds[k] not in ("blank", "duplicate"):
                more = 3 * (kinds[k] == "truncated")
                edits += [(more, "K", 1, role, text)] + [(3 + more, "R", 1, made, text) for made in ("user", "assistant")]
        for price, letter, step, role, text in edits:
            if role and role[0] in follows[state]:
                heapq.heappush(heap, (cost + price, audit + letter, k + step, role[0], (*lines, f"{role}:{text}")))


def expected(rows):
    out = []
    for conv, own in damaged(rows).items():
        seen, kinds = set(), []
        for _, role, text in own:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, lines = cheapest(own, kinds)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    roles, texts = ["user", "assistant"] * 4 + ["system", "tool", "", "s", None], ["a.", "b?", "c", " ", "\n\t", "é!", None, "d. ", "x", "longer text.", ""]
    out = [(conv, pick.choice([t, t, t, t + 1, None, t * 2]), pick.choice(roles), pick.choice(texts))
           for conv in [*range(120), None] for t in range(pick.randint(1, 13))]
    # one conversation holds a third of all rows, and one of its turns is repeated over and over
    out += [(777, t, pick.choice(roles[:-1]), pick.choice(texts[:4] + [f"q{t}.", f"z{t}"])) for t in range(400)] + [(777, 50, "user", "again.")] * 60
    return out + [(778, 1, "user", "long " * 50_000 + ".")] * 3


@pytest.mark.parametrize("segment_rows", [4096, 3, 50])
def test_repair_agrees_with_a_search(spark, rows, segment_rows):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rid", "'s' as seg").repartition(5)
    got = summarize(repair(damage(table), segment_rows=segment_rows), table)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected(rows)))


def test_empty_and_dropped_conversations(spark):
    gone = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)
    assert [tuple(r) for r in summarize(repair(damage(table)), table).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert summarize(repair(damage(table.limit(0))), table.limit(0)).count() == 0


def test_repaired_turns_are_legal(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    whole = {}
    for r in repair(damage(table), segment_rows=10).orderBy("seg").collect():
        whole.setdefault(r["conv_id"], []).extend(zip(r["roles"], r["texts"]))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in turns)) for turns in whole.values())


def test_blocks_agree_with_single_rows():
    tables, pick = Tables.make(), random.Random(1)
    assert tables.next_block.shape == (N_SYMBOLS ** BLOCK, len(tables.vectors))
    for n in [*range(12), 50, 203]:
        syms = np.array([pick.randrange(N_SYMBOLS) for _ in range(n)], np.int8)
        at, cost = np.arange(len(tables.vectors)), np.zeros(len(tables.vectors), np.int64)
        behind = []
        for sym in syms[::-1]:
            behind.append(at)
            cost, at = cost + tables.cost1[sym][at], tables.next1[sym][at]
        got = tables.span(syms)
        assert (got[0] == at).all() and (got[1] == cost).all()
        for vector in (0, len(tables.vectors) - 1):
            assert tables.behind_rows(syms, vector) == [int(b[vector]) for b in behind[::-1]]
            k = pick.randint(0, n)  # tracing in two parts is tracing the whole
            if vector == 0:
                first, state = tables.trace(syms[:k], int(tables.span(syms[k:])[0][0]), START, False)
                rest, _ = tables.trace(syms[k:], 0, state, True)
                assert first + rest == tables.trace(syms, 0, START, True)[0]


def test_sql_agrees_with_the_search(rows, tmp_path):
    """The query's SQL, on the rows the operator is tested with (equal turns left out, whose order SQL takes from the text itself)."""
    import duckdb
    import pandas as pd

    from duskwatch.llm.queries import ORACLES

    seen, own = set(), []
    for row in rows:
        if (row[0], row[1]) not in seen and row[0] not in (777, 778):
            seen.add((row[0], row[1]))
            own.append(row)
    con = duckdb.connect()
    con.register("raw", pd.DataFrame(own, columns=["conv_id", "turn", "role", "text"]))
    con.execute("create view conversations as select conv_id::bigint conv_id, turn::bigint turn, role, text from raw")
    got = con.sql("select conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 from (" + ORACLES["op12_four_russians"] + ")")
    assert sorted(map(str, got.fetchall())) == sorted(map(str, expected(own)))
