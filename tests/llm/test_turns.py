"""Repair of conversations against plain searches over whole audits."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import pytest

from wattshed.llm import turns

SMALL = "/root/testdata/sf0.01"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_repair(rows):
    """rows: (initial, must go, truncated). Least (cost, audit, repaired initials), by Dijkstra over audits."""
    heap, done = [(0, "", 0, "", "")], set()
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if (i, state) == (len(rows), "end"):
            return cost, audit, made
        if i == len(rows) and state in ("", "a"):
            heapq.heappush(heap, (cost, audit, i, "end", made))
        for new in "ua":
            if (state, new) in NEXT:
                heapq.heappush(heap, (cost + 3, audit + "I", i, NEXT[state, new], made + new))
        if i < len(rows) and state != "end":
            initial, must, cut = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, made))
            if not must:
                for new in "ua":
                    if (state, new) in NEXT:
                        heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, NEXT[state, new], made + new))
                if (state, initial) in NEXT:
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, NEXT[state, initial], made + initial))


def symbol(row):
    initial, must, cut = row
    known = initial if initial in ("s", "u", "a") else "x"
    return known.upper() if must else "~" + known if cut else known


def some_rows(rng, n):
    return [(rng.choice("suuaaax"), (must := rng.random() < 0.2), not must and rng.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 256])
def test_audits_match_a_plain_search(block, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        rows = some_rows(rng, rng.randrange(14))
        assert turns.cheapest(tuple(map(symbol, rows))) == plain_repair(rows)[:2], rows


@pytest.mark.parametrize("rows", [[("s", False, False)] * 701, [("u", False, True)] * 500, [("a", True, False)] * 300, [("s", False, True), ("a", False, False)] * 300])
def test_long_monotonous_conversations(rows):
    assert turns.cheapest(tuple(map(symbol, rows))) == plain_repair(rows)[:2]


def test_time_grows_in_proportion():
    rng = random.Random(5)
    symbols = tuple(map(symbol, some_rows(rng, 60_000)))
    cost, audit = turns.cheapest(symbols)
    assert sum(x != "I" for x in audit) == len(symbols)


def plain_summary(conv, rows):
    """rows: (turn, role, text) after damage, in order."""
    seen, faults, facts = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        facts.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:], strict=False))
    numbers = {t for t, _, _ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    cost, audit, made = plain_repair(facts)
    out, left, names = [], iter(rows), iter(made)
    for edit in audit:
        row = next(left) if edit != "I" else None
        if edit != "D":
            new = {"u": "user", "a": "assistant"}.get(next(names))
            out.append(f"{row[1] if edit == 'K' else new}:{row[2] if row else ''}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)


def plain_query(rows):
    convs: dict = {}
    blank = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        these = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        these += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return sorted((plain_summary(c, sorted(rows, key=order)) for c, rows in convs.items()), key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = turns.op13_structure_repair(spark, SMALL)
    assert got.dtypes[0] == ("conv_id", "bigint") and sorted(map(tuple, got.collect()), key=str) == plain_query(rows)


def odd(spark):
    long = "é 🙂. " * 30_000
    rows = [
        (1, None, "user", "first."), (1, 0, "sys", long), (1, 5, None, None), (1, 5, "user", "a \t"), (1, 9, "", "x!\r\n"),
        (1, 9, "", "x!\r\n"), (None, None, None, None), (None, 3, "assistant", "well."), (None, 3, "user", "why?"), (2, 1, "user", " \x0b"),
    ]
    rows += [(3, t, ("user", "assistant")[t % 2], f"turn {t % 90}.") for t in range(1200)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return rows, frame.selectExpr("*", "1 AS gone", "'x' AS kind", "2 AS place", "3 AS sent", "4 AS fault")


def test_odd_rows(spark, save):
    rows, frame = odd(spark)
    folder = save(conversations=frame)
    assert sorted(map(tuple, turns.op13_structure_repair(spark, folder).collect()), key=str) == plain_query(rows)
    hurt, gone = turns.damaged(frame)
    assert {r[0] for r in turns.repair_summary(hurt, hurt[gone]).select("conv_id").collect()} == {1, 2, 3, None}
    assert turns.repaired(frame.limit(0)).collect() == [] and turns.repair_summary(frame.limit(0)).collect() == []


def test_edits_rebuild_what_the_summary_digests(spark):
    _, frame = odd(spark)
    made: dict = {}
    audits: dict = {}
    for r in turns.repaired(frame).orderBy("conv_id", "place").collect():
        audits[r["conv_id"]] = audits.get(r["conv_id"], "") + r["edit"]
        if r["edit"] != "D":
            made.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in turns.repair_summary(frame).collect():
        assert audits[r["conv_id"]] == r["audit"]
        assert hashlib.sha256("\n".join(made.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_one_shuffle(spark):
    plan = turns.op13_structure_repair(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
