"""Repair of the structure of conversations, by depth-first branch and bound.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``. Each
turn is kept (cost 0), given the role that its place asks for (3) or deleted (4),
and empty turns may be inserted (3). Turns that are blank or repeat an earlier
one must go; a truncated turn that stays adds 3. Of the cheapest audits, the
initials of the edits in order, the least in ASCII wins.

The search goes down in order of the audit with a stack of its own. The rest of
the turns costs no less than the sum of what each cannot avoid; a quick first dive
gives an upper bound and each complete audit a lower one. For each place and state
of the pattern a table has the least cost that reached it: whoever comes later is
behind in the audit too, so it goes on only if it is cheaper. Long conversations
are searched BLOCK turns at a time from the best audit in each state, so that time
and memory grow in proportion to the turns.

Spark sends a conversation's turns to one task, in order and twice: first without
their texts, to find the audit, then with them, to carry it out as they pass. A
task keeps some bytes for each turn of one conversation, and one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattshed.llm.common import free_name, table

KEEP_TRUNCATED, RENAME, DELETE, INSERT = 3, 3, 4, 3
#: Turns that are searched at once.
BLOCK = 256
#: What may be between the costs of two states that both lead to a best audit: the
#: dearer one is reached from any state by two inserted turns and a deletion.
SLACK = 2 * INSERT + DELETE
ROWS = 2000

# States of the pattern: at the start, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
#: The state that the role which a place asks for leads to.
_WANTED = [USER, USER, ASSISTANT, USER]
#: Empty turns that close a conversation in each state.
_CLOSE = ["", "II", "I", ""]
_NAMES = {USER: "user", ASSISTANT: "assistant"}

FAULTS = ["blank", "duplicate", "truncated"]
_EDITS = "conv_id bigint, place bigint, turn bigint, edit string, fault string, role string, text string"
_SUMMARY = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
    " cost bigint, audit string, repaired_sha256 string"
)


def _step(state: int, symbol: str) -> tuple[list[tuple[str, int, int]], int]:
    """Edits of one turn as (initial, cost, next state), by initial, and the least cost.

    A symbol is the initial of the role, upper case if the turn must go, with a "~"
    in front if it is truncated.
    """
    extra, initial = (KEEP_TRUNCATED, symbol[1:]) if symbol[0] == "~" else (0, symbol)
    edits = [("D", DELETE, state)]
    if initial.isupper():
        return edits, DELETE
    if initial in _NEXT[state]:
        edits.append(("K", extra, _NEXT[state][initial]))
    edits.append(("R", extra + RENAME, _WANTED[state]))
    return edits, min(DELETE, extra if initial in ("s", "u", "a") else extra + RENAME)


@lru_cache(maxsize=256)
def _steps(symbol: str) -> tuple[list[list[tuple[str, int, int]]], int]:
    found = [_step(state, symbol) for state in range(4)]
    return [f[0] for f in found], found[0][1]


def _dive(symbols: tuple[str, ...], state: int, last: bool) -> int:
    """Cost of the way that takes the cheapest edit of each turn."""
    cost = 0
    for x in symbols:
        _, price, state = min(_steps(x)[0][state], key=lambda e: e[1])
        cost += price
    return cost + (INSERT * len(_CLOSE[state]) if last else 0)


def search(
    symbols: tuple[str, ...], seeds: list[tuple[int, int]], last: bool
) -> dict[int, tuple[int, int, str]]:
    """State behind the symbols -> (cost, seed, audit), for all states that a best audit can go through.

    seeds are (cost, state) in order of the audits that led there. If last, the
    audit is closed, and only the best one is given.
    """
    n = len(symbols)
    steps = [_steps(x) for x in symbols]
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + steps[i][1]
    bound = min(cost + _dive(symbols, state, last) for cost, state in seeds) + (0 if last else SLACK)
    reached = [bound + 1] * (4 * n + 4)
    best: dict[int, tuple[int, int, str]] = {}
    path: list[str] = []
    # (turn, state, cost, seed, edits before, edit); those on top come first in the audit.
    stack = [(0, state, cost, k, 0, "") for k, (cost, state) in reversed(list(enumerate(seeds)))]
    while stack:
        i, state, cost, seed, depth, edit = stack.pop()
        if cost + least[i] > bound or cost >= reached[4 * i + state]:
            continue
        reached[4 * i + state] = cost
        del path[depth:]
        if edit:
            path.append(edit)
            depth += 1
        if i == n:
            if last:
                cost += INSERT * len(_CLOSE[state])
                if cost <= bound:
                    best = {state: (cost, seed, "".join(path) + _CLOSE[state])}
                    bound = cost - 1
            else:
                best[state] = (cost, seed, "".join(path))
                bound = min(bound, cost + SLACK)
            continue
        edits = steps[i][0][state]
        for letter, price, to in edits[:0:-1]:
            stack.append((i + 1, to, cost + price, seed, depth, letter))
        stack.append((i, _WANTED[state], cost + INSERT, seed, depth, "I"))
        stack.append((i + 1, state, cost + DELETE, seed, depth, "D"))
    return best


@lru_cache(maxsize=50_000)
def _short(symbols: tuple[str, ...]) -> tuple[int, str]:
    (cost, _, audit), = search(symbols, [(0, START)], True).values()
    return cost, audit


def cheapest(symbols: tuple[str, ...]) -> tuple[int, str]:
    """Cost and audit of the best repair."""
    if len(symbols) <= BLOCK:
        return _short(symbols)
    # Ways are kept as chains of (way before, audit of a block); they join again where they parted.
    ways = [(0, START, None)]
    for lo in range(0, len(symbols), BLOCK):
        last = lo + BLOCK >= len(symbols)
        found = search(symbols[lo : lo + BLOCK], [(cost, state) for cost, state, _ in ways], last)
        order = sorted(found.items(), key=lambda kv: (kv[1][1], kv[1][2]))
        ways = [(cost, state, (ways[seed][2], audit)) for state, (cost, seed, audit) in order]
    cost, _, chain = ways[0]
    parts = []
    while chain:
        chain, audit = chain
        parts.append(audit)
    return cost, "".join(reversed(parts))


@dataclass
class Facts:
    """What the turns of a conversation say without their texts."""

    symbols: tuple[str, ...]
    faults: dict[str, int]
    illegal: int
    gaps: int


def _facts(rows: Iterator[tuple]) -> Facts:
    symbols, faults, illegal, before = [], dict.fromkeys(FAULTS, 0), 0, None
    low = high = last = None
    distinct = 0
    for _, _, turn, fault, role, _ in rows:
        initial = role[:1]
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        known = initial if initial in ("s", "u", "a") else "x"
        if fault:
            faults[fault] += 1
        symbols.append("~" + known if fault == "truncated" else known.upper() if fault else known)
        if turn is not None and turn != last:
            low, high, last, distinct = turn if low is None else low, turn, turn, distinct + 1
    return Facts(tuple(symbols), faults, illegal, high - low + 1 - distinct if distinct else 0)


def _carried_out(audit: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(edit, fault, turn, role, text) of each edit; a deleted turn shows what it was."""
    state = START
    for edit in audit:
        if edit == "I":
            state = _WANTED[state]
            yield "I", None, None, _NAMES[state], ""
            continue
        _, _, turn, fault, role, text = next(rows)
        if edit == "R":
            state = _WANTED[state]
            role = _NAMES[state]
        elif edit == "K":
            state = _NEXT[state][role[:1]]
        yield edit, fault, turn, role, text


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "sent", "turn", "fault", "role", "text")), strict=True)


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, facts, cost, audit, edits) of each conversation; take the edits before going on."""
    for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
        passes = groupby(rows, key=lambda r: r[1])
        sent, these = next(passes)
        if sent == 0:  # the mark of a conversation
            sent, these = next(passes, (1, iter(())))
        facts = _facts(these)
        cost, audit = cheapest(facts.symbols)
        _, again = next(passes, (2, iter(())))
        yield conv_id, facts, cost, audit, _carried_out(audit, again)


def _written(make, schema: str):
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]

    def each(batches):
        held: list[tuple] = []
        size = 0

        def flush():
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
            )

        for row in make(_repairs(batches)):
            held.append(row)
            size += len(row[-1] or "")
            if len(held) == ROWS or size > 4 << 20:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return each


def _edit_rows(repairs):
    for conv_id, _, _, _, edits in repairs:
        for place, (edit, fault, turn, role, text) in enumerate(edits):
            yield conv_id, place, turn, edit, fault, role, text


def _summary_rows(repairs):
    for conv_id, facts, cost, audit, edits in repairs:
        digest, first = hashlib.sha256(), True
        for edit, _, _, role, text in edits:
            if edit != "D":
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        yield (
            conv_id, facts.gaps, *(facts.faults[f] for f in FAULTS), facts.illegal, cost, audit, digest.hexdigest()
        )


def _in_order(turns: DataFrame, gone: Column | None, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation's mark, its turns without texts, and its turns, in order, in one task."""
    own = turns.select(
        turns[conv_id].cast("long").alias("conv_id"), turns[turn].cast("long").alias("turn"),
        F.coalesce(turns[role], F.lit(" ")).alias("role"), F.coalesce(turns[text], F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else gone).alias("gone"),
    )
    # Both windows find their rows together already: the turns are shuffled once.
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    alike = Window.partitionBy("conv_id", "gone", "role", F.sha2("text", 256)).orderBy("place")
    body = F.rtrim(F.translate("text", "\t\n\x0b\f\r", "     "))
    fault = (
        F.when(body == "", "blank")
        .when(F.row_number().over(alike) > 1, "duplicate")
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated")
    )
    marked = (
        own.repartition("conv_id").withColumn("place", F.row_number().over(ordered)).withColumn("fault", fault)
    )
    sent = F.when(F.col("gone"), F.array(F.lit(0))).otherwise(F.array(F.lit(1), F.lit(2)))
    return (
        marked.withColumn("sent", F.explode(sent))
        .withColumn("text", F.when(F.col("sent") == 2, F.col("text")))
        .sortWithinPartitions("conv_id", "sent", "place")
        .select("conv_id", "sent", "turn", "fault", "role", "text")
    )


def repaired(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, place, turn, edit, fault, role, text): every edit of the best repair, in order.

    edit is K, R, D or I, role and text are those after the edit, or the deleted
    turn's. Turns stand in order of turn (NULL first), role and text. A NULL role or
    text is one space; repeated rows are turns that repeat; rows without conv_id
    form one conversation; a table without rows has no edits. Extra columns are left
    out, whatever their names.
    """
    return _in_order(turns, None, conv_id, turn, role, text).mapInArrow(_written(_edit_rows, _EDITS), _EDITS)


def repair_summary(
    turns: DataFrame,
    gone: Column | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation: its faults, the cost and audit of its repair, and a digest of what repair makes.

    Rows where gone holds only say that there is such a conversation. The rest is
    as in repaired.
    """
    return _in_order(turns, gone, conv_id, turn, role, text).mapInArrow(_written(_summary_rows, _SUMMARY), _SUMMARY)


def damaged(turns: DataFrame) -> tuple[DataFrame, str]:
    """conversations with faults put in by hash, and the column that says which rows are gone."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    kind_name, gone = free_name(turns, "kind"), free_name(turns, "gone")
    hurt = turns.withColumn(kind_name, kind)
    is_ = lambda k: F.col(kind_name) == k
    hurt = hurt.withColumns(
        {
            "text": F.when(is_(1), "").when(is_(2), F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text")),
            "role": F.when(is_(4), "user").otherwise(blank("role")),
            gone: is_(0),
        }
    )
    copies = F.when(is_(3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.withColumn(kind_name, F.explode(copies)).drop(kind_name), gone


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt, gone = damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return repair_summary(hurt, F.col(gone))
