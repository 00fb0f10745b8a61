"""Packing by patterns: plans against the least that is possible, and pieces against the library."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattshed.llm import packing, patterns

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(8))
def test_least_squares_fulfil_their_conditions(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.random((12, 30)), rng.standard_normal(12) * 10
    x = patterns.nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 0]).max(initial=0) < 1e-6
    y = rng.random(30) * (rng.random(30) < 0.2)
    assert np.allclose(a @ patterns.nonnegative_least_squares(a, a @ y), a @ y, atol=1e-6)


def test_patterns_are_all_multisets():
    found = {tuple(p) for p in patterns.patterns(7, 3)[:, 1:].astype(int).tolist()}
    want = set()
    for a in range(1, 8):
        for b in range(a + 1):
            for c in range(b + 1):
                if (b or not c) and 7 <= a + b + c < 7 + (a > 0) + (b > 0) + (c > 0):
                    want.add(tuple([a, b, c].count(g) for g in range(1, 8)))
    assert found == want


def whole(plan, counts, capacity):
    """Every text in one place, sequences full from 0 without gaps."""
    used = Counter()
    for count, lengths in plan.groups:
        assert sum(lengths) <= capacity and count > 0
        for n in lengths:
            used[n] += count
    assert used == +Counter(counts)
    length = np.repeat(list(counts), list(counts.values())).astype(np.int64)
    number = np.concatenate([np.arange(c) for c in counts.values()] or [np.zeros(0)]).astype(np.int64)
    sequence, offset = plan.place(length, number)
    ends: dict = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True)):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert sorted(ends) == list(range(plan.sequences))


@pytest.mark.parametrize("seed", range(12))
def test_plans_are_whole_and_close_to_the_least(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([64, 100, 512]))
    counts = Counter(np.clip(rng.lognormal(3, 1.2, 2500), 1, capacity).astype(int).tolist())
    plan = patterns.plan(counts, capacity)
    whole(plan, counts, capacity)
    least = max(-(-sum(n * c for n, c in counts.items()) // capacity), sum(c for n, c in counts.items() if 2 * n > capacity))
    assert plan.sequences <= 1.01 * least + 1


FEW = [
    ({}, 0), ({1: 1}, 1), ({4096: 5}, 5), ({4096: 1, 1: 4095}, 2), ({2049: 7}, 7), ({1: 1_000}, 1),
    ({1366: 10, 1365: 5}, 7), ({4000: 3, 97: 3, 96: 3}, 4), ({2048: 9}, 5), ({1365: 8, 1366: 4}, 4),
]


@pytest.mark.parametrize(("counts", "least"), FEW)
def test_plans_of_few_lengths(counts, least):
    plan = patterns.plan(counts)
    whole(plan, counts, 4096)
    assert plan.sequences == least


def test_plans_grow_with_lengths_and_not_with_texts():
    rng = np.random.default_rng(0)
    few = Counter(np.clip(rng.lognormal(6, 1, 20_000), 1, 4096).astype(int).tolist())
    many = {n: 1_000_003 * c + 17 for n, c in few.items()}
    plan = patterns.plan(many)
    assert len(plan.groups) < 10 * len(many)
    assert plan.sequences <= 1.001 * sum(n * c for n, c in many.items()) / 4096


def check_pieces(rows, texts, ids_of, capacity):
    """rows: pieces; texts: (doc_id, text) of every document."""
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == {d for d, _ in texts}
    for doc_id, text in texts:
        ids, at = np.array(ids_of(text or "") + [1], dtype="<u4"), 0
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // capacity)
        for p in pieces:
            part = ids[at : at + capacity]
            assert (p["start"], p["length"], p["ids_crc32"]) == (at, len(part), zlib.crc32(part.tobytes()))
            at += len(part)
    ends: dict = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= capacity
    return len(ends)


def test_query(spark):
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(packing.tokenizer_path())
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = patterns.op12_pattern_packing(spark, SMALL).collect()
    used = check_pieces(rows, docs, lambda t: theirs.encode(t, add_special_tokens=False).ids, 4096)
    assert used <= 1 + -(-sum(r["length"] for r in rows) // 4096)


def test_odd_rows(spark, odd_docs):
    odd = odd_docs.selectExpr("*", "1 AS part", "2 AS number", "3 AS length", "4 AS before").repartition(3)
    rows = patterns.pattern_packed(odd, capacity=50).collect()
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] for r in rows)
    made = Counter((r["doc_id"], r["piece"]) for r in rows)
    assert {d for d, _ in made} == {1, 2, 3, 4, 5, None} and made[1, 0] == 2 and made[5, 0] == 1
    assert [r["ids"] for r in rows if r["doc_id"] in (3, 4)] == [[1], [1]]
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1 + -(-tokens // 50)
    assert patterns.pattern_packed(odd.limit(0)).collect() == []


def test_packing_does_not_hang_on_partitions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [patterns.pattern_packed(docs.repartition(n), with_ids=False).agg(F.countDistinct("sequence_id")).first()[0] for n in (1, 16)]
    assert counts[0] == counts[1]
