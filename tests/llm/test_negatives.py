"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from wattshed.llm import negatives as hn

SMALL = "/root/testdata/sf0.01"


def plain(rows, every=100, positives=5, least=80):
    """rows: (id, vector, label), none twice; the SQL's meaning, pair by pair."""
    whole = []
    for i, v, y in rows:
        if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(256 * x) for x in v], y))
    out = []
    for i, v, y in whole:
        if i % every:
            continue
        met = [(-sum(map(int.__mul__, v, w)), j, z) for j, w, z in whole if j != i and len(w) == len(v)]
        for p, j, _ in sorted(m for m in met if m[2] == y)[:positives]:
            hard = sorted(m[:2] for m in met if m[2] != y and least * -p <= 100 * -m[0] <= 100 * -p)[:5]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(hard, 1)]
    return sorted(out)


def made(seed, n, width=24, near=0.9):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(width)
    rows = []
    for i in range(n):
        v = near * centre + (1 - near) * rng.standard_normal(width)
        rows.append((i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(0, 4))))
    return rows


def run(spark, rows, every=100, **more):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    frame = frame.selectExpr("*", "1 AS anchor", "2 AS level", "3 AS score")
    return sorted(map(tuple, hn.hard_negatives(frame, frame["vec_id"] % every == 0, **more).collect()))


@pytest.mark.parametrize("block", [3, 8192])
def test_pairs_match_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(hn, "FIRST", 20)
    rows = made(1, 900)
    got = run(spark, rows, every=60, block=block)
    assert got == plain(rows, every=60) and len(got) > 100


@pytest.mark.parametrize("width", [1, 3, 63, 64, 65, 130])
def test_intervals_hold_the_score(width):
    rng = np.random.default_rng(width)
    ints = rng.integers(-300, 300, (200, width))
    ints[0] = 0
    turned = ints @ hn.rotation(width)
    words = hn._words(turned >= 0).reshape(200, -1)
    length, alignment = np.sqrt((ints * ints).sum(axis=1)), np.abs(turned).sum(axis=1) / math.sqrt(width)
    residual = np.sqrt(np.maximum(length**2 - alignment**2, 0))
    rows = hn.Rows(np.arange(200), np.zeros(200, dtype=np.int64), ints, words, np.bitwise_count(words).sum(axis=1, dtype=np.int32), length, alignment, residual)
    low, high = hn.Queries(np.arange(200), rows).intervals(np.arange(200), rows)
    score = ints @ ints.T
    assert ((low <= score) & (score <= high)).all()
    # The interval does rule pairs out: it is narrower than what lengths alone allow.
    assert (high - low).mean() < 2 * np.outer(length, length).mean()


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "FIRST", 4)
    rng = random.Random(0)
    rows = [(i, [float(rng.randrange(-1, 2)) / 4 for _ in range(4)], rng.randrange(2)) for i in range(160)]
    same = [0.5, 0.25, -0.5, 1.0]
    rows += [(i, same, i % 3) for i in range(200, 400)]
    odd = [
        (400, None, 1), (500, [], 1), (600, [None, 1.0, 1.0, 1.0], 1), (700, [math.nan, 1.0, 1.0, 1.0], 1), (800, [math.inf, 1.0, 1.0, 1.0], 1),
        (900, same, None), (None, same, 1), (1000, [1.0, 1.0], 1), (1001, [1.0, 0.9], 1), (1002, [0.9, 1.0], 2), (1100, [-1.0, 0.0, 0.0, 0.0], 0),
    ]
    want = plain(rows + odd, every=20)
    assert run(spark, rows + odd, every=20) == want and run(spark, rows + odd + rows[:50] + odd, every=20) == want
    assert hn.hard_negatives(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int"), hn.F.lit(True)).collect() == []
    assert run(spark, [r for r in rows if r[0] % 20], every=20) == []


def test_vectors_too_large_for_a_score_take_no_part(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 1.0], 0), (2, [1.0, 1.0], 0), (3, [1.0, 1.0], 1), (100, [1.0, 1.0], 0)]
    assert run(spark, rows) == [(100, 2, 1, 3, 131072, 131072)]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    assert sorted(map(tuple, hn.op11_hard_negatives(spark, SMALL).collect())) == plain(moved)
