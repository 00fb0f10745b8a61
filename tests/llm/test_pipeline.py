"""Stages of the pipeline against plain versions, and its registration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from wattshed.llm import jaccard, queries, substrings, words
from wattshed.llm.common import staged, table
from tests.llm.test_text_operators import plain_groups, plain_passages, split

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SMALL, "documents")
    outs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(staged(stage(spark, outs[-1], SMALL), name))
    texts = [{r["doc_id"]: r["text"] or "" for r in o.select("doc_id", "text").collect()} for o in outs[:-1]]
    start, good, alone, cut, masked = texts
    assert set(good) < set(start)
    assert set(alone) == {d for d, (_, group) in plain_groups(good).items() if d == group}
    want = {d: (n, gone) for d, (n, gone, _) in plain_passages(alone, 50)}
    assert {d: len(split(t)) for d, t in cut.items()} == {d: n - gone for d, (n, gone) in want.items()}
    assert all(o.columns == docs.columns for o in outs[:-1])
    assert set(masked) == set(cut) and all("[SECRET]" in masked[d] for d in cut if masked[d] != cut[d])
    assert {r["doc_id"] for r in outs[-1].select("doc_id").collect()} == set(masked)


def test_names():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 14))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_get_small_batches(spark, name):
    """A batch holds 2 MB of texts, whatever the session had: tasks hold several batches at a time."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('some words ', 20000) AS text", "'en' AS lang", "'a' AS source")
    sizes = "bytes bigint"
    try:
        spark.conf.set(setting, "64m")
        dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL)
        got = docs.coalesce(1).mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["bytes"]) for b in bs), sizes)
        most = max(r["bytes"] for r in got.collect())
    finally:
        spark.conf.set(setting, before)
    assert most < 3 << 20


def batches_of(texts):
    """A batch for each text, as small batches come."""
    for i, text in enumerate(texts):
        yield pa.RecordBatch.from_pydict(
            {"doc_id": pa.array([i], pa.int64()), "text": pa.array([text], pa.string()), "tag": pa.array([0], pa.int32())}
        )


def test_blocks_whatever_the_batches():
    texts = ["abcd", None, "", "x" * 25, "efghij", "kl", "é", "m" * 10, "n"]
    for batches in (list(batches_of(texts)), [pa.concat_batches(list(batches_of(texts)))]):
        got = [b.column("doc_id").to_pylist() for b in words.blocks(batches, "text", 10)]
        assert got == [[0, 1, 2], [3], [4, 5, 6], [7], [8]]
    assert list(words.blocks([], "text", 10)) == []


def test_small_batches_settle_as_much():
    """What a task finds among its texts doesn't hang on the size of its batches."""
    text = " ".join(f"w{i}" for i in range(60))
    texts = [f"{text} end{i}" for i in range(5)]
    rows = pa.concat_batches(list(jaccard._facts(batches_of(texts))))
    shared = rows.filter(rows.column("shingle").is_valid())
    assert shared.num_rows == 56 and set(shared.column("n").to_pylist()) == {5}
    each = substrings._anchor_rows(50, substrings.PERIOD, substrings.COVER)
    sent = pa.concat_batches(list(each(batches_of(texts))))
    length = 50 - substrings.PERIOD + 1
    places = [p for p in range(61 - length + 1) if p % substrings.PERIOD in substrings.COVER]
    assert sent.filter(sent.column("known").is_null()).num_rows == len(places)


def test_shingles_beyond_what_is_held(monkeypatch):
    monkeypatch.setattr(jaccard, "HELD", 7)
    texts = ["a b c d e f g h i j k l", "a b c d e f g z", "a b c d e f g y"]
    rows = pa.concat_batches(list(jaccard._facts(batches_of(texts))))
    found = rows.filter(rows.column("shingle").is_valid()).column("n").to_pylist()
    assert all(n > 1 for n in found) and sum(found) <= 9
    assert rows.filter(rows.column("doc_id").is_valid()).column("n").to_pylist() == [8, 4, 4]


def test_hashes_in_pieces():
    """Spans over the edges of pieces hash as when they stand alone, from tables of bounded size."""
    values = np.random.default_rng(3).integers(0, 2**64, 5 * words.PIECE, dtype=np.uint64)
    powers = words.Powers(words.WORDS.base)
    start = np.arange(0, len(values) - 60, 7)
    got = powers.spans(values, start, start + 50)
    assert len(powers.up) <= 2 * words.PIECE
    for i in (0, 5, words.PIECE // 7, words.PIECE // 7 + 1, len(start) - 1):
        assert got[i] == powers.spans(values[start[i] : start[i] + 50], np.array([0]), np.array([50]))[0]
    whole = powers.spans(values, np.array([0]), np.array([len(values)]))
    with np.errstate(over="ignore"):
        up, _ = powers.upto(len(values))
        assert whole[0] == np.sum(values * up, dtype=np.uint64)
