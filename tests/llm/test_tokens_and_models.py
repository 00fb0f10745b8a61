"""Encoding, packing, chat, search, pages, toxicity: round trips, plain versions, held-out rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattshed.llm import bpe, chat, hamming, packing, pages, toxicity
from wattshed.llm.lstm import BiLstm
from wattshed.llm.words import chunks

SMALL = "/root/testdata/sf0.001"
ODD = [
    "don't can't we'll they're 'sting it'sx 'S ''s 'l 'll", "  a  b\n\nc \t d   ", "", "  ", "x<|endoftext|>  y<|endoftext|>",
    " <|endoftext|> 's", "日本語テキスト 12³ ½ Ⅷ", "é  nb  sp\u0085x", "a" * 3000, "🙂🙂 🙂", "'re've", " 'd 'x", "<|ENDOFTEXT|> A.", "İ ſ K Å ≠",
]


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def noise(n):
    rng = random.Random(3)
    pool = list("abst'relvdm  \n\t1²!.é日  <|") + ["ll", "'re", "the"]
    return ["".join(rng.choices(pool, k=40)) for _ in range(n)]


def test_ids_match_the_library_and_decode_back():
    path = bpe.tokenizer_path()
    coder, theirs, texts = bpe.Encoder(path), library(path), ODD + noise(1500)
    expected = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    for remember in (True, False):
        for lo, hi, data, offsets in chunks(pa.array(texts), 5000):
            ids, begins = coder.encode(data, offsets, remember)
            assert np.array_equal(coder.decode(ids), data)
            for i in range(hi - lo):
                assert ids[begins[i] : begins[i + 1]].tolist() == expected[lo + i], texts[lo + i]


def test_encoding_query(spark):
    theirs = library(bpe.tokenizer_path())
    got = {r["doc_id"]: r for r in bpe.op6_bpe_prefixes(spark, SMALL).collect()}
    for doc in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = theirs.encode(doc["text"] or "", add_special_tokens=False).ids
        r = got[doc["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_word_coder_matches_the_library():
    path = packing.tokenizer_path()
    coder, theirs, texts = packing.WordCoder(path), library(path), ODD + noise(800)
    for lo, hi, data, offsets in chunks(pa.array(texts), 5000):
        ids, begins = coder.encode(data, offsets)
        for i in range(hi - lo):
            want = theirs.encode(texts[lo + i], add_special_tokens=False).ids + [packing.END_OF_TEXT]
            assert ids[begins[i] : begins[i + 1]].tolist() == want, texts[lo + i]


def test_packing_query(spark):
    theirs = library(packing.tokenizer_path())
    rows = packing.op9_min_slack_packing(spark, SMALL).toPandas()
    by_doc = dict(tuple(rows.sort_values("start").groupby("doc_id")))
    for doc in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = np.array(theirs.encode(doc["text"] or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for p in by_doc[doc["doc_id"]].itertuples():
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == (s["length"].cumsum() - s["length"]).tolist() and s["length"].sum() <= 4096


@pytest.mark.parametrize("seed", range(20))
def test_fill_comes_as_close_as_any_choice(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(rng.integers(1, 4)) for n in rng.integers(3, 60, 5)}
    space = int(rng.integers(10, 150))
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    chosen = packing.fill(space, sorted(counts, reverse=True), counts)
    assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= space)
    assert all(chosen[k] <= counts[k] for k in chosen)


def test_odd_rows_are_encoded_and_packed(odd_docs):
    coded, name = bpe.encoded(odd_docs)
    rows = {r["doc_id"]: r for r in coded.select("doc_id", f"{name}.ids", f"{name}.decoded", "text").collect()}
    assert all(r["decoded"] == (r["text"] or "") for r in rows.values()) and rows[3]["ids"] == []
    pieces = packing.packed(odd_docs).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"] for r in pieces} == {1, 2, 3, 4, 5, None}
    assert packing.packed(odd_docs.limit(0)).collect() == [] and bpe.encoded(odd_docs.limit(0))[0].collect() == []


def test_escapes_round_trip():
    rng = random.Random(1)
    parts = ["<", "|", "im_end|>", "\\", "s>", "/s>", "[", "INST]", "/INST]", "|im_start|>", "a", "\n", "<s>", "[INST]"]
    for _ in range(3000):
        x = "".join(rng.choices(parts, k=8))
        assert chat.unescape(chat.escape(x)) == x
        assert not any(a + b in chat.escape(x) for a, b in chat.CONTROLS)
        turns = [(x, x), ("assistant", x), (x, "")]
        examples = list(chat.format_conversation(1, iter(turns)))
        assert list(examples[-1].turns()) == turns and examples[0].target() == x


def test_chat_query_and_examples(spark):
    got = {r["conv_id"]: r for r in chat.op2_prefix_targets(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect()
    convs: dict = {}
    for r in rows:
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    convs[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(convs)
    for k, turns in convs.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[k]["n_turns"] == len(turns) and got[k]["loss_chars"] == len(loss)
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[k]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    frame = spark.createDataFrame(
        [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, "user", None), (None, None, None, None), (1, 3, "user", None)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    examples = chat.prefix_examples(frame).where("conv_id = 1").orderBy("example").collect()
    assert [e["loss_start"] is None for e in examples] == [False, True]
    assert examples[0]["text"][examples[0]["loss_start"] : examples[0]["loss_end"]] == "b"
    assert chat.prefix_examples(frame.limit(0)).collect() == []


def plain_nearest(ids, vectors, k):
    signs = vectors >= 0
    for q in np.flatnonzero(ids % 20 == 0):
        far = (signs != signs[q]).sum(axis=1)
        order = np.lexsort((ids, far))[:k]
        yield from ((int(ids[q]), r + 1, int(ids[i]), int(far[i])) for r, i in enumerate(order))


@pytest.mark.parametrize("shard", [37, 1 << 16])
def test_nearest_match_brute_force(spark, shard):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").toArrow()
    ids, vectors = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist())
    copies = [(int(i) + 10_000, v.tolist()) for i, v in zip(ids[:3], vectors[:3], strict=True)] * 2
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)] + copies, "vec_id bigint, embedding array<double>")
    got = hamming.nearest(frame, frame.where("vec_id % 20 = 0"), shard=shard, block=9).collect()
    more = np.concatenate([ids, ids[:3] + 10_000])
    assert sorted(map(tuple, got)) == sorted(plain_nearest(more, np.concatenate([vectors, vectors[:3]]), hamming.K))


def test_nearest_counts_an_id_with_several_codes_once(spark):
    flipped = lambda n: [-1.0] * n + [1.0] * (32 - n)
    rows = [(1, flipped(0)), (1, flipped(1)), (1, flipped(2)), (2, flipped(5)), (3, flipped(9)), (3, flipped(6))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(20, flipped(0))], frame.schema)
    got = hamming.nearest(frame, asked, k=3).collect()
    assert sorted(map(tuple, got)) == [(20, 1, 1, 0), (20, 2, 2, 5), (20, 3, 3, 6)]


def test_nearest_of_odd_rows(spark):
    frame = spark.createDataFrame(
        [(20, [1.0, -1.0]), (1, [1.0]), (2, None), (3, []), (None, [1.0, 1.0]), (4, [None, 1.0]), (5, [-1.0, -1.0])],
        "vec_id bigint, embedding array<double>",
    )
    got = hamming.nearest(frame, frame.where("vec_id = 20")).collect()
    assert sorted(map(tuple, got)) == [(20, 1, 20, 0), (20, 2, 5, 1)]
    assert hamming.nearest(frame.limit(0), frame.limit(0)).collect() == []


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = BiLstm(3, 2, 1)
    net.params = [p.astype(np.float64) for p in net.params]
    x, mask = rng.standard_normal((4, 2, 3)), np.array([[1, 1], [1, 1], [1, 0], [1, 0.0]])
    y = rng.integers(0, 2, (4, 2)).astype(float)
    grads = net.gradients(x, mask, y)[1]
    for p, g in zip(net.params, grads, strict=True):
        for i in np.ndindex(p.shape):
            old = p[i]
            p[i] = old + 1e-3
            up = net.gradients(x, mask, y)[0]
            p[i] = old - 1e-3
            down = net.gradients(x, mask, y)[0]
            p[i] = old
            assert abs((up - down) / 2e-3 - g[i]) < 1e-3


def test_leaves_of_broken_markup():
    html = '<nav><a href=x>Home</a></nav><div class="post"><p>One &amp; two<br>three <b>x<p>four<ul><li>a<li>b</ul>tail</div><script>"</p>"</script><!-- c'
    assert [(leaf.text, leaf.linked) for leaf in pages.leaves(html)] == [("Home", 4), ("One & two three x", 0), ("four", 0), ("a", 0), ("b", 0), ("tail", 0)]
    assert pages.leaves("") == [] and pages.leaves("<p><p></p>") == []


def test_main_text_of_held_out_pages(spark):
    rows, name = pages.extracted(spark.read.parquet(f"{SMALL}/pages.parquet"), train_pages=20)
    got = rows.select("html", f"{name}.text").collect()
    want = ["\n\n".join(leaf.text for leaf in pages.leaves(r["html"]) if "article" in leaf.path) for r in got]
    assert sum(w == r["text"] for w, r in zip(want, got, strict=True)) >= 0.95 * len(got)


def test_made_up_pages_are_told_apart():
    net = pages.train([], made=600)
    rng = np.random.default_rng(77)
    right = total = 0
    for _ in range(100):
        page, labels = pages._made(rng, ["A longer sentence stands here, with a stop."], ["Home", "More"])
        x, mask = pages.padded(pages.vectors([page]), [len(page)])
        right += ((net.scores(x, mask)[:, 0] >= 0.5) == np.array(labels)).sum()
        total += len(labels)
    assert right / total > 0.95


def test_odd_pages(spark):
    frame = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (2, None, "", "x"), (None, "u", "<p>", None)], "page_id bigint, url string, html string, main string")
    rows, name = pages.extracted(frame)
    assert rows.columns == [*frame.columns, name] and {r[name]["text"] for r in rows.collect()} == {""}
    assert pages.extracted(frame.limit(0))[0].collect() == []


def test_label_model_finds_bad_and_copied_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    good = [np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.05) for _ in range(4)]
    copies = [good[0].copy() for _ in range(3)]
    bad = [rng.random(4000) < 0.3]
    votes = np.stack(good + copies + bad, axis=1)
    model = toxicity.fit_label_model(votes, np.where(votes[:, :4].sum(axis=1) > 1, 0.9, 0.1))
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95
    assert abs(model.weights[-1]) < 0.2 * model.weights[1]
    assert model.weights[0] < 0.8 * model.weights[1] and model.correlations[0, 4] > 0.9


def test_toxicity_of_held_out_rows(spark):
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(300)]
    rude = ["scoundrel", "villain", "rascal", "knave"]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = rng.choices(plain, k=40) + (rng.sample(rude, 2) if toxic else [])
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(5000, None), (5001, ""), (None, "villain rascal"), (5002, "villain, RASCAL!")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("toxicity", F.lit(1))
    given = spark.createDataFrame(labels, "doc_id bigint, label int")
    weights, bias, _ = toxicity.train(frame.select("doc_id", "text"), given.where(~toxicity.held_out()))
    rows, name = toxicity.scored(frame, weights, bias)
    got = {r["doc_id"]: r[name] for r in rows.collect()}
    assert all((got[i]["predicted"] == 1) == bool(y) for i, y in labels)
    assert got[5000]["predicted"] == got[5001]["predicted"] == 0 and got[5002]["predicted"] == got[None]["predicted"] == 1
    nothing = toxicity.train(frame.select("doc_id", "text").limit(0), given.limit(0))
    assert toxicity.scored(frame.limit(0), *nothing[:2])[0].collect() == []
