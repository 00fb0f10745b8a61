"""Removal of passages that an earlier document already holds.

A passage is a window of WINDOW words. Only anchors are hashed and shuffled at
first: runs of WINDOW - PERIOD + 1 words that start at places whose remainder by
PERIOD is in a difference cover. For any two places i and j some step below
PERIOD takes both into the cover, so two equal windows, wherever they stand in
their documents, share at least one anchor at the same step. Words that no
shared anchor touches never leave their task. Shared anchors then extend: all
windows around them are hashed to 80 bits, and a window goes if the least
document with that hash is smaller than its own.

Each task first settles what it can among its own texts, so of a passage that a
third of all documents hold it sends one row for each block of texts, not one
for each document. Positions travel by document, texts are shuffled once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattshed.llm.common import free_name, table, with_struct
from wattshed.llm.features import keyed
from wattshed.llm.words import OTHERS, WORDS, Words, blocks, chunks, mix, windows, words_of

WINDOW = 50
#: A perfect difference set; each remainder is a difference of two of them.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Bytes of text among which a task settles equal windows before it shuffles.
BLOCK = 6 << 20

#: Layout of a row's last number: more bits of the hash, tag of the text, place.
PLACE_BITS, TAG_BITS = 32, 16
WITNESS, SETTLED = (1 << PLACE_BITS) - 1, (1 << PLACE_BITS) - 2

_ROWS = "hash bigint, doc_id bigint, rest bigint, known array<int>"


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by the keys, the first foremost, and group numbers by all but the last two."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), dtype=bool)
    for key in keys[:-2]:
        sorted_key = key[order]
        change[1:] |= sorted_key[1:] != sorted_key[:-1]
    return order, np.cumsum(change)


def _lists(owner: np.ndarray, place: np.ndarray, n: int) -> pa.Array:
    """Places of each owner as a list, in the order given."""
    order = np.argsort(owner, kind="stable")
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(np.bincount(owner, minlength=n), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(place[order].astype(np.int32)))


def _batch(hashes, ids, tags, owner, rest, settled_owner, settled_place) -> pa.RecordBatch:
    """Open rows (hash, document, rest), then one row a text with the places settled here."""
    holders = np.unique(settled_owner)
    lists = _lists(np.searchsorted(holders, settled_owner), settled_place, len(holders))
    spread = mix(ids[holders].astype(np.uint64) + np.uint64(7))
    rest = np.concatenate([rest, np.full(len(holders), SETTLED)]).astype(np.int64)
    who = np.concatenate([owner, holders])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([hashes, spread]).view(np.int64)),
            pa.array(ids[who]),
            pa.array(rest | tags[who].astype(np.int64) << PLACE_BITS),
            pa.concat_arrays([pa.nulls(len(owner), lists.type), lists]),
        ],
        ["hash", "doc_id", "rest", "known"],
    )


def _unsorted(flags: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Flags of sorted rows, in the order before the sort. Rows leave a task text by text,
    so that neighbours share most of their bytes."""
    out = np.zeros(len(flags), dtype=bool)
    out[order] = flags
    return out


def _first_of_text(group: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Flags of the first row that a text has in each group; a text sends no more, and what
    is found of one place holds for all equal places of the text."""
    first = np.ones(len(group), dtype=bool)
    first[1:] = (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])
    return first


def _anchors_of(words: Words, window: int, period: int, chosen: np.ndarray):
    """(first word, hash, text, place) of the anchors at chosen places of texts that hold a window."""
    length, n_words = window - period + 1, np.diff(words.first)
    place = np.arange(len(words.owner)) - words.first[words.owner]
    take = chosen[place % period] & (place + length <= n_words[words.owner]) & (n_words >= window)[words.owner]
    at = np.flatnonzero(take)
    return at, mix(WORDS.spans(words.hashes(), at, at + length)), words.owner[at], place[at]


def _with_equals(at: np.ndarray, hashes: np.ndarray, owner: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Those of at whose hash one of the found places of the same text has."""
    some = np.isin(owner, owner[np.searchsorted(at, found)])
    at, keys = at[some], keyed(hashes[some], owner[some])
    return at[np.isin(keys, keys[np.searchsorted(at, found)])]


def _windows_near(words: Words, found: np.ndarray, window: int, period: int, chosen: np.ndarray):
    """(hash, more bits of it, text, place) of all windows around the found anchors and their equals."""
    values = words.hashes()
    anchor, keys, owner, _ = _anchors_of(words, window, period, chosen)
    anchor = _with_equals(anchor, keys, owner, found)
    reach = np.zeros(len(values) + 1, dtype=np.int64)
    np.add.at(reach, np.maximum(anchor - period + 1, words.first[words.owner[anchor]]), 1)
    np.add.at(reach, anchor + 1, -1)
    at, h1 = windows(words, values, window)
    near = np.cumsum(reach)[at] > 0
    at, h1 = at[near], h1[near]
    h2 = mix(OTHERS.spans(mix(values ^ np.uint64(0x5851F42D4C957F2D)), at, at + window))
    owner = words.owner[at]
    return h1, h2 >> np.uint64(PLACE_BITS + TAG_BITS), owner, at - words.first[owner]


def _anchor_rows(window: int, period: int, cover: tuple[int, ...]):
    """Anchors that only one text of the block holds, one witness for each that several hold."""
    chosen = np.zeros(period, dtype=bool)
    chosen[list(cover)] = True

    def each(batches):
        for batch in blocks(batches, "text", BLOCK):
            ids, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            found = []
            for lo, _, data, offsets in chunks(batch.column("text")):
                _, keys, owner, place = _anchors_of(words_of(data, offsets), window, period, chosen)
                found.append((keys, owner + lo, place))
            if not found:
                continue
            keys, owner, place = (np.concatenate(x) for x in zip(*found, strict=True))
            order, group = _groups(keys, ids[owner], owner)
            first = np.flatnonzero(np.diff(group, prepend=-1))
            who = owner[order]
            last = np.append(first[1:], len(group)) - 1
            shared = (ids[who[first]] != ids[who[last]])[group] if len(group) else np.zeros(0, dtype=bool)
            fresh = _first_of_text(group, who)
            witness = np.zeros(len(group), dtype=bool)
            witness[first] = True
            witness &= shared
            marked = np.where(_unsorted(witness, order), WITNESS, place)
            sent = _unsorted(fresh & ~shared | witness, order)
            shared = _unsorted(fresh & shared, order)
            yield _batch(keys[sent], ids, tags, owner[sent], marked[sent], owner[shared], place[shared])

    return each


def _window_rows(window: int, period: int, cover: tuple[int, ...], doc_id: str, tag: str, text: str, anchors: str):
    """Hashes of windows around shared anchors; of equal ones in the block the least document's."""
    chosen = np.zeros(period, dtype=bool)
    chosen[list(cover)] = True

    def each(batches):
        held = (batch.filter(batch.column(anchors).is_valid()) for batch in batches)
        for batch in blocks(held, text, BLOCK):
            ids = batch.column(doc_id).cast(pa.int64()).to_numpy()
            tags = batch.column(tag).to_numpy()
            found = []
            for lo, hi, data, offsets in chunks(batch.column(text)):
                words = words_of(data, offsets)
                lists = batch.column(anchors).slice(lo, hi - lo)
                owner = np.repeat(np.arange(hi - lo), lists.value_lengths().to_numpy())
                h1, h2, owner, place = _windows_near(
                    words, words.first[owner] + lists.flatten().to_numpy(), window, period, chosen
                )
                found.append((h1, h2, owner + lo, place))
            if not found:
                continue
            h1, h2, owner, place = (np.concatenate(x) for x in zip(*found, strict=True))
            order, group = _groups(h1, h2, ids[owner], owner)
            first = np.flatnonzero(np.diff(group, prepend=-1))
            who = owner[order]
            later = ids[who] > ids[who[first]][group] if len(group) else np.zeros(0, dtype=bool)
            fresh = _first_of_text(group, who)
            sent, later = _unsorted(fresh & ~later, order), _unsorted(fresh & later, order)
            rest = place | (h2 << np.uint64(PLACE_BITS + TAG_BITS)).view(np.int64)
            yield _batch(h1[sent], ids, tags, owner[sent], rest[sent], owner[later], place[later])

    return each


def _place() -> Column:
    return F.col("rest").bitwiseAND(WITNESS)


def _by_document(rows: DataFrame) -> DataFrame:
    """(doc_id, tag, places): single places and those settled in tasks, of each document."""
    tag = F.shiftright("rest", PLACE_BITS).bitwiseAND((1 << TAG_BITS) - 1).cast("int")
    single = F.when(F.col("known").isNull() & (_place() != WITNESS), _place().cast("int"))
    return (
        rows.select("doc_id", tag.alias("tag"), single.alias("place"), "known")
        .groupBy("doc_id", "tag")
        .agg(F.array_distinct(F.concat(F.collect_list("place"), F.flatten(F.collect_list("known")))).alias("places"))
    )


def shared_anchors(keyed: DataFrame, window: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """(doc_id, tag, places): starts of the anchors that several doc_ids hold."""
    anchors = keyed.where("doc_id is not null and text is not null").mapInArrow(
        _anchor_rows(window, period, cover), _ROWS
    )
    same = Window.partitionBy("hash")
    seen = F.max(_place()).over(same) == WITNESS
    shared = anchors.withColumns(
        {"several": (F.min("doc_id").over(same) < F.max("doc_id").over(same)) | seen}
    ).where("known is not null or several")
    return _by_document(shared)


def repeated_windows(hashed: DataFrame) -> DataFrame:
    """(doc_id, tag, places): starts of the windows that a smaller doc_id also holds."""
    same = Window.partitionBy("hash", F.shiftrightunsigned("rest", PLACE_BITS + TAG_BITS))
    least = hashed.repartition("hash").withColumn("least", F.min("doc_id").over(same))
    return _by_document(least.where("known is not null or doc_id > least"))


def _kept(window: int):
    """Adds the text left, its word counts and the digest of its words."""

    def each(batch: pa.RecordBatch, text: str, places: str) -> pa.Array:
        out: list[list] = [[], [], [], []]
        for lo, hi, data, offsets in chunks(batch.column(text)):
            words = words_of(data, offsets)
            lists = batch.column(places).slice(lo, hi - lo)
            owner = np.repeat(np.arange(hi - lo), lists.fill_null([]).value_lengths().to_numpy())
            at = words.first[owner] + lists.flatten().to_numpy().astype(np.int64)
            if len(at):
                starts, hashes = windows(words, words.hashes(), window)
                at = _with_equals(starts, hashes, words.owner[starts], at)
            cover = np.zeros(len(words.start) + window + 1, dtype=np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover)[: len(words.start)] > 0
            cut = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(cut, words.start[gone], 1)
            ends = np.append(words.start[1:], len(data))[gone]
            ends = np.minimum(ends, offsets[1:][words.owner[gone]])
            np.add.at(cut, ends, -1)
            stays = np.cumsum(cut)[: len(data)] == 0
            n_gone = np.bincount(words.owner[gone], minlength=hi - lo)
            for i in range(hi - lo):
                raw = data[offsets[i] : offsets[i + 1]]
                left = raw[stays[offsets[i] : offsets[i + 1]]].tobytes() if n_gone[i] else raw.tobytes()
                out[0].append(left)
                out[1].append(int(words.first[i + 1] - words.first[i]))
                out[2].append(int(n_gone[i]))
                out[3].append(hashlib.sha256(b" ".join(left.split())).hexdigest())
        return pa.StructArray.from_arrays(
            [
                pa.array(out[0], pa.binary()).cast(pa.string()),
                pa.array(out[1], pa.int64()),
                pa.array(out[2], pa.int64()),
                pa.array(out[3], pa.string()),
            ],
            ["text", "n_words", "n_removed", "kept_sha256"],
        )

    return each


_KEPT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    period: int = PERIOD,
    cover: tuple[int, ...] = COVER,
) -> tuple[DataFrame, str]:
    """docs with a struct more, and its name: text left, n_words, n_removed, kept_sha256.

    A word goes if a window of that many words covers it which also starts in a
    document with a smaller doc_id; windows are judged on the input. Words go
    with the white space behind them; a text that loses none stays as it is.
    Rows that repeat a doc_id are no smaller than one another, so neither loses
    words to the other. A NULL doc_id takes and loses nothing. A NULL text is
    empty. Columns of docs keep their names: the struct takes one that is free.
    """
    if not 0 < period <= window:
        raise ValueError("the period must be at most the window")
    tag = (F.crc32(F.col(text).cast("binary")) % 65536).cast("int")
    name, places, tag_name = free_name(docs, "kept"), free_name(docs, "places"), free_name(docs, "tag")
    tagged = docs.withColumn(tag_name, tag)

    def beside(found: DataFrame) -> DataFrame:
        """tagged with the places found. Both joins take the same rows and columns from
        docs, so that Spark shuffles the texts once and reads that shuffle twice."""
        theirs = found.select(
            F.col("doc_id").alias(f"{name}_id"), F.col("tag").alias(f"{name}_tag"), F.col("places").alias(places)
        )
        same = (tagged[doc_id] == theirs[f"{name}_id"]) & (tagged[tag_name] == theirs[f"{name}_tag"])
        return tagged.join(theirs, same, "left").select(*[tagged[c] for c in tagged.columns], places)

    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), tag.alias("tag"), F.col(text).alias("text"))
    near = beside(shared_anchors(keyed, window, period, cover))
    hashed = near.mapInArrow(_window_rows(window, period, cover, doc_id, tag_name, text, places), _ROWS)
    met = beside(repeated_windows(hashed)).select(*docs.columns, places)
    kept = _kept(window)
    return with_struct(met, name, _KEPT, lambda batch: kept(batch, text, places)), name


def cut_repeats(docs: DataFrame, **how) -> DataFrame:
    """docs with repeated passages cut from text; n_chars, where there, follows."""
    left, name = without_repeats(docs, **how)
    text = how.get("text", "text")
    new = F.when(F.col(text).isNotNull(), F.col(f"{name}.text"))
    picked = {text: new} | ({"n_chars": F.length(new).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return left.select(*[picked[c].alias(c) if c in picked else F.col(c) for c in docs.columns])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left, name = without_repeats(docs)
    return left.select("doc_id", f"{name}.n_words", f"{name}.n_removed", f"{name}.kept_sha256")
