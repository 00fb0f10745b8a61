"""Training examples from conversations: one for each assistant turn.

An example is the conversation up to and with that turn; only the reply itself
is trainable. Turns after the last reply go into a last example without
trainable text, so that the examples hold every turn. A task reads the turns of
its conversations in order and keeps one conversation's text at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattshed.llm.common import table

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that must not come from a text, as their first character and the rest.
CONTROLS = [(c[0], c[1:]) for c in (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")]
_BARE = "|".join(rf"(?<={re.escape(a)})(?=\\*{re.escape(b)})" for a, b in CONTROLS)
_GUARDED = "|".join(rf"(?<={re.escape(a)})\\(?=\\*{re.escape(b)})" for a, b in CONTROLS)
BARE, GUARDED = re.compile(_BARE), re.compile(_GUARDED)
#: Bytes of examples in an Arrow batch.
BATCH = 8 << 20

_EXAMPLES = "conv_id bigint, example int, text string, loss_start int, loss_end int"
_DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, n_examples bigint"
)


def escape(text: str) -> str:
    """Puts a backslash behind the first character of each control string.

    Control strings that already have backslashes there get one more, so unescape
    gives the text back whatever it holds.
    """
    return BARE.sub("\\\\", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return GUARDED.sub("", text) if "\\" in text else text


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Example:
    conv_id: int | None
    number: int
    text: str
    loss: tuple[int, int] | None

    def turns(self) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn, read back from the formatted text."""
        at = 0
        while at < len(self.text):
            line = self.text.index("\n", at)
            end = self.text.index(END, line)
            yield _unescape_role(self.text[at + len(START) : line]), unescape(self.text[line + 1 : end])
            at = end + len(END) + 1

    def target(self) -> str:
        return unescape(self.text[slice(*self.loss)]) if self.loss else ""


def format_conversation(conv_id: int | None, turns: Iterator[tuple[str, str]], trained: str = "assistant") -> Iterator[Example]:
    """The examples of one conversation, its turns in order."""
    parts: list[str] = []
    length, number, closed = 0, 0, False
    for role, text in turns:
        head, body = f"{START}{_escape_role(role)}\n", escape(text)
        parts.append(f"{head}{body}{END}\n")
        closed = role == trained
        if closed:
            begin = length + len(head)
            parts = ["".join(parts)]
            yield Example(conv_id, number, parts[0], (begin, begin + len(body)))
            number += 1
        length += len(head) + len(body) + len(END) + 1
    if parts and not closed:
        yield Example(conv_id, number, "".join(parts), None)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[Example]]]:
    for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
        yield conv_id, format_conversation(conv_id, ((r[1] or "", r[2] or "") for r in rows))


def _example_batches(batches):
    held, size = [], 0

    def flush():
        loss = [e.loss or (None, None) for e in held]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([e.conv_id for e in held], pa.int64()),
                pa.array([e.number for e in held], pa.int32()),
                pa.array([e.text for e in held], pa.string()),
                pa.array([x[0] for x in loss], pa.int32()),
                pa.array([x[1] for x in loss], pa.int32()),
            ],
            ["conv_id", "example", "text", "loss_start", "loss_end"],
        )

    for _, examples in _conversations(batches):
        for e in examples:
            held.append(e)
            size += len(e.text)
            if size > BATCH:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _digest_batches(batches):
    out = []
    names = [c.split()[0] for c in _DIGESTS.split(", ")[:5]] + ["formatted_chars", "n_examples"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for conv_id, examples in _conversations(batches):
        loss, loss_chars, chars, last, number = hashlib.sha256(), 0, 0, None, 0
        for last in examples:
            target = last.target()
            loss.update(target.encode())
            loss_chars += len(target)
            chars += len(last.text)
            number += 1
        turns, n_turns = hashlib.sha256(), 0
        for role, text in last.turns():
            turns.update(f"{role}\n{text}\n".encode())
            n_turns += 1
        out.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, number))
        if len(out) == 2000:
            yield flush()
            out = []
    if out:
        yield flush()


def _in_order(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    own = turns.select(
        turns[conv_id].cast("long").alias("conv_id"), turns[turn].alias("turn"),
        turns[role].alias("role"), turns[text].alias("text"),
    )
    return own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")


def prefix_examples(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end) of every conversation.

    The loss runs over characters loss_start to loss_end (exclusive) of text;
    NULL where a last example holds only turns after the last reply. NULL roles
    and texts are empty. Turns of one number stand in order of role and text,
    repeated rows are turns of their own, a NULL turn comes first. Rows without
    conv_id form one conversation.
    """
    return _in_order(turns, conv_id, turn, role, text).mapInArrow(_example_batches, _EXAMPLES)


def op2_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    # The digests are read back from each example as it is made; examples need not be shuffled for it.
    return _in_order(turns, "conv_id", "turn", "role", "text").mapInArrow(_digest_batches, _DIGESTS)
