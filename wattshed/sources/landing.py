"""Worksheets landed as CSV, staged as cells with their exact worksheet rows.

A sheet is a folder ``workbook=<name>/sheet=<name>`` of CSV text, in one file or in
several whose names are in the order of the rows. Spark cuts large files into
blocks and reads them in parallel, so no task knows how many rows, or how many open
quotes, lie before its own. Both are prefix sums: a first pass gives one row for
each block (whether it turns an open quote into a closed one, and how many rows
begin in it either way), a window over these gives what each block takes over, and a
second pass numbers and splits the rows where they are. Only a row that a block
cuts in two is put together in a shuffle.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_folder

_SHEET = "workbook string, sheet string"
_BLOCKS = f"{_SHEET}, file string, block bigint, turns int, begun_closed bigint, begun_open bigint"
_PIECES = f"{_SHEET}, row bigint, col int, value string, file string, block bigint"
#: Blocks of all files together whose start is sent to every executor: some 100 MB,
#: for 128 TB of text in Spark's usual blocks.
MOST_BLOCKS = 1_000_000


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    text = spark.read.schema(f"value string, {_SHEET}").option("lineSep", "\n").text(folder)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        "workbook",
        "sheet",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (quotes % 2).cast("int").alias("odd"),
        "value",
    )


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Runs of lines of one block."""
    if not batch.num_rows:
        return
    block = batch.column("block").to_numpy()
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    new = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
    edges = [0, *new.tolist(), batch.num_rows]
    yield from zip(edges, edges[1:], strict=False)


def _key(batch: pa.RecordBatch, at: int) -> tuple:
    return tuple(batch.column(c)[at].as_py() for c in ("workbook", "sheet", "file", "block"))


def _open_before(odd: np.ndarray, start: int) -> np.ndarray:
    """Whether a quote is open before each line."""
    return (np.cumsum(odd) - odd + start) % 2


def _summaries(batches):
    """A row for each block: its lines come one behind the other in one task."""
    done: list[tuple] = []
    held: list = []

    def put():
        if held:
            done.append((*held[0], *held[1:]))

    for batch in batches:
        odd = batch.column("odd").to_numpy()
        for a, b in _segments(batch):
            key = _key(batch, a)
            if not held or held[0] != key:
                put()
                held[:] = [key, 0, 0, 0]
            is_open = _open_before(odd[a:b], held[1])
            held[1] = int(is_open[-1] + odd[b - 1]) % 2
            held[2] += int((is_open == 0).sum())
            held[3] += int((is_open == 1).sum())
    put()
    if done:
        kinds = [pa.string()] * 3 + [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        columns = zip(*done, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _names(_BLOCKS))


def _blocks(lines: DataFrame, most: int) -> DataFrame:
    """(file, block, opened, rows_before): what each block takes over from those before it."""
    summaries = lines.select("workbook", "sheet", "file", "block", "odd").mapInArrow(_summaries, _BLOCKS)
    path = scratch_folder(lines.sparkSession, "blocks")
    summaries.write.parquet(path)
    summaries = lines.sparkSession.read.schema(summaries.schema).parquet(path)
    order = W.partitionBy("workbook", "sheet").orderBy("file", "block")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    opened = summaries.withColumn("opened", (F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2).cast("int"))
    begun = F.when(F.col("opened") == 0, F.col("begun_closed")).otherwise(F.col("begun_open"))
    before = opened.withColumn("rows_before", F.coalesce(F.sum(begun).over(earlier), F.lit(0)))
    few = before.select("file", "block", "opened", "rows_before").limit(most + 1)
    count = F.count(F.lit(1)).over(W.partitionBy(F.lit(0)))
    too_many = F.raise_error(F.lit(f"more than {most} blocks: raise spark.sql.files.maxPartitionBytes"))
    return few.withColumn("opened", F.when(count > most, too_many.cast("int")).otherwise(F.col("opened")))


def _batch(key: tuple, rows: list[int], cols: list[int], values: list[str], piece: bool) -> pa.RecordBatch:
    n = len(rows)
    same = lambda v, kind: pa.repeat(pa.scalar(v, kind), n)
    columns = [
        same(key[0], pa.string()), same(key[1], pa.string()), pa.array(rows, pa.int64()), pa.array(cols, pa.int32()),
        pa.array(values, pa.string()), same(key[2] if piece else None, pa.string()), same(key[3] if piece else None, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, _names(_PIECES))


def _split(key: tuple, number: int, texts: list[str]) -> pa.RecordBatch:
    """Cells of rows from number on; a blank line has none."""
    csv.field_size_limit(2**31 - 1)
    rows, cols, values = [], [], []
    for i, text in enumerate(texts, number):
        fields = next(csv.reader([text.removesuffix("\r")]), [])
        given = [c for c, v in enumerate(fields, 1) if v]
        rows += [i] * len(given)
        cols += given
        values += fields if len(given) == len(fields) else [v for v in fields if v]
    return _batch(key, rows, cols, values, False)


class _Block:
    """One block's lines, as they come; ``held`` is the row that may still go on."""

    def __init__(self, key: tuple, opened: int, rows_before: int):
        self.key, self.is_open, self.number = key, opened, rows_before
        self.cut = bool(opened)  # held began in a block before
        self.held: list[str] = []

    def add(self, odd: np.ndarray, lines: list[str]) -> Iterator[pa.RecordBatch]:
        opens = _open_before(odd, self.is_open)
        starts = np.flatnonzero(opens == 0).tolist()
        self.is_open = int(opens[-1] + odd[-1]) % 2
        self.held += lines[: starts[0]] if starts else lines
        if not starts:
            return
        if self.held:
            yield self.settled(self.cut)
        ends = [*starts[1:], len(lines)]
        texts = ["\n".join(lines[i:j]) if j - i > 1 else lines[i] for i, j in zip(starts, ends, strict=True)]
        if len(texts) > 1:
            yield _split(self.key, self.number + 1, texts[:-1])
        self.number += len(texts)
        self.held, self.cut = lines[starts[-1] :], False

    def settled(self, piece: bool) -> pa.RecordBatch:
        text = "\n".join(self.held)
        if piece:
            return _batch(self.key, [self.number], [0], [text], True)
        return _split(self.key, self.number, [text])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self.settled(self.cut or bool(self.is_open))


def _number(batches):
    """Cells of whole rows, and the pieces of rows that a block's edges cut."""
    block: _Block | None = None
    for batch in batches:
        odd, values = batch.column("odd").to_numpy(), batch.column("value").to_pylist()
        for a, b in _segments(batch):
            key = _key(batch, a)
            if block is None or block.key != key:
                if block is not None:
                    yield from block.end()
                block = _Block(key, batch.column("opened")[a].as_py(), batch.column("rows_before")[a].as_py())
            yield from block.add(odd[a:b], values[a:b])
    if block is not None:
        yield from block.end()


def _whole_pieces(batches):
    for batch in batches:
        for workbook, sheet, number, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            yield _split((workbook, sheet), number, [text])


def landed_cells(spark: SparkSession, folder: str, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``cells(workbook, sheet, row, col, value)`` of every sheet landed under folder, rows and columns from 1.

    Doubled quotes, delimiters and line breaks in quoted cells are read as such, and
    a row with line breaks is one worksheet row. Blank lines are blank rows, which
    count; empty cells are absent. The cells are written once under the checkpoint
    folder and read from there.
    """
    lines = _lines(spark, folder)
    numbered = lines.join(F.broadcast(_blocks(lines, most_blocks)), ["file", "block"])
    path = scratch_folder(spark, "cells")
    found = numbered.mapInArrow(_number, _PIECES)
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    names = ["workbook", "sheet", "row", "col", "value"]
    parts = F.sort_array(F.collect_list(F.struct("file", "block", "value")))
    joined = (
        found.where("col = 0")
        .groupBy("workbook", "sheet", "row")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
        .mapInArrow(_whole_pieces, _PIECES)
    )
    return found.where("col > 0").unionByName(joined).select(*names)


def land_sheets(rows: DataFrame, folder: str, order: list[str], cells: list[str]) -> None:
    """Rows to landed sheets: columns ``workbook`` and ``sheet``, an order within a sheet, and the cells.

    A hot sheet is written by many tasks, in files whose names are in order. A row
    whose cells are all NULL is a blank line.
    """
    options = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cells)]), options)
    blank = F.coalesce(*[F.col(c).cast("string") for c in cells]).isNull()
    keys = ["workbook", "sheet", *order]
    dealt = rows.select(*keys, F.when(blank, "").otherwise(line).alias("value")).repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).select("workbook", "sheet", "value").write.partitionBy("workbook", "sheet").text(folder)
