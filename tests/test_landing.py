"""Sheets landed as CSV against Python's own reader, whatever the blocks."""

from __future__ import annotations

import csv
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattshed.sources import landing as ld


def wanted(folder: Path):
    out = []
    for sheet in sorted(folder.glob("workbook=*/sheet=*")):
        text = "".join(p.read_bytes().decode() for p in sorted(sheet.glob("*.csv")))
        book, name = sheet.parent.name.split("=", 1)[1], sheet.name.split("=", 1)[1]
        for i, fields in enumerate(csv.reader(text.splitlines(keepends=True)), 1):
            out += [(book, name, i, c, v) for c, v in enumerate(fields, 1) if v]
    return sorted(out)


def sheet_text(rng, n, end="\n"):
    parts = ["a", "é🙂", ",", '""', "\n", " ", "b\nc", "x" * 30]
    lines = []
    for _ in range(n):
        fields = []
        for _ in range(rng.randrange(5)):
            body = "".join(rng.choices(parts, k=rng.randrange(4)))
            fields.append(f'"{body}"' if any(c in body for c in ',"\n') or rng.random() < 0.2 else body)
        lines.append(",".join(fields))
    return end.join(lines) + end * (rng.random() < 0.5)


@pytest.mark.parametrize(("block", "lines"), [("37", 12), ("600", 60), ("128m", 60)])
def test_rows_are_exact_whatever_the_blocks(spark, tmp_path, block, lines):
    rng = random.Random(4)
    for book, name, files in (("a", "2022", 1), ("a", "LA - Sites 2014", 3), ("b c", "2022", 2)):
        sheet = tmp_path / f"workbook={book}" / f"sheet={name}"
        sheet.mkdir(parents=True)
        for i in range(files):
            text = sheet_text(rng, lines)
            (sheet / f"part-{i:03}.csv").write_bytes((text.rstrip("\n") + "\n").encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if block != "128m" else before["spark.sql.files.openCostInBytes"])
        got = ld.landed_cells(spark, str(tmp_path))
        assert got.dtypes == [("workbook", "string"), ("sheet", "string"), ("row", "bigint"), ("col", "int"), ("value", "string")]
        assert sorted(map(tuple, got.collect())) == wanted(tmp_path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_row_over_many_blocks(spark, tmp_path):
    sheet = tmp_path / "workbook=w" / "sheet=s"
    sheet.mkdir(parents=True)
    long = "\n".join(f"line {i}" for i in range(200))
    (sheet / "a.csv").write_text(f'head,"{long}",x\n\n"{long}"\nlast,1\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = sorted(tuple(r)[2:] for r in ld.landed_cells(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", "4194304")
    assert got == [(1, 1, "head"), (1, 2, long), (1, 3, "x"), (3, 1, long), (4, 1, "last"), (4, 2, "1")]


def test_windows_line_ends_and_unclosed_quotes(spark, tmp_path, rows):
    sheet = tmp_path / "workbook=w" / "sheet=01"
    sheet.mkdir(parents=True)
    (sheet / "a.csv").write_bytes(b'a,"b\r\nc"\r\n\r\nd,\r\n,"open, to the end\r\nof the file')
    got = rows(ld.landed_cells(spark, str(tmp_path)), "sheet", "row", "col", "value")
    assert got == [("01", 1, 1, "a"), ("01", 1, 2, "b\r\nc"), ("01", 3, 1, "d"), ("01", 4, 2, "open, to the end\r\nof the file")]


def test_too_many_blocks_are_an_error(spark, tmp_path):
    for name in "abc":
        sheet = tmp_path / "workbook=w" / f"sheet={name}"
        sheet.mkdir(parents=True)
        (sheet / "a.csv").write_text("x\n")
    with pytest.raises(Exception, match="more than 2 blocks"):
        ld.landed_cells(spark, str(tmp_path), most_blocks=2).collect()


def test_round_trip(spark, tmp_path, rows):
    frame = spark.createDataFrame(
        [("w", "s/1", i, f'say "{i}"', None if i % 3 else "a,\nb", "") for i in range(100)] + [("w", "s/1", 100, None, None, None), ("w", "s/1", 101, "end", None, " x ")],
        "workbook string, sheet string, at int, p string, q string, r string",
    )
    folder = str(tmp_path / "landed")
    ld.land_sheets(frame.repartition(7), folder, ["at"], ["p", "q", "r"])
    got = rows(ld.landed_cells(spark, folder), "sheet", "row", "col", "value")
    want = []
    for r in sorted(frame.collect(), key=lambda r: r["at"]):
        want += [("s/1", r["at"] + 1, c, r[n]) for c, n in enumerate("pqr", 1) if r[n]]
    assert got == sorted(want, key=str)
