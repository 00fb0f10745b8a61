"""Sheets, files, features, sinks and publication."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from wattshed.plans import registry as rg
from wattshed.session import scratch_folder
from wattshed.sources import delimited as de
from wattshed.sources import records as rc
from wattshed.sources import sheets as sh
from wattshed.sources import sinks as sk

GRID = {
    "2022": [
        ["Title"],
        [None],
        ["Local authority", "Code", "Gas: Total [note 3]", "Coal"],
        ["Bristol", "E06000023", "1.5", "[c]"],
        ["Cardiff", "W06000015", "2", None],
    ],
    "2023": [
        ["Title"],
        [None],
        ["Local authority", "Code", "Coal", "Gas: Total"],
        ["Bristol", "E06000023", "7", "8"],
    ],
    "Contents": [["x"]],
}


def test_a1_bounds():
    assert sh.a1_bounds("A5:X374") == (5, 374, 1, 24)
    assert sh.a1_bounds("A6:AJ391") == (6, 391, 1, 36)
    with pytest.raises(ValueError):
        sh.a1_bounds("5:X")


def test_sheet_long(cells, rows):
    staged = cells(GRID).where(F.col("sheet").rlike("^2"))
    long = sh.long_table(
        staged, 3, ["code"], drop=["local_authority"],
        clean=lambda c: F.regexp_replace(c, "_note.*", ""),
    )
    assert rows(long, "sheet", "code", "name", "value") == [
        ("2022", "E06000023", "coal", "[c]"),
        ("2022", "E06000023", "gas_total", "1.5"),
        ("2022", "W06000015", "gas_total", "2"),
        ("2023", "E06000023", "coal", "7"),
        ("2023", "E06000023", "gas_total", "8"),
    ]


def test_sheet_wide_unites_by_name(cells, rows):
    staged = cells(GRID).where(F.col("sheet").rlike("^2"))
    wide = sh.wide_table(
        staged, 3, ["code", "coal", "gas_total"],
        clean=lambda c: F.regexp_replace(c, "_note.*", ""),
    )
    assert rows(wide, "sheet", "code", "coal", "gas_total") == [
        ("2022", "E06000023", "[c]", "1.5"),
        ("2022", "W06000015", None, "2"),
        ("2023", "E06000023", "7", "8"),
    ]


def test_sheet_names_and_range(cells, rows):
    staged = cells(GRID)
    assert rows(sh.sheet_names(staged, "^2")) == [("2022",), ("2023",)]
    assert sh.slice_range(staged, "B4:C4").count() == 4
    assert rows(sh.slice_range(staged, skip=4), "value") == [("2",), ("Cardiff",), ("W06000015",)]


def test_cells_are_shuffled_by_row_only(cells):
    staged = cells(GRID).where(F.col("sheet").rlike("^2"))
    long = sh.long_table(staged, 3, ["code"])
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(row" in plan and "BroadcastHashJoin" in plan


def _text(spark, content: str) -> str:
    path = scratch_folder(spark, "text")
    spark.createDataFrame([(line,) for line in content.splitlines()], "value string").coalesce(
        1
    ).write.text(path)
    return path


def test_malformed_rows(spark, rows):
    path = _text(spark, "k,v\n1,2.5\n2,bad\n3,4\n4,5,6\n")
    kept = de.read_csv_dropping(spark, path, "k int, v double")
    assert rows(kept) == [(1, 2.5), (3, 4.0)]
    assert rows(kept, "k") == [(1,), (3,)] and kept.count() == 2
    kept = de.read_csv_lenient(spark, path, "k int, v double")
    assert rows(kept, "k", de.BAD_RECORD) == [
        (1, None), (2, "2,bad"), (3, None), (4, "4,5,6")
    ]
    assert rows(kept, "k") == [(1,), (2,), (3,), (4,)]
    assert rows(de.read_csv_text(spark, path), "v") == [("2.5",), ("4",), ("5",), ("bad",)]


def test_landed_extract(spark, rows):
    path = _text(spark, "a,b\nx,1\nx,1\ny,1\nx,2\n")
    got = de.read_landed_extract(spark, path, "a string, b int", {"a": ["x"]}, ["b"])
    assert rows(got) == [(1, 2), (2, 1)]


def test_payloads_under_either_key(spark, rows):
    body = json.dumps({"results": [{"a": 1, "b": "x"}, {"a": 2, "b": None}]}, indent=1)
    path = _text(spark, body)
    got = rc.read_payloads(spark, path, "a int, b string", key="results", multi_line=True)
    assert rows(got) == [(1, "x"), (2, None)]


def test_feature_collection(spark, rows):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    feature = {"type": "Feature", "properties": {"n": "a", "code": ["E1", "E2"]},
               "geometry": {"type": "Polygon", "coordinates": [ring]}}
    path = _text(spark, json.dumps({"type": "FeatureCollection", "features": [feature] * 2}))
    got = rc.read_features(spark, path, "n string, code array<string>")
    assert got.count() == 2 and got.columns == ["n", "code", "coordinates"]
    assert got.first()["coordinates"] == [ring]


def test_features_round_trip(spark, rows):
    df = spark.createDataFrame([("a", 1.5, 2.5), ("b", 3.0, None)], "n string, x double, y double")
    path = scratch_folder(spark, "features")
    sk.write_features(df, path, "x", "y")
    back = rc.read_features(spark, path, "n string", "Point", collection=False)
    assert rows(back) == [("a", [1.5, 2.5]), ("b", [3.0, None])]


def _features(*shapes):
    return [
        {"type": "Feature", "properties": {"n": str(i)}, "geometry": g and {"type": g[0], "coordinates": g[1]}}
        for i, g in enumerate(shapes)
    ]


RING, HOLE = [[0.0, 0.0], [9.0, 0.0, 7.5], [9.0, 9.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 2.0], [2.0, 1.0], [1.0, 1.0]]


@pytest.mark.parametrize("collection", [True, False])
def test_areas_of_both_kinds_in_one_file(spark, rows, collection):
    made = _features(("Polygon", [RING, HOLE]), ("MultiPolygon", [[RING], [HOLE]]), None)
    text = json.dumps({"type": "FeatureCollection", "features": made}) if collection else "\n".join(map(json.dumps, made))
    areas = rc.read_areas(spark, _text(spark, text), "n string", collection)
    assert {r["n"]: r["parts"] for r in areas.collect()} == {"0": [[RING, HOLE]], "1": [[RING], [HOLE]], "2": None}
    got = rows(rc.rings_of(areas, ["n"]), "n", "part", "ring", "points")
    assert got == [("0", 0, 0, RING), ("0", 0, 1, HOLE), ("1", 0, 0, RING), ("1", 1, 0, HOLE)]
    path = scratch_folder(spark, "areas")
    sk.write_area_features(areas, path)
    assert rows(rc.read_areas(spark, path, "n string", collection=False)) == rows(areas)


def test_features_of_other_types_are_an_error(spark):
    path = _text(spark, "\n".join(map(json.dumps, _features(("Polygon", [RING]), ("Point", [1.0, 2.0])))))
    with pytest.raises(Exception, match="not an area: Point"):
        rc.read_areas(spark, path, "n string", collection=False).collect()
    with pytest.raises(Exception, match="not a Point: Polygon"):
        rc.read_features(spark, path, "n string", "Point", collection=False).collect()


def test_csv_nulls_round_trip(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    path = scratch_folder(spark, "csv")
    sk.write_csv(df, path)
    assert rows(de.read_csv_text(spark, path)) == [("a", None), ("b", "x")]


def test_write_verified_counts(spark):
    assert sk.write_verified(spark.range(37), scratch_folder(spark, "verified")) == 37


def test_create_table_refuses_an_existing_one(spark):
    spark.sql("DROP TABLE IF EXISTS once")
    sk.create_table(spark.range(3), "once", scratch_folder(spark, "once"))
    with pytest.raises(Exception, match="already exists"):
        sk.create_table(spark.range(3), "once", scratch_folder(spark, "once"))


def test_partitioned_write_prunes(spark):
    # One year holds two thirds of the rows.
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, 2023).otherwise(2024).alias("y"))
    path = scratch_folder(spark, "years")
    sk.write_parquet(df, path, ["y"])
    back = spark.read.parquet(path).where("y = 2024")
    assert back.count() == 1000
    assert "PartitionFilters: [isnotnull(y" in back._jdf.queryExecution().executedPlan().toString()


def test_publish_is_all_or_nothing(spark):
    root = scratch_folder(spark, "runs")
    good = {"a": spark.range(2), "b": spark.range(3)}
    first = sk.publish(spark, good, root)
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        sk.publish(spark, {"a": spark.range(9), "b": bad}, root)
    assert sk.read_published(spark, root, "a").count() == 2
    second = sk.publish(spark, {"a": spark.range(7)}, root)
    assert first != second
    assert sk.read_published(spark, root, "a").count() == 7
    assert sk.read_published(spark, root, "b").count() == 3
    with pytest.raises(LookupError):
        sk.read_published(spark, root, "c")


def test_registry(spark):
    steps = [
        rg.Step("doubled", ("raw",), lambda raw: raw.select((F.col("id") * 2).alias("id"))),
        rg.Step("joined", ("doubled", "other"), lambda d, o: d.join(o, "id")),
    ]
    assert rg.manifest(steps) == ["other", "raw"]
    with pytest.raises(LookupError):
        rg.build(steps, {"raw": spark.range(3)})
    inputs = {"raw": spark.range(10), "other": spark.range(5)}
    assert rg.build(steps, inputs)["joined"].count() == 3
    root = scratch_folder(spark, "registry")
    rg.run(spark, steps, inputs, root)
    assert spark.table("joined").count() == 3


def test_scratch_folder_needs_a_shared_folder(spark):
    assert scratch_folder(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_folder(spark, "a") != scratch_folder(spark, "a")


QUOTED = 'id,name,v\n1,"say ""hi"", ok",2.5\n2,"two\nlines",3.5\n3,plain,bad\n'


def test_quotes_commas_and_line_breaks_in_cells(spark, tmp_path, rows):
    (tmp_path / "q.csv").write_text(QUOTED)
    path, schema = str(tmp_path / "q.csv"), "id int, name string, v double"
    good = [(1, 'say "hi", ok', 2.5), (2, "two\nlines", 3.5)]
    assert rows(de.read_csv_dropping(spark, path, schema)) == good
    assert rows(de.read_csv_lenient(spark, path, schema), "id", "name", "v") == [*good, (3, "plain", None)]
    assert rows(de.read_csv_text(spark, path), "name") == [("plain",), ('say "hi", ok',), ("two\nlines",)]


def test_written_csv_reads_back(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "b", c\nd'), (2, None)], "id int, name string")
    sk.write_csv(df, str(tmp_path / "out"))
    assert '""b""' in "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert rows(de.read_csv(spark, str(tmp_path / "out"), "id int, name string")) == rows(df)


def test_range_without_last_row():
    assert sh.a1_bounds("B7:C") == (7, None, 2, 3)
    assert sh.a1_bounds("A5:X374") == (5, 374, 1, 24)


def _counted(calls, name, make):
    def step(*frames):
        calls.append(name)
        return make(*frames)

    return step


def test_steps_in_order_whatever_their_place(spark):
    steps = [rg.Step("c", ("b", "a"), None), rg.Step("b", ("a",), None), rg.Step("a", ("raw",), None)]
    assert [s.name for s in rg.in_order(steps)] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="need one another"):
        rg.in_order([rg.Step("a", ("b",), None), rg.Step("b", ("a",), None)])
    with pytest.raises(ValueError, match="one name"):
        rg.in_order([rg.Step("a", (), None), rg.Step("a", (), None)])


def test_unchanged_steps_are_taken_over_and_a_failed_run_resumes(spark, rows):
    root, files = scratch_folder(spark, "registry"), scratch_folder(spark, "inputs")
    spark.range(3).write.parquet(f"{files}/x")
    spark.range(5).write.parquet(f"{files}/y")
    calls: list[str] = []
    broken = [True]

    def last(a, b):
        return a.join(b, "id").select(F.raise_error(F.lit("broken")).alias("id") if broken[0] else "id")

    steps = [
        rg.Step("total", ("a", "b"), _counted(calls, "total", last)),
        rg.Step("a", ("x",), _counted(calls, "a", lambda x: x.where("id > 0"))),
        rg.Step("b", ("y",), _counted(calls, "b", lambda y: y)),
    ]
    inputs = lambda: {n: spark.read.parquet(f"{files}/{n}") for n in "xy"}
    with pytest.raises(Exception, match="broken"):
        rg.run(spark, steps, inputs(), root)
    with pytest.raises(LookupError):
        sk.read_published(spark, root, "a")
    broken[0] = False
    rg.run(spark, steps, inputs(), root)
    assert calls == ["a", "b", "total", "total"] and rows(sk.read_published(spark, root, "total")) == [(1,), (2,)]
    rg.run(spark, steps, inputs(), root)
    assert len(calls) == 4 and rows(spark.table("total")) == [(1,), (2,)]
    spark.range(4, 5).write.mode("append").parquet(f"{files}/x")
    rg.run(spark, steps, inputs(), root)
    assert calls[4:] == ["a", "total"] and rows(spark.table("total")) == [(1,), (2,), (4,)]
    changed = [rg.Step(s.name, s.needs, s.make, "2") if s.name == "b" else s for s in steps]
    rg.run(spark, changed, inputs(), root)
    assert calls[6:] == ["b", "total"]
    assert rg.input_print(spark.range(3)) != rg.input_print(spark.range(3))


def test_too_many_headers_are_an_error_or_a_join(spark, cells, rows):
    staged = cells(GRID).where(F.col("sheet").rlike("^2"))
    assert sh.header_count(staged, 3) == 8
    with pytest.raises(Exception, match="more than 7 header cells"):
        sh.long_table(staged, 3, ["code"], most_headers=7).collect()
    few = sh.long_table(staged, 3, ["code"], most_headers=8)
    assert rows(few) == rows(sh.long_table(staged, 3, ["code"], most_headers=None)) and few.count() == 8


def test_a_lookup_meets_the_headers(spark, cells, rows):
    staged = cells(GRID).where(F.col("sheet").rlike("^2"))
    names = spark.createDataFrame([("coal", "solid"), ("code", "an id"), ("oil", "liquid")], "measure string, kind string")
    long = sh.long_table(staged, 3, ["code"], "measure", "v", lookup=names)
    assert rows(long, "sheet", "code", "measure", "v", "kind") == [
        ("2022", "E06000023", "coal", "[c]", "solid"), ("2023", "E06000023", "coal", "7", "solid")
    ]
    with pytest.raises(ValueError, match="clash"):
        sh.long_table(staged, 3, ["code"], "measure", "v", lookup=names.withColumnRenamed("kind", "sheet"))
    assert rows(sh.wide_table(staged, 3, ["coal"], blank_rows=False), "sheet", "coal") == [("2022", "[c]"), ("2023", "7")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_put_together_before_they_are_shuffled(cells):
    staged = cells(GRID)
    for table in (sh.long_table(staged, 3, ["code"]), sh.wide_table(staged, 3, ["code", "coal"])):
        above, _, below = _plan(table).partition("Exchange hashpartitioning(row")
        assert "partial_collect_list" in below and "Window" not in above


def test_cells_that_repeat_and_headers_without_text(spark, rows):
    book = [
        (2, 1, "code"), (2, 2, "gas"), (2, 3, None), (2, 4, "gas"),
        (3, 1, "E1"), (3, 1, "E9"), (3, 1, "E3"), (3, 2, "5"), (3, 2, "5"), (3, 3, "lost"), (3, 4, "6"),
        (4, 2, "7"), (5, 1, "E5"), (6, 1, None), (6, 3, "lost"),
    ]
    flat = [("book", "s", *cell) for cell in book] + [("book", "s", None, 1, "x"), (None, "s", 3, 1, "x")]
    staged = spark.createDataFrame(flat, sh.CELLS).repartition(5)
    assert rows(sh.long_table(staged, 2, ["code"], "m", "v"), "code", "m", "v") == [
        ("E9", "gas", "5"), ("E9", "gas", "5"), ("E9", "gas_1", "6"), (None, "gas", "7")
    ]
    assert rows(sh.long_table(staged, 2, [], "m", "v").where("m = 'code'"), "m", "v") == [
        ("code", "E1"), ("code", "E3"), ("code", "E5"), ("code", "E9")
    ]
    found = rows(sh.wide_table(staged, 2, ["code", "gas_1", "none"]), "row", "code", "gas_1", "none")
    assert found == [(3, "E9", "6", None), (4, None, None, None), (5, "E5", None, None), (6, None, None, None)]
    found = rows(sh.wide_table(staged, 2, ["code", "gas_1"], blank_rows=False), "row", "code", "gas_1")
    assert found == [(3, "E9", "6"), (5, "E5", None)]


def test_columns_of_the_sheet_and_headers_no_lower_than_a_row(spark, cells, rows, tmp_path):
    cells(GRID).where(F.col("sheet").rlike("^2")).write.parquet(f"{tmp_path}/cells")
    staged = spark.read.parquet(f"{tmp_path}/cells")
    at, year = F.when(F.col("sheet").contains("x"), 2).otherwise(3), F.col("sheet").cast("int")
    long = sh.long_table(staged, at, ["code"], lowest_header=3, of_sheet={"year": year, "cells": F.lit(1)})
    assert rows(long.where("name = 'coal'"), "code", "value", "year", "cells") == [
        ("E06000023", "7", 2023, 1), ("E06000023", "[c]", 2022, 1)
    ]
    assert "LessThanOrEqual(row,3)" in _plan(long)


def test_parts_of_areas_are_worked_out_once(spark, tmp_path):
    square = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]
    areas = spark.createDataFrame([(1, [square, square]), (2, [square]), (3, None)], "k int, parts array<array<array<array<double>>>>")
    sk.write_area_features(areas, f"{tmp_path}/areas")
    rings = rc.rings_of(rc.read_areas(spark, f"{tmp_path}/areas", "k int", collection=False), ["k"])
    assert sorted((r["k"], r["part"], r["ring"], r["points"]) for r in rings.collect()) == [
        (1, 0, 0, square[0]), (1, 1, 0, square[0]), (2, 0, 0, square[0])
    ]
    assert rings._jdf.queryExecution().optimizedPlan().toString().count("not an area") == 1
