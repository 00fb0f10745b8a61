"""WKB of every type against plain writing, and the grid transform as generated code."""

from __future__ import annotations

import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattshed.functions import geography as geo


def pack(shape, order="<", dims=2, srid=False, iso=False):
    """WKB of ("Point", [x, y]), ("Polygon", [ring, ..]), ("GeometryCollection", [shape, ..]) and so on."""
    kind, body = shape
    number = {v: k for k, v in geo.WKB_TYPES.items()}[kind]
    if iso:
        code = number + {2: 0, 3: 1000, 4: 3000}[dims]
    else:
        code = number | (0x80000000 if dims > 2 else 0) | (0x40000000 if dims > 3 else 0) | (0x20000000 if srid else 0)
    out = struct.pack(f"{order}BI", order == "<", code) + (struct.pack(f"{order}I", 27700) if srid else b"")
    flat = lambda pts: b"".join(struct.pack(f"{order}{dims}d", *p, *[9.0] * (dims - 2)) for p in pts)
    line = lambda pts: struct.pack(f"{order}I", len(pts)) + flat(pts)
    sub = lambda name, b: pack((name, b), random.choice("<>"), dims, False, iso)
    if kind == "Point":
        return out + flat([body])
    if kind == "LineString":
        return out + line(body)
    if kind == "Polygon":
        return out + struct.pack(f"{order}I", len(body)) + b"".join(map(line, body))
    if kind == "GeometryCollection":
        return out + struct.pack(f"{order}I", len(body)) + b"".join(pack(s, random.choice("<>"), dims, False, iso) for s in body)
    return out + struct.pack(f"{order}I", len(body)) + b"".join(sub(kind.removeprefix("Multi"), b) for b in body)


def parts(shape):
    kind, body = shape
    if kind == "Point":
        return [[[body]]]
    if kind == "LineString":
        return [[body]]
    if kind == "Polygon":
        return [body]
    if kind == "GeometryCollection":
        return [p for s in body for p in parts(s)]
    return [p for b in body for p in parts((kind.removeprefix("Multi"), b))]


def some_shape(rng, deep=True):
    pair = lambda: [rng.uniform(-9, 9), rng.uniform(-9, 9)]
    line = lambda: [pair() for _ in range(rng.randrange(5))]
    area = lambda: [line() for _ in range(rng.randrange(4))]
    kind = rng.choice([k for k in geo.WKB_TYPES.values() if deep or k != "GeometryCollection"])
    one = {"Point": pair, "LineString": line, "Polygon": area}
    if kind in one:
        return kind, one[kind]()
    if kind == "GeometryCollection":
        return kind, [some_shape(rng, rng.random() < 0.3) for _ in range(rng.randrange(4))]
    return kind, [one[kind.removeprefix("Multi")]() for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("seed", range(6))
def test_wkb_of_every_type(seed):
    rng = random.Random(seed)
    random.seed(seed)
    shapes = [None if rng.random() < 0.1 else some_shape(rng) for _ in range(300)]
    column = pa.array([
        s and pack(s, rng.choice("<>"), rng.choice([2, 3, 4]), iso := rng.random() < 0.3, not iso) for s in shapes
    ], pa.binary())
    for got, want in ((geo.walk_wkb(column), shapes), (geo.walk_wkb(column.slice(7, 100)), shapes[7:107])):
        assert [g and g["type"] for g in got.to_pylist()] == [s and s[0] for s in want]
        assert [g and g["parts"] for g in got.to_pylist()] == [s and parts(s) for s in want]


def test_wkb_of_no_rows_and_of_many_rings():
    assert geo.walk_wkb(pa.array([], pa.binary())).to_pylist() == []
    assert geo.walk_wkb(pa.array([None, None], pa.binary())).to_pylist() == [None, None]
    shape = ("MultiPolygon", [[[[float(i), 1.0]] * 4] for i in range(2000)])
    assert geo.walk_wkb(pa.array([pack(shape)], pa.binary())).to_pylist()[0]["parts"] == parts(shape)


POINT = pack(("Point", [1.0, 2.0]))


@pytest.mark.parametrize(("raw", "what"), [(b"", "ends too early"), (POINT[:-1], "ends too early"), (POINT + b"x", "goes on"), (b"\x02" + POINT[1:], "byte order"), (POINT[:1] + b"\x08" + POINT[2:], "unknown WKB type 8"), (pack(("LineString", []))[:5] + b"\xff\xff\xff\xff", "ends too early")])
def test_bytes_that_are_not_wkb_are_an_error(raw, what):
    with pytest.raises(ValueError, match=what):
        geo.walk_wkb(pa.array([POINT, raw], pa.binary()))


def test_rings_of_other_types_are_an_error(spark):
    df = spark.createDataFrame([(POINT,)], "b binary")
    assert df.select(geo.wkb_parts("b")["parts"]).first()[0] == [[[[1.0, 2.0]]]]
    with pytest.raises(Exception, match="not a polygon: Point"):
        df.select(geo.wkb_rings("b")).collect()


def test_grid_steps_stay_in_generated_code(spark):
    df = spark.range(1000).select((F.col("id") * 500 + 100000.0).alias("e"), (F.col("id") * 900 + 20000.0).alias("n"), F.lit(1).alias("x"))
    placed = geo.grid_to_lonlat(df, "e", "n").where("lon > -2.5 AND lat < 57")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and len(plan) < 40_000
    airy = df.select(geo.grid_to_airy("e", "n").alias("a")).select("a.*").limit(5).collect()
    assert placed.columns == ["e", "n", "x", "lon", "lat"] and 0 < placed.count() < 1000 and len(airy) == 5


def test_grid_columns_are_replaced_and_missing_ones_stay_missing(spark):
    df = spark.createDataFrame([(530000.0, 180000.0, 7.0), (None, 1.0, 7.0)], "e double, n double, lon double")
    got = geo.grid_to_lonlat(df, "e", "n").collect()
    assert got[0]["lon"] == pytest.approx(-0.1284, abs=1e-4) and got[1]["lon"] is None and got[1]["lat"] is None
    assert geo.grid_to_points(df, "e", "n", "p").first()["p"]["y"] == pytest.approx(51.5040, abs=5e-5)


def test_grid_steps_of_wide_rows_are_small_enough_to_be_compiled(spark, tmp_path):
    texts = [F.col("id").cast("string").alias(f"c{i}") for i in range(18)]
    spark.range(20).select(*texts, (F.col("id") * 500 + 400000.0).alias("e"), (F.col("id") * 900 + 200000.0).alias("n")).write.parquet(f"{tmp_path}/wide")
    wide = spark.read.parquet(f"{tmp_path}/wide")
    placed = geo.grid_to_points(wide, "e", "n", "p")
    debug = getattr(getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = debug.codegenStringSeq(placed._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())) <= 8000
    narrow = {r["e"]: r["p"] for r in geo.grid_to_points(wide.select("e", "n"), "e", "n", "p").collect()}
    assert placed.columns == [*wide.columns, "p"] and {r["e"]: r["p"] for r in placed.collect()} == narrow
