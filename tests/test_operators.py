"""Operators on edge rows, and against plain Python on larger ones."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wattshed.operators import aggregates as ag
from wattshed.operators import columns as co
from wattshed.operators import filters as fl
from wattshed.operators import joins as jn
from wattshed.operators import ordered as od
from wattshed.operators import ranking as rk
from wattshed.operators import reshape as rs
from wattshed.operators import unions as un


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("raw", "plain"),
    [
        ("2025 Q1", "_2025_q1"),
        ("X-coordinate", "xcoordinate"),
        ("Local authority / region code\n[Note 5]", "local_authority_region_code_note_5"),
        ("Installed Capacity (MWelec)", "installed_capacity_mwelec"),
        ("Year", "year"),
        ("Apr-25", "apr25"),
    ],
)
def test_plain_name(raw, plain):
    assert co.plain_name(raw) == plain


def test_other_name_styles():
    assert co.cut_note_name("Hydro [note 5]") == "hydro"
    assert co.keep_punctuation_name("Wave/Tidal_note_1") == "wave/tidal"
    assert co.underscore_name("k Wp (total) ") == "k_wp_total"


def test_note_suffixes(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["hydro", "anaerobic_digestion_note_5_note_6", "code"])
    assert co.strip_note_suffixes(df).columns == ["anaerobic_digestion", "hydro", "code"]
    with pytest.raises(ValueError):
        co.without(df, "gone")
    with pytest.raises(ValueError):
        co.replaced(df, gone=F.lit(1))


def test_authority_prefix(spark, rows):
    codes = [("E06000022",), ("W06000001",), ("XE01",), (None,)]
    df = spark.createDataFrame(codes, "code string")
    assert rows(fl.english_authorities(df)) == [("E06000022",)]
    assert rows(fl.english_authorities(df, anywhere=True)) == [("E06000022",), ("XE01",)]


def test_not_in_keeps_null(spark, rows):
    df = spark.createDataFrame([("Unallocated",), (None,), ("Bristol",)], "n string")
    assert rows(df.where(fl.not_in_or_null("n", ["Unallocated"]))) == [("Bristol",), (None,)]


def test_slices(spark, rows):
    df = spark.createDataFrame([(2019,), (2021,), (2023,), (None,)], "y int")
    assert rows(fl.latest_slice(df, "y")) == [(2023,)]
    assert rows(fl.trailing_slice(df, "y", 2)) == [(2021,), (2023,)]
    assert rows(fl.first_and_last_slice(df, "y")) == [(2019,), (2023,)]
    assert "Join" not in plan_of(fl.latest_slice(df, "y"))


@pytest.mark.parametrize(
    ("values", "zero", "null", "poison"),
    [([None, None], 0, None, None), ([1, None], 1, 1, None), ([1, 2], 3, 3, 3)],
)
def test_null_modes(spark, values, zero, null, poison):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    modes = [df.agg(ag.total("x", m)).first()[0] for m in ("zero", "null", "poison")]
    assert modes == [zero, null, poison]


def test_shares(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), (None, "x", 4)], "k string, c string, n int")
    shared = ag.share_of_total(df, "n", "s", 100)
    assert rows(shared, "n", "s") == [(1, 12.5), (3, 37.5), (4, 50.0)]
    assert rows(ag.share_within(df, "n", ["k"], "s"), "n", "s") == [(1, 25.0), (3, 75.0), (4, 100.0)]
    assert "CartesianProduct" not in plan_of(shared) and "NestedLoop" not in plan_of(shared)


def test_weighted_mean(spark):
    three = [(5.0, 100), (10.0, 300), (7.0, None)]
    df = spark.createDataFrame(three, "rate double, pop int")
    assert ag.weighted_mean(df, "rate", "pop").first()[0] == pytest.approx(8.75)
    df = spark.createDataFrame([*three, (None, 100)], "rate double, pop int")
    assert ag.weighted_mean(df, "rate", "pop").first()[0] == pytest.approx(7.0)
    strict = ag.weighted_mean(df, "rate", "pop", require_rate=True).first()[0]
    assert strict == pytest.approx(8.75)


def test_totals_row_and_profile(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "t")], "k string, n int, s string")
    assert rows(ag.with_totals_row(df, "k")) == [("Total", 3, None), ("a", 1, None), ("b", 2, "t")]
    assert rows(ag.profile(df)) == [
        ("k", 2, 0, False), ("n", 2, 0, False), ("s", 2, 1, False),
    ]
    assert ag.profile(df.select(F.lit(None).cast("int").alias("x"))).first()["all_missing"]


def test_totals_neither_overflow_nor_vanish(spark, rows):
    df = spark.createDataFrame([("a", 2_000_000_000), ("b", 2_000_000_000)], "k string, n int")
    df = df.withColumn("d", F.lit("1.25").cast("decimal(5,2)"))
    assert [r[1:] for r in rows(ag.with_totals_row(df, "k")) if r[0] == "Total"] == [(4_000_000_000, Decimal("2.50"))]


def test_tail_and_bottom_differ_on_missing_keys(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert rows(rk.tail(df, 2, "x")) == [(1,), (None,)]
    assert rows(rk.bottom(df, 2, "x")) == [(1,), (2,)]


def test_headers_that_clean_to_one_name_are_numbered(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Total (MW)", "Total MW", "total: mw"])
    assert co.normalise_columns(df).columns == ["total_mw", "total_mw_1", "total_mw_2"]


def test_only_one(spark):
    for values, single in (([5], True), ([5, 5], True), ([5, 6], False), ([], False)):
        df = spark.createDataFrame([(v,) for v in values], "x int")
        assert ag.only_one(df, "x").first()[0] is single


def test_unpivot_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1.0, None)], "k string, p double, q double")
    assert rows(rs.to_long(df, ["k"])) == [("a", "p", 1.0)]
    assert rows(rs.to_long(df, ["k"], keep_nulls=True)) == [("a", "p", 1.0), ("a", "q", None)]


def test_unpivot_quarters_keeps_2020(spark, rows):
    df = spark.createDataFrame([("E0", "1", "2", "3")], ["code", "Apr-25", "Oct-21", "Apr-20"])
    long = rs.to_long_matching(df, r"^[A-Z][a-z]{2}-[0-9]{2}.*")
    assert rows(long, "name") == [("Apr-20",), ("Apr-25",), ("Oct-21",)]


def test_split_in_two(spark, rows):
    df = spark.createDataFrame([("12_gas_boiler",), ("none",)], "x string")
    assert rows(rs.split_in_two(df, "x", "_", "a", "b"), "a", "b") == [
        ("12", "gas_boiler"), ("none", None)
    ]


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2, "y")], "m int, t string")
    assert rows(un.union_by_position([a, b, a])) == [(1, "x"), (1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        un.union_by_position([a, b.select("t", "m")])
    with pytest.raises(ValueError):
        un.union_strict([a, b])
    filled = un.union_filling([a, a.select("n").withColumn("z", F.lit(9))])
    assert rows(filled) == [(1, "x", None), (1, None, 9)]
    assert rows(un.union_with_id({"p": a, "q": a}), "source", "n") == [("p", 1), ("q", 1)]


def test_display_midpoint(spark, rows):
    df = spark.createDataFrame(
        [("Domestic", 39), ("Industry & Commercial", 32), ("Transport", 29)], "c string, v int"
    )
    order = ["Industry & Commercial", "Transport", "Domestic"]
    placed = df.withColumn("place", rk.list_position("c", order))
    assert dict(od.display_midpoint(placed, ["place"], "v").select("c", "midpoint").collect()) == {
        "Industry & Commercial": 16.0, "Transport": 46.5, "Domestic": 80.5
    }


def test_list_order(spark):
    df = spark.createDataFrame([("b",), ("z",), (None,), ("a",)], "x string")
    assert [r[0] for r in rk.arrange_by_list(df, "x", ["b", "a"]).collect()] == ["b", "a", "z", None]


def test_repeatable_sample_ignores_partitioning(spark, rows):
    a = spark.range(500).repartition(7)
    b = spark.range(500).repartition(3)
    picked = rows(rk.repeatable_sample(a, 10, "id", seed=3))
    assert picked == rows(rk.repeatable_sample(b, 10, "id", seed=3)) and len(picked) == 10
    assert picked != rows(rk.repeatable_sample(a, 10, "id", seed=4))


@pytest.mark.parametrize("parts", [1, 2, 16])
def test_global_order_matches_plain_python(spark, parts):
    rng = random.Random(5)
    # A third of the keys share a long prefix, and keys come in no order.
    keys = [f"boiler and radiators {i:05d}" for i in range(400)]
    keys += [f"{rng.random():.9f}" for _ in range(800)]
    rng.shuffle(keys)
    values = {k: rng.randrange(100) for k in keys}
    df = spark.createDataFrame(list(values.items()), "k string, v int").repartition(5)
    ordered = sorted(values)
    ids = dict(od.row_ids(df, ["k"], parts=parts).select("k", "id").collect())
    assert ids == {k: i for i, k in enumerate(ordered, 1)}
    running, expected = 0, {}
    for k in ordered:
        running += values[k]
        expected[k] = running
    got = dict(od.running_total(df, ["k"], "v", parts=parts).select("k", "running").collect())
    assert got == expected
    before = dict(od.previous_value(df, ["k"], "v", parts=parts).select("k", "previous").collect())
    assert before == {k: values[p] if p else None for p, k in zip([None, *ordered], ordered)}
    sizes = od.batches(df, ["k"], 100, parts=parts).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in sizes} == {i: 100 for i in range(12)}


def test_global_order_never_uses_one_task(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    sizes = [r["count"] for r in od.ranged(df, ["k"], 8).groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 400
    plan = plan_of(od.row_ids(df, ["k"], parts=8))
    assert plan.count("SinglePartition") == 1  # one row for each part meets there


def test_order_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert od.row_ids(df, ["k"]).count() == 0
    assert od.running_total(df, ["k"], "v").count() == 0


SQUARE_WITH_HOLE = [
    [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]],
    [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]],
]
BENT = [[[20.0, 0.0], [30.0, 0.0], [30.0, 5.0], [25.0, 5.0], [25.0, 10.0], [20.0, 10.0], [20.0, 0.0]]]
SHAPES = [("holed", SQUARE_WITH_HOLE), ("bent", BENT)]
RINGS = "name string, rings array<array<array<double>>>"


@pytest.mark.parametrize("cell", [0.7, 3.0, 100.0])
def test_points_in_polygons(spark, rows, cell):
    shapes = spark.createDataFrame(SHAPES, RINGS)
    points = spark.createDataFrame(
        [(1, 2.0, 2.0), (2, 5.0, 5.0), (3, 22.0, 8.0), (4, 28.0, 8.0), (5, 500.0, 2.0),
         (6, 0.0, 3.0), (7, 10.0, 3.0), (8, 4.0, 5.0), (9, 7.0, 0.0), (10, 7.0, 4.0)],
        "id int, x double, y double",
    )
    found = jn.points_in_polygons(points, "x", "y", shapes, "name", "rings", cell)
    assert rows(found, "id", "name") == [(1, "holed"), (10, "holed"), (3, "bent")]


def test_points_in_polygons_match_plain_python(spark, rows):
    shapes = spark.createDataFrame(SHAPES, RINGS)
    rng = random.Random(2)
    crowd = [(i, rng.uniform(-2, 32), rng.uniform(-2, 12)) for i in range(2000)]
    points = spark.createDataFrame(crowd, "id int, x double, y double")
    large = rows(jn.points_in_polygons(points, "x", "y", shapes, "name", "rings", 2.0), "id", "name")

    def inside(x, y):
        if 0 < x < 10 and 0 < y < 10 and not (4 <= x <= 6 and 4 <= y <= 6):
            return "holed"
        if 20 < x < 30 and 0 < y < 10 and not (x >= 25 and y >= 5):
            return "bent"
        return None

    expected = sorted(((i, n) for i, x, y in crowd if (n := inside(x, y))), key=str)
    assert large == expected


def test_lookup_misses(spark, rows):
    facts = spark.createDataFrame([("gas", 1), ("odd", 2)], "f string, n int")
    table = spark.createDataFrame([("gas", "Gas")], "code string, name string")
    assert rows(jn.lookup(facts, table, {"f": "code"})) == [("gas", 1, "Gas")]
    assert rows(jn.lookup(facts, table, {"f": "code"}, "keep")) == [("gas", 1, "Gas"), ("odd", 2, None)]


def test_missing_from_with_a_hot_key(spark, rows):
    expected = spark.range(10).withColumnRenamed("id", "k")
    received = spark.range(3000).select(
        F.when(F.col("id") < 2000, 3).otherwise(F.col("id") % 9).cast("bigint").alias("k")
    )
    assert rows(jn.missing_from(expected, received, ["k"])) == [(9,)]


def test_pivot_finds_its_keys(spark, rows):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2024, 2.0), ("b", 2031, None), ("a", 2024, 3.0), ("b", None, 9.0)], "k string, y int, v double")
    wide = rs.pivot_found(df, ["k"], "y", "v")
    assert wide.columns == ["k", "2020", "2024", "2031"]
    assert rows(wide) == [("a", 1.0, 5.0, None), ("b", None, None, None)]
    assert {r["k"]: r["totals"] for r in rs.pivot_map(df, ["k"], "y", "v").collect()} == {"a": {2020: 1.0, 2024: 5.0}, "b": {2031: None}}
    with pytest.raises(ValueError, match="more than 2 values"):
        rs.pivot_found(df, ["k"], "y", "v", most=2)
    assert rs.pivot_found(df.limit(0), ["k"], "y", "v").columns == ["k"]


def test_profile_of_the_whole_is_the_union_of_its_periods(spark, rows):
    df = spark.range(30_000).select(
        (F.col("id") % 7 + 2000).alias("y"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("many"), (F.col("id") % 11).cast("string").alias("few"),
        F.lit(None).cast("string").alias("none"),
    )
    names = ["many", "few", "none"]
    apart = [ag.profile_by(df.where(f"y % 2 = {k}"), "y", names) for k in (0, 1)]
    united = rows(ag.unite_profiles(*apart).drop("periods"))
    assert united == rows(ag.unite_profiles(ag.profile_by(df, F.lit(1), names)).drop("periods"))
    by_name = {r[0]: r for r in united}
    assert by_name["few"][1:] == (30_000, 0, 11, False) and by_name["none"][1:] == (30_000, 30_000, 0, True)
    assert by_name["many"][3] == pytest.approx(20_000, rel=0.05)
    assert ag.unite_profiles(*apart).first()["periods"] == list(range(2000, 2007))


def test_frequent_values_are_bounded_on_both_sides(spark):
    rng = random.Random(9)
    data = [(rng.randrange(6), rng.choice("aaaabbbccdefghijklmnopqrstuvwxyz") if i % 5 else None) for i in range(4000)]
    df = spark.createDataFrame(data, "p int, v string")
    counts = {}
    for _, v in data:
        if v:
            counts[v] = counts.get(v, 0) + 1
    parts = [ag.frequent_by(df.where(f"p % 2 = {k}"), "p", ["v"], most=9) for k in (0, 1)]
    got = {r["value"]: r for r in ag.unite_frequent(*parts, most=9).collect()}
    assert all(r["at_least"] <= counts[v] <= r["at_most"] for v, r in got.items())
    assert {v for v, n in counts.items() if n * 9 > sum(counts.values())} <= set(got)
