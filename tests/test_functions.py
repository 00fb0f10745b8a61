"""Column functions on edge rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattshed.functions import dates, geography, heating, numbers, text


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()[0]


@pytest.mark.parametrize(
    ("cell", "number"), [("[c]", None), ("[x]", None), ("12.5", 12.5), (None, None)]
)
def test_marker_cast(spark, cell, number):
    assert one(spark, numbers.marker_cast("x"), cell) == number


def test_marker_cast_fails_on_other_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, numbers.marker_cast("x"), "n/a")


@pytest.mark.parametrize(
    ("cell", "whole"), [("45.5", 46), ("-2.5", -3), ("2.4", 2), ("[c]", None), (None, None)]
)
def test_marker_cast_to_int_rounds_half_away(spark, cell, whole):
    assert one(spark, numbers.marker_cast("x", "int"), cell) == whole


@pytest.mark.parametrize(("x", "away", "even"), [(2.5, 3, 2), (0.5, 1, 0), (-2.5, -3, -2)])
def test_rounding_ties(spark, x, away, even):
    assert one(spark, numbers.round_half_away("x"), x, "double") == away
    assert one(spark, numbers.round_half_even("x"), x, "double") == even


def test_lenient_cast(spark):
    assert one(spark, numbers.lenient_cast("x"), "[c]") is None
    assert one(spark, numbers.lenient_cast("x"), "7.25") == 7.25
    assert one(spark, numbers.lenient_cast("x"), "1d") is None
    assert one(spark, numbers.lenient_cast("x"), "-1e3") == -1000.0


def test_percent_change_bases(spark):
    old, new = F.lit(50.0), F.lit(40.0)
    assert one(spark, numbers.percent_change(old, new)) == -20
    assert one(spark, numbers.percent_change(old, new, base="new")) == -25
    assert one(spark, numbers.percent_change(F.lit(0.0), new)) is None
    with pytest.raises(ValueError):
        numbers.percent_change(old, new, base="other")


def test_main_or_other_pools_null(spark):
    assert one(spark, numbers.main_or_other("x", ["Gas"]), "Gas") == "Gas"
    assert one(spark, numbers.main_or_other("x", ["Gas"]), "Coal") == "Other"
    assert one(spark, numbers.main_or_other("x", ["Gas"]), None) == "Other"


@pytest.mark.parametrize(
    ("name", "kept", "lowered"),
    [
        ("industrial_commercial_and_other", "Industrial commercial and other",
         "Industrial commercial and other"),
        ("aBC", "ABC", "Abc"),
        ("", "", ""),
    ],
)
def test_sentence_case(spark, name, kept, lowered):
    assert one(spark, text.sentence_case("x"), name) == kept
    assert one(spark, text.sentence_case("x", lower_rest=True), name) == lowered


def test_replace_first(spark):
    assert one(spark, text.replace_first("x", "_", " "), "land_use_x") == "land use_x"
    assert one(spark, text.replace_first("x", "_", " "), "_a_b") == " a_b"
    assert one(spark, text.replace_first("x", "_", " "), "plain") == "plain"


def test_text_helpers(spark):
    assert one(spark, text.plain_words("x"), "Boiler &  radiators | mains: gas ") == (
        "Boiler radiators mains: gas"
    )
    assert one(spark, text.regex_or_null("x", r"(\d+)"), "none") is None
    assert one(spark, text.char_slice("x", 0, 2), "E06") == "E0"
    assert one(spark, text.char_slice("x", 2), "_1993") == "1993"
    assert one(spark, text.strip_note("x"), "gas_note_3_note_4") == "gas"


@pytest.mark.parametrize(
    ("label", "day"),
    [("31/12/2024", dt.date(2024, 12, 31)), ("1/2/2024", dt.date(2024, 2, 1)), (None, None)],
)
def test_parse_dmy(spark, label, day):
    assert one(spark, dates.parse_dmy("x"), label) == day


def test_labels(spark):
    assert one(spark, dates.parse_quarter("x"), "Apr-25") == dt.date(2025, 4, 1)
    assert one(spark, dates.parse_quarter("x"), "Oct-21 [note 3]") == dt.date(2021, 10, 1)
    assert one(spark, dates.year_from_label("x"), "LA - Sites 2024") == 2024
    assert one(spark, dates.year_from_label("x"), "Contents") is None
    assert one(spark, dates.sortable_year(F.lit(20230000))) == "2023"
    assert one(spark, dates.month_label(F.to_date("x")), "2024-03-31") == "March 2024"


def test_month_end_before(spark):
    today = F.lit("2024-03-15").cast("date")
    later, earlier = F.lit("2024-03-20").cast("date"), F.lit("2024-01-05").cast("date")
    assert one(spark, dates.month_end_before(later, today)) == dt.date(2024, 2, 29)
    assert one(spark, dates.month_end_before(earlier, today)) == dt.date(2024, 1, 5)


def test_settlement_calendar_2024(spark):
    days = dates.days_between(spark, "2024-01-01", "2024-12-31")
    counts = dict(
        dates.settlement_calendar(days)
        .groupBy("settlement_date")
        .count()
        .withColumn("settlement_date", F.col("settlement_date").cast("string"))
        .collect()
    )
    assert sum(counts.values()) == 17568
    assert counts["2024-03-31"] == 46
    assert counts["2024-10-27"] == 50
    assert {n for d, n in counts.items() if d not in ("2024-03-31", "2024-10-27")} == {48}


def test_calendar_does_not_depend_on_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Europe/London"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, dates.periods_in_day(F.lit("2024-03-31").cast("date"))) == 46
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_half_hour_end_is_utc(spark):
    day = F.lit("2022-10-12").cast("date")
    end = F.date_format(dates.half_hour_end(day, F.lit(48)), "yyyy-MM-dd HH:mm")
    assert one(spark, end) == "2022-10-12 23:00"


def test_grid_to_airy_matches_published_example(spark):
    df = spark.createDataFrame([(651409.903, 313177.270)], "e double, n double")
    airy = geography.grid_to_airy("e", "n")
    row = df.select(F.degrees(airy["lat"]).alias("lat"), F.degrees(airy["lon"]).alias("lon")).first()
    assert row.lat == pytest.approx(52.6575703, abs=1e-7)
    assert row.lon == pytest.approx(1.7179216, abs=1e-7)


@pytest.mark.parametrize(
    ("e", "n", "lon", "lat"),
    [
        (651409.903, 313177.270, 1.716038, 52.657977),
        (530000.0, 180000.0, -0.1284, 51.5040),
    ],
)
def test_grid_to_lonlat_within_metres(spark, e, n, lon, lat):
    df = spark.createDataFrame([(e, n)], "e double, n double")
    row = geography.grid_to_lonlat(df, "e", "n").first()
    assert row.lon == pytest.approx(lon, abs=1e-4)
    assert row.lat == pytest.approx(lat, abs=5e-5)


def test_grid_result_can_be_filtered(spark):
    df = spark.range(100).select((F.col("id") * 1000 + 300000.0).alias("e"), F.lit(2e5).alias("n"))
    placed = geography.grid_to_lonlat(df, "e", "n").where("lon > -2.5 AND lat > 51 AND lon < -2")
    assert 0 < placed.count() < 100


def test_grid_of_constants(spark):
    df = spark.range(3).withColumns({"e": F.lit(530000.0), "n": F.lit(180000.0)})
    placed = geography.grid_to_lonlat(df, "e", "n").where("lon < 0").agg(F.max("lat"))
    assert placed.first()[0] == pytest.approx(51.5040, abs=5e-5)


def test_wkb_rings(spark):
    import struct

    square = [0.0, 0.0, 2.0, 0.0, 2.0, 2.0, 0.0, 0.0]
    for order, flag in (("<", 1), (">", 0)):
        polygon = struct.pack(f"{order}BIII8d", flag, 3, 1, 4, *square)
        multi = struct.pack(f"{order}BII", flag, 6, 2) + polygon + polygon
        df = spark.createDataFrame([(polygon,), (multi,), (None,)], "b binary")
        found = [r[0] for r in df.select(geography.wkb_rings("b")).collect()]
        ring = [[0, 0], [2, 0], [2, 2], [0, 0]]
        assert found == [[ring], [ring, ring], None]


@pytest.mark.parametrize(
    ("description", "category"),
    [
        ("Gas Central Heating", heating.MAINS_GAS),
        ("Boiler and radiators, mains gas", heating.MAINS_GAS),
        ("Electric storage heaters", heating.ELECTRICITY),
        ("Boiler and radiators, oil", heating.OIL),
        ("Communal System", heating.COMMUNITY),
        ("ASHP", heating.RENEWABLE),
        ("Air source heat pump, radiators, electric", heating.RENEWABLE),
        ("LPG boiler", heating.OTHER),
        ("Boiler and radiators, wood pellets; biomass", heating.OTHER),
        ("n/a", heating.OTHER),
        (None, heating.OTHER),
        ("mains gas and electric storage heaters", heating.TWO_PLAIN),
        ("Oil boiler and solar panels", heating.TWO_RENEWABLE),
        ("air source heat pump with gas boiler", heating.TWO_RENEWABLE),
    ],
)
def test_heating_category(spark, description, category):
    assert one(spark, heating.heating_category("x"), description) == category


def test_categories_of_rows_are_generated_code_and_agree(spark):
    texts = [("Boiler and radiators, mains gas",), ("Oil boiler and solar panels",), (None,), ("Air source heat pump, radiators, electric",)]
    df = spark.createDataFrame(texts, "x string")
    rows = heating.with_category(df, "x", "kind")
    assert "lambdafunction" not in rows._jdf.queryExecution().executedPlan().toString()
    want = df.select("x", heating.heating_category("x").alias("kind"))
    assert {tuple(r) for r in rows.collect()} == {tuple(r) for r in want.collect()}
