"""Named datasets on small sheets with the edge rows that decide results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattshed.sources import sheets
from wattshed.plans import buildings as bu
from wattshed.plans import emissions as em
from wattshed.plans import energy as en
from wattshed.plans import places as pl
from wattshed.plans import renewables as re
from wattshed.plans import transport as tr

TOP = [["Title"], [None], [None], [None], [None]]
HEAD = ["Country or region", "Local authority", "Code", "Notes"]
ENERGY = {
    "2022": [
        *TOP,
        [*HEAD, "All fuels: Domestic", "All fuels: Transport [note 1]", "All fuels: Total",
         "Gas: Total [note 2] [note 3]", "Coal: Total", "Mystery"],
        ["South West", "Bristol, City of", "E06000023", None, "30", "60", "100", "45", "[c]", "9"],
        ["South West", "Unallocated", None, None, "1", "1", "2", "1", "1", "1"],
        ["Wales", "Cardiff", "W06000015", None, "5", "5", "10", "5", "5", "5"],
    ],
    "2023": [
        *TOP,
        [*HEAD, "All fuels: Total", "All fuels: Domestic", "All fuels: Transport", "Gas: Total",
         "Coal: Total"],
        ["South West", "Bristol, City of", "E06000023", "n", "80", "20", "60", "30", "[x]"],
        ["South West", "North Somerset", "E06000024", None, "40", "10", "30", "20", "10"],
    ],
}
NAMES = [
    ("all_fuels_domestic", "all_fuels", "domestic"),
    ("all_fuels_transport", "all_fuels", "transport"),
    ("all_fuels_total", "all_fuels", "total"),
    ("gas_total", "gas", "total"),
    ("coal_total", "coal", "total"),
]


@pytest.fixture
def names(spark):
    raw = spark.createDataFrame(NAMES, "original_string string, fuel string, sector string")
    return en.fuel_sector_lookup(raw)


@pytest.fixture
def view(cells, names):
    return en.energy_by_fuel_sector(en.energy_long(cells(ENERGY)), names)


@pytest.fixture
def west(spark):
    return spark.createDataFrame([("E06000023",), ("E06000024",)], "ladcd string")


def test_energy_long(cells, rows):
    long = en.energy_long(cells(ENERGY)).where("calendar_year = 2022")
    assert rows(long, "code", "fuel_sector", "ktoe") == [
        ("E06000023", "all_fuels_domestic", 30.0),
        ("E06000023", "all_fuels_total", 100.0),
        ("E06000023", "all_fuels_transport", 60.0),
        ("E06000023", "coal_total", None),
        ("E06000023", "gas_total", 45.0),
        ("E06000023", "mystery", 9.0),
    ]


def test_energy_view_drops_names_without_lookup(rows, view):
    assert view.where("fuel = 'Coal'").count() == 3
    assert view.where("calendar_year = 2022").count() == 5
    assert rows(view.where("fuel = 'Gas' AND calendar_year = 2023"), "ladnm", "ktoe") == [
        ("Bristol, City of", 30.0), ("North Somerset", 20.0)
    ]


def test_energy_answers(rows, view, west):
    sectors = en.energy_by_sector(view, west)
    assert rows(sectors, "sector", "energy_ktoe", "pct_sector") == [
        ("Domestic", 30.0, 0.25), ("Transport", 90.0, 0.75)
    ]
    labels = en.sector_label_positions(sectors)
    assert rows(labels, "sector", "value", "y_pos", "label_text") == [
        ("Domestic", 25.0, 87.5, "25%"), ("Transport", 75.0, 37.5, "75%")
    ]
    assert rows(en.with_sector_icons(sectors, {"Transport": "road"}), "sector", "icon") == [
        ("Domestic", None), ("Transport", "road")
    ]
    fuels = en.energy_by_main_fuel(view, west)
    assert rows(fuels, "fuel_type", "energy_ktoe", "percent_fuel") == [
        ("Gas", 50.0, 83.0), ("Other", 10.0, 17.0)
    ]
    change = en.energy_change(view, west).orderBy("calendar_year").collect()
    assert change[0]["change"] is None
    assert change[1]["pct_change"] == pytest.approx(20)
    recent = en.energy_by_authority_recent(view, west, 0)
    assert [round(g, 1) for _, g in rows(recent, "ladnm", "gwh")] == [930.4, 465.2]


def test_clean_long_keeps_missing_cells_and_lookup_misses(cells, rows, names):
    columns = ["gas_total", "coal_total", "mystery"]
    clean = en.clean_energy_long(cells(ENERGY), names, columns)
    assert clean.count() == 4 * 3
    assert rows(clean.where("year = 2023 AND ladnm = 'North Somerset'"), "fuel", "value") == [
        ("Coal", 10.0), ("Gas", 20.0), (None, None)
    ]
    assert clean.where("ladnm = 'Unallocated'").count() == 0


def test_regional_gwh_leaves_totals_out(cells, names):
    lookup = names.withColumn("fuel_sector", F.replace("fuel_sector", F.lit("gas_total"), F.lit("mystery")))
    got = en.regional_energy_gwh(cells(ENERGY), lookup, "South West").collect()
    assert {(r.local_authority, r.year, r.consumption_ktoe) for r in got} == {
        ("Bristol, City of", 2022, 9.0), ("Unallocated", 2022, 1.0)
    }
    assert got[0].consumption_gwh == pytest.approx(got[0].consumption_ktoe * 11.63)


def test_electricity_pivot(spark, rows):
    df = spark.createDataFrame(
        [("a", 2014, 10.0), ("a", 2023, 6.0), ("b", 2014, 2.0), ("c", 2014, 99.0)],
        "code string, calendar_year int, x double",
    )
    wide = en.electricity_by_year_wide(df, ["a", "b"], [2014, 2023], "x")
    assert rows(wide) == [(12.0, 6.0)]
    assert rows(en.electricity_change(wide, 2014, 2023)) == [(-50.0,)]
    assert rows(en.electricity_change(wide, 2014, 2023, "new")) == [(-100.0,)]


IDS = ["Local Authority Code", "Local Authority Name", "Estimated number of households [note 1]",
       "Region", "Country"]
RENEWABLES = {
    "LA - Generation, 2023": [*TOP[:4], [*IDS, "Photovoltaics", "Anaerobic Digestion [note 5] [note 6]", "Total"],
                              ["E06000023", "Bristol", "100", "SW", "England", "45.5", "[c]", "45.5"],
                              ["W06000001", "Anglesey", "9", "Wales", "Wales", "1", "1", "2"]],
    "LA - Sites 2023": [*TOP[:3], [*IDS, "Photovoltaics", "Total"],
                        ["E06000023", "Bristol", "n/a", "SW", "England", "7", "7"]],
    "LA - Capacity, 2022": [*TOP[:3], [*IDS, "Photovoltaics", "Total"],
                            ["E06000023", "Bristol", "100", "SW", "England", "-2.5", None]],
    "Notes": [["Total"]],
}


def test_renewables_long(cells, rows):
    long = re.renewables_long(cells(RENEWABLES))
    assert rows(long, "type", "units", "calendar_year", "energy_source", "value") == [
        ("Capacity", "mw", 2022, "photovoltaics", -2.5),
        ("Generation", "mwh", 2023, "photovoltaics", 45.5),
        ("Generation", "mwh", 2023, "total", 45.5),
        ("Sites", "number", 2023, "photovoltaics", 7.0),
        ("Sites", "number", 2023, "total", 7.0),
    ]
    whole = re.renewables_long(cells(RENEWABLES), round_to_int=True)
    assert rows(whole.where("energy_source = 'photovoltaics'"), "value") == [(-3,), (46,), (7,)]
    assert re.sheet_name("Sites", 2024) == "LA - Sites 2024"
    assert re.sheet_name("Capacity", 2024) == "LA - Capacity, 2024"


def test_combined_renewables_and_capacity(spark, cells, rows):
    wide = re.combined_renewables(cells(RENEWABLES))
    assert "total" not in wide.columns
    assert rows(wide, "measure", "year", "estimated_number_of_households", "photovoltaics",
                "anaerobic_digestion") == [
        ("capacity_mw", 2022, 100.0, -2.5, None),
        ("generation_mwh", 2023, 100.0, 45.5, None),
        ("sites_number", 2023, None, 7.0, None),
    ]
    ca = spark.createDataFrame([("E06000023", "B", "E47", "West of England")],
                               "ladcd string, ladnm string, cauthcd string, cauthnm string")
    # The latest year has no capacity sheet: no rows gives NULL, or 0 where missing counts as none.
    assert re.latest_capacity_total(wide, ["E06000023"]).first()[0] is None
    assert re.latest_capacity_by_lookup(wide, ca, "West of England").first()[0] == 0
    assert rows(re.generation_by_combined_authority(wide, ca)) == [(2023, "West of England", 45.5)]


def test_generation_by_source(cells, rows, west):
    got = re.generation_by_source(re.renewables_long(cells(RENEWABLES)), west)
    assert rows(got, "source", "gen_gwh") == [("Photovoltaics", 0.0455)]


def test_operational_sites(spark, rows):
    raw = spark.createDataFrame(
        [("a", "1/2/2024", "10.5", "Operational", "Avon"), ("b", "31/12/2018", "1", "Operational", "Avon"),
         ("c", None, "4", "Planning", "Avon"), ("d", "1/1/2024", None, "Operational", "Avon"),
         ("e", "1/1/2020", "2", "Operational", "Avon"), ("f", "1/1/2020", "2", "Operational", "Kent")],
        "site_name string, operational string, installed_capacity_mwelec string, "
        "development_status_short string, county string",
    ).withColumns({"xcoordinate": F.lit(358651.0), "ycoordinate": F.lit(172645.0),
                   "technology_type": F.lit("Wind")})
    sites = re.operational_sites(raw, ["Avon"])
    assert rows(sites, "site_name", "operational_date") == [
        ("a", dt.date(2024, 2, 1)), ("b", dt.date(2018, 12, 31)), ("e", dt.date(2020, 1, 1))
    ]
    assert rows(re.capacity_added(sites)) == [(12.5,)]
    assert sites.first()["geo_point_2d"]["x"] == pytest.approx(-2.596, abs=1e-3)


def test_fossil_rules_differ_on_null_and_spelling(spark, rows):
    within = spark.createDataFrame(
        [("Fossil Fuel", 10.0), ("small fossil plant", 5.0), (None, 2.0), ("Wind", 3.0)],
        "technology string, capacity double",
    )
    total = spark.createDataFrame([(7.0,)], "x double")
    assert rows(re.fossil_and_renewable(within, total)) == [("Fossil", 15.0), ("Renewable", 7.0)]
    assert rows(re.energy_source_summary(within)) == [
        ("Fossil", 10.0, 50.0), ("Renewable", 10.0, 50.0)
    ]


def test_charge_points(cells, rows):
    grid = [[None], [None],
            ["Local authority / region code \n[Note 5]", "Local authority / region name", "Apr-25",
             "Oct-21 [Note 2]", "Apr-20", "Total"],
            ["E06000023", "Bristol", "45.5", "[x]", "12", "99"],
            ["W06000001", "Anglesey", "1", "1", "1", "3"]]
    got = tr.charge_points(cells({"2a": grid, "1a": [["no"]]}), "2a", out="cp_100k")
    assert rows(got, "la_region_code", "quarter", "cp_100k") == [
        ("E06000023", dt.date(2020, 4, 1), 12), ("E06000023", dt.date(2025, 4, 1), 46)
    ]


def test_vehicles_and_mileage(spark, cells, rows):
    df = spark.createDataFrame(
        [("E01", "a", "Battery electric", "5"), ("E02", "b", "Plug-in hybrid", "[c]"),
         ("E03", "c", "Total", "9"), ("W01", "d", "Diesel", "2"), ("E04", "e", "Plug-in x", "[x]")],
        "lsoa11cd string, lsoa11nm string, fuel string, _2025_q1 string",
    )
    assert rows(tr.electric_registrations(df, "_2025_q1"), "lsoa11cd") == [("E01",), ("E04",)]
    assert rows(tr.latest_vehicles(df, "_2025_q1", ["fuel"]), "lsoa11cd", "_2025_q1") == [("E01", 5)]
    grid = [*TOP[:4], ["Local Authority or Region Code", "Local Authority or Region", "Notes", "Units", "1993", "2023"],
            ["E06000023", "Bristol", "n", "m", "1.5", "[x]"], ["E12000009", "SW", "n", "m", "9", "9"]]
    assert rows(tr.vehicle_mileage(cells({"TRA8901": grid})), "year", "mileage_millions") == [
        (1993, 1.5), (2023, None)
    ]


def test_heating(spark, rows):
    texts = ["Boiler, mains gas", "Room heaters, electric", "Boiler, mains gas and electric heaters"]
    data = [("E1", "A", texts[0], dt.date(2024, 1, 1))] * 3 + [
        ("E1", "A", texts[1], dt.date(2024, 3, 31)), ("E2", "B", texts[2], dt.date(2020, 1, 1)),
        ("E2", "B", None, dt.date(2020, 1, 1)), ("E2", "B", texts[0], dt.date(2024, 4, 1))]
    certs = spark.createDataFrame(
        data, "local_authority string, local_authority_label string, mainheat_description string, lodgement_date date")
    numbered = bu.heating_descriptions(certs, "2024-03-31")
    assert rows(numbered, "id", "batch", "mainheat_clean") == [
        (1, 0, "1_Boiler mains gas"), (2, 0, "2_Boiler mains gas and electric heaters"),
        (3, 0, "3_Room heaters electric")]
    lookup = bu.heating_lookup(certs, "2024-03-31")
    for names in (lookup.select("mainheat", "category"), None):
        shares = bu.heating_share_within_authority(certs, names, "2024-03-31")
        assert rows(shares, "local_authority_code", "category", "n", "pct_domestic_properties") == [
            ("E1", "Electricity", 1, 25.0), ("E1", "Mains gas", 3, 75.0),
            ("E2", "Two or more(not including renewable energy)", 1, 100.0)]
    homes = bu.homes_by_heating(certs, lookup)
    assert [tuple(r) for r in homes.select("category", "n").collect()] == [("Electricity", 1), ("Mains gas", 4)]
    census = spark.createDataFrame([("E1", "A", "Mains gas", 70.0), ("E9", "Z", "Mains gas", 1.0)],
                                   "ladcd string, ladnm string, fuel_type string, pct_domestic_properties_official double")
    shares = bu.heating_share_within_authority(certs, None, "2024-03-31")
    gap = bu.compare_with_census(shares, census, ["Mains gas"])
    assert rows(gap, "ladcd", "diff_pct", "abs_diff_pct") == [("E1", 5.0, 5.0)]


def test_replies(spark, rows):
    reply = "'1_Gas Central Heating| Mains gas\n101_LPG_boiler| Other and unknown'\n\n"
    df = spark.createDataFrame([(reply,)], "reply string")
    assert rows(bu.parse_replies(df)) == [
        ("1", "Gas Central Heating", "Mains gas"), ("101", "LPG_boiler", "Other and unknown'")]


def test_emissions(spark, rows, west):
    df = spark.createDataFrame(
        [("B", "E06000023", "Transport", 2023, 1.0), ("B", "E06000023", "Domestic", 2023, None),
         ("N", "E06000024", "Transport", 2023, 4.0), ("N", "E06000024", "Transport", 2012, 9.0),
         ("Z", "E09", "Transport", 2023, 99.0)],
        "local_authority string, local_authority_code string, la_ghg_sector string, "
        "calendar_year int, territorial_emissions_kt_co2e double")
    assert rows(em.latest_emissions_by_authority(df, west)) == [("B", None), ("N", 4.0)]
    assert rows(em.emissions_by_year(df, west), "calendar_year", "total_emissions") == [(2023, 4.0), (2023, None)]
    assert rows(em.emissions_by_sector(df, west), "la_ghg_sector", "pct") == [("Domestic", None), ("Transport", 1.0)]
    assert rows(em.top_emitter(df, 2012)) == [("N", 9.0)]
    assert rows(em.top_emitter(df, 2020)) == [("Z", 99.0)]
    assert rows(em.sector_trend(df, "N", "Transport", 2000)) == [(2012, 9.0), (2023, 4.0)]


def test_regional_emissions_spacing(spark, rows):
    wide = spark.createDataFrame([(2020, 1000.0, None, 5.0), (2020, 500.0, None, 5.0)],
                                 "calendar_year int, land_use_x_total double, Waste_Total double, grand_total double")
    wide = wide.withColumnRenamed("Waste_Total", "waste_total")
    assert rows(em.regional_emissions_long(wide), "sector", "emissions_mtco2e") == [
        ("Land use_x", 1.5), ("Waste", 0.0)]


def test_scenarios(spark, rows):
    raw = spark.createDataFrame([("Bristol", "0", "1.5"), ("Bristol", "2030", "n/a"), ("Gone", "0", "1")],
                                "local_authority string, year string, value string")
    raw = raw.withColumns({"scenario": F.lit("S"), "technology": F.lit("T")})
    la = spark.createDataFrame([("Bristol", ["E06000023", "x"])], "lad_name string, lad_code array<string>")
    coded = pl.scenarios_with_codes(raw, la)
    assert rows(coded, "lad_code", "year") == [("E06000023", 2024), ("E06000023", 2030)]
    region = spark.createDataFrame([("Bristol",)], "ladnm string")
    assert rows(pl.scenario_slice(coded, region, "S", "T"), "year", "value") == [(2024, 1.5), (2030, None)]


def test_plans_start_no_job(spark, cells, west):
    """Building the sheet plans reads nothing."""
    tracker = spark.sparkContext.statusTracker()
    book = cells(RENEWABLES)
    group = "no-job-while-building"
    spark.sparkContext.setJobGroup(group, group)
    re.generation_by_source(re.renewables_long(book), west, re.sheet_years(book))
    re.latest_capacity_total(re.combined_renewables(book), ["E06000023"], re.sheet_years(book))
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_repeated_headers_are_numbered(cells, rows):
    book = cells({"2023": [["Name", "MW (a)", "MW a"], ["x", "1", "9"]]})
    assert rows(sheets.wide_table(book, 1, ["name", "mw_a", "mw_a_1"]), "name", "mw_a", "mw_a_1") == [("x", "1", "9")]
