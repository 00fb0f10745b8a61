"""The half-hourly stream: resume, retries, late days, completeness."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wattshed.functions.dates import days_between
from wattshed.plans import generation as ge
from wattshed.session import scratch_folder
from wattshed.streaming import half_hourly as hh
from wattshed.streaming import merged as mg


def record(unit, day, period, end, quantity):
    return {
        "dataset": "B1610", "psrType": "Generation", "bmUnit": unit, "nationalGridBmUnitId": unit,
        "settlementDate": day, "settlementPeriod": period, "halfHourEndTime": end,
        "quantity": quantity,
    }


def land(spark, folder, *records):
    line = json.dumps({"data": list(records)})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(folder)


def drain(df, out, mark):
    hh.start(df, out, mark).awaitTermination()


def test_resume_and_dedupe(spark, rows):
    folder, out, mark = (scratch_folder(spark, p) for p in ("l", "o", "m"))
    a = record("T_1", "2024-01-01", 1, "2024-01-01T00:30:00", 1.5)
    b = record("T_1", "2024-01-01", 2, "2024-01-01T01:00:00", -2.0)
    land(spark, folder, a)
    stream = hh.without_retries(hh.read_landing(spark, folder), "2 days")
    drain(stream, out, mark)
    assert spark.read.parquet(out).count() == 1
    land(spark, folder, a, b)
    drain(stream, out, mark)
    got = spark.read.parquet(out)
    assert rows(got, "settlementPeriod", "quantity") == [(1, 1.5), (2, -2.0)]
    drain(stream, out, mark)
    assert spark.read.parquet(out).count() == 2


def test_daily_totals_wait_for_the_watermark(spark, rows):
    folder, out, mark = (scratch_folder(spark, p) for p in ("l", "o", "m"))
    first = record("T_1", "2024-01-01", 1, "2024-01-01T00:30:00", 1.0)
    land(spark, folder, first)
    daily = hh.stream_daily_totals(hh.without_retries(hh.read_landing(spark, folder), "2 days"))
    drain(daily, out, mark)
    # Late, but within the watermark; and one record a retry sends again.
    land(spark, folder, first, record("T_1", "2024-01-01", 3, "2024-01-01T01:30:00", 2.0),
         record("T_1", "2024-01-02", 1, "2024-01-02T00:30:00", 5.0))
    drain(daily, out, mark)
    land(spark, folder, record("T_1", "2024-03-01", 1, "2024-03-01T00:30:00", 0.0))
    drain(daily, out, mark)
    assert rows(spark.read.parquet(out), "day", "generation_mwh") == [
        (dt.date(2024, 1, 1), 3.0), (dt.date(2024, 1, 2), 5.0)
    ]


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(
        [("T_1", dt.date(2024, 1, 1), p, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * p), 1.0)
         for p in range(1, 49)],
        "bmUnit string, settlementDate date, settlementPeriod int, "
        "halfHourEndTime timestamp_ntz, quantity double",
    )


def test_midnight_belongs_to_the_next_day_by_end_time(rows, readings):
    assert rows(hh.daily_totals(readings), "day", "generation_mwh") == [
        (dt.date(2024, 1, 1), 47.0), (dt.date(2024, 1, 2), 1.0)
    ]
    assert rows(hh.daily_totals(readings, "settlement_date"), "day", "generation_mwh") == [
        (dt.date(2024, 1, 1), 48.0)
    ]


def test_missing_readings(spark, rows, readings):
    units = spark.createDataFrame([("T_1",), ("T_2",)], "bmUnit string")
    days = days_between(spark, "2024-01-01", "2024-01-01")
    gap = readings.where("settlementPeriod != 17")
    missing = hh.missing_readings(days, units, gap)
    assert missing.where("bmUnit = 'T_2'").count() == 48
    assert rows(missing.where("bmUnit = 'T_1'"), "settlementPeriod") == [(17,)]


def test_batch_dedupe(readings):
    assert hh.batch_without_retries(readings.union(readings)).count() == 48


def test_station_answers(spark, rows, readings):
    station = ge.station_generation(readings.toDF(*[c.lower() for c in readings.columns]))
    assert "generation_mwh" in station.columns and "settlementdate" in station.columns
    assert rows(ge.station_year(station)) == [(0.048, 2024)]
    renewable = spark.createDataFrame([(0.016,)], "gen_gwh double")
    assert ge.percent_renewable(renewable, ge.station_year(station)).first()[0] == 25.0
    assert ge.station_daily(station).agg(F.sum("generation_mwh")).first()[0] == 48.0


def test_a_reading_ten_days_late_is_counted(spark, rows):
    folder, out, mark = (scratch_folder(spark, p) for p in ("l", "o", "m"))
    early = record("T_1", "2024-01-01", 1, "2024-01-01T00:30:00", 1.0)
    land(spark, folder, early, record("T_1", "2024-01-11", 1, "2024-01-11T00:30:00", 4.0))
    hh.land_late(hh.read_landing(spark, folder), out, mark).awaitTermination()
    late = record("T_1", "2024-01-01", 2, "2024-01-01T01:00:00", 2.0)
    land(spark, folder, early, late)
    hh.land_late(hh.read_landing(spark, folder), out, mark).awaitTermination()
    day, far = dt.date(2024, 1, 1), dt.date(2024, 1, 11)
    assert rows(hh.landed_daily_totals(spark, out), "day", "generation_mwh") == [(day, 3.0), (far, 4.0)]
    assert rows(hh.landed_daily_totals(spark, out, ["2024-01-01"]), "day", "generation_mwh") == [(day, 3.0)]


def plain_missing(bitmaps, first, last):
    out, have = [], {}
    for unit, day, periods in bitmaps:
        have[unit, day] = have.get((unit, day), 0) | periods
    for unit in {u for u, _, _ in bitmaps}:
        day = first
        while day <= last:
            out += [(unit, day, p) for p in range(1, 49) if not have.get((unit, day), 0) >> (p - 1) & 1]
            day += dt.timedelta(days=1)
    return sorted(out)


def test_missing_periods_of_bitmaps(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    full = 2**48 - 1
    maps = [("a", day(1), full), ("a", day(4), full - 5), ("b", day(0), 1), ("b", day(6), full), ("c", day(40), full), ("a", day(4), 4)]
    frame = mg.unite_bitmaps(*[spark.createDataFrame(maps[i::2], "bmUnit string, settlementDate date, periods bigint") for i in (0, 1)])
    got = mg.missing_periods(frame, F.lit(day(0)), F.lit(day(6)))
    assert sorted(map(tuple, got.collect())) == plain_missing(maps, day(0), day(6))
    assert mg.missing_periods(frame.limit(0), F.lit(day(0)), F.lit(day(6))).collect() == []


def test_merged_totals_survive_retries_late_days_and_replays(spark, rows):
    def frame(*readings):
        full = [(u, dt.datetime(2024, 1, d, h, 30), q) for u, d, h, q in readings]
        return spark.createDataFrame(full, "bmUnit string, ts timestamp, quantity double")

    totals = mg.DailyTotals(spark, scratch_folder(spark, "merged"))
    assert totals.totals().collect() == []
    first = frame(("a", 1, 0, 1.0), ("a", 1, 0, 1.0), ("b", 1, 5, 2.0), ("a", 12, 3, 8.0), (None, 1, 1, 9.0))
    totals.merge(first, 0)
    late = frame(("a", 1, 7, 4.0), ("a", 1, 0, 1.0), ("c", 2, 0, None))
    totals.merge(late, 1)
    got = lambda: rows(totals.totals(), F.dayofmonth("day"), "bmunit", "generation_mwh", F.bit_count("periods"))
    want = [(1, "a", 5.0, 2), (1, "b", 2.0, 1), (12, "a", 8.0, 1), (2, "c", 0.0, 1)]
    assert got() == want
    totals.merge(first, 0)
    totals.merge(late, 1)
    assert got() == want
    # A batch that wrote its state and died before its log writes the same again.
    frame(("a", 1, 9, 77.0)).selectExpr("bmUnit AS unit", "quantity AS total", "1L AS periods", "DATE'2024-01-01' AS day").write.partitionBy("day").parquet(f"{totals.folder}/state/batch=2")
    assert got() == want
    totals.merge(frame(("b", 1, 6, 3.0)), 2)
    assert got() == [want[0], (1, "b", 5.0, 2), *want[2:]]


def test_merging_reads_only_the_days_it_touches(spark):
    totals = mg.DailyTotals(spark, scratch_folder(spark, "merged"))
    for n in range(3):
        day = dt.datetime(2024, 2, 1 + n, 4)
        totals.merge(spark.createDataFrame([("a", day, 1.0)], "bmUnit string, ts timestamp, quantity double"), n)
    versions = totals._versions(None).where("day = DATE'2024-02-02'")
    plan = totals._state(versions)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
