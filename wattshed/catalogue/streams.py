"""Half-hourly readings as a stream, and the batch answers over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import periods_in_day
from ..operators.aggregates import run_summary
from ..session import scratch_folder
from ..sources import records as rc
from ..streaming import half_hourly as hh
from ..streaming import merged as mg
from .base import query, rounded
from .files import land_payloads
from .inputs import with_ctes


def _drain(df, path, checkpoint):
    hh.start(df, path, checkpoint).awaitTermination()


@query(
    "stream_ingest_resumed", "STR-01", "SRC-11",
    sql=with_ctes("readings")
    + """SELECT bmunit AS "bmUnit", count(*) AS n, round(sum(quantity), 2) AS quantity
         FROM readings GROUP BY 1""",
)
def _(t):
    """Two runs over one folder: the second finds only what landed after the first."""
    spark = t.spark
    landing, out, mark = (scratch_folder(spark, p) for p in ("landing", "readings", "mark"))
    for part in ("settlementPeriod <= 24", "settlementPeriod > 24"):
        land_payloads(t, landing, part)
        _drain(hh.read_landing(spark, landing), out, mark)
    sums = spark.read.parquet(out).groupBy("bmUnit").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")
    )
    return rounded(sums, 2)


@query(
    "stream_deduplicated", "STR-02",
    sql=with_ctes("readings")
    + """SELECT bmunit AS "bmUnit", count(*) AS n, round(sum(quantity), 2) AS quantity
         FROM readings GROUP BY 1""",
)
def _(t):
    """Every payload lands twice, as after a retry of the whole retrieval."""
    spark = t.spark
    landing, out, mark = (scratch_folder(spark, p) for p in ("landing", "readings", "mark"))
    land_payloads(t, landing)
    land_payloads(t, landing)
    _drain(hh.without_retries(hh.read_landing(spark, landing), "40 days"), out, mark)
    sums = spark.read.parquet(out).groupBy("bmUnit").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")
    )
    return rounded(sums, 2)


@query(
    "stream_daily_totals", "STR-01", "STR-02", "STR-03",
    sql=with_ctes("readings")
    + """SELECT CAST(halfhourendtime AS DATE) AS day, bmunit,
                round(sum(quantity), 2) AS generation_mwh FROM readings GROUP BY 1, 2""",
)
def _(t):
    """Days close as the watermark passes; a last far-off record closes the rest."""
    spark = t.spark
    landing, out, mark = (scratch_folder(spark, p) for p in ("landing", "daily", "mark"))
    land_payloads(t, landing)
    land_payloads(t, landing)
    last = t.inputs.readings.agg(F.max("settlementDate").alias("d"))
    far = F.timestamp_add("DAY", F.lit(365), F.col("d").cast("timestamp_ntz"))
    closing = last.select(
        F.array(
            F.struct(
                F.lit("closing").alias("bmUnit"),
                F.to_date(far).cast("string").alias("settlementDate"),
                F.lit(1).alias("settlementPeriod"),
                F.date_format(far, "yyyy-MM-dd'T'HH:mm:ss").alias("halfHourEndTime"),
                F.lit(0.0).alias("quantity"),
            )
        ).alias("data")
    )
    daily = hh.stream_daily_totals(
        hh.without_retries(hh.read_landing(spark, landing), "40 days")
    )
    _drain(daily, out, mark)
    closing.write.mode("append").json(landing)
    _drain(daily, out, mark)
    totals = spark.read.parquet(out).where(F.col("bmunit") != "closing")
    return rounded(totals.select("day", "bmunit", "generation_mwh"), 2)


for _by, _day in {"end_time": "CAST(halfhourendtime AS DATE)", "settlement_date": "settlementdate"}.items():

    @query(
        f"readings_daily_by_{_by}", "AG-15", "P29", "SC-24",
        sql=with_ctes("readings")
        + f"""SELECT {_day} AS day, bmunit, round(sum(quantity), 2) AS generation_mwh
              FROM readings GROUP BY 1, 2""",
    )
    def _(t, by=_by):
        return rounded(hh.daily_totals(t.inputs.readings, by), 2)


@query(
    "stream_totals_merged", "STR-03", "STR-01", "P46",
    sql=with_ctes("readings")
    + """SELECT CAST(halfhourendtime AS DATE) AS day, bmunit, round(sum(quantity), 2) AS generation_mwh,
                count(*) AS periods FROM readings GROUP BY 1, 2""",
)
def _(t):
    """The first ten days' odd periods land last, everything before lands twice, and a batch runs again."""
    spark = t.spark
    landing, folder, mark = (scratch_folder(spark, p) for p in ("landing", "merged", "mark"))
    totals = mg.DailyTotals(spark, folder)
    late = "settlementDate < DATE'2024-01-11' AND settlementPeriod % 2 = 1"
    stream = lambda: hh.read_landing(spark, landing, files_per_trigger=20)
    for part in (f"NOT ({late})", "settlementPeriod % 3 = 0", late):
        land_payloads(t, landing, part)
        totals.start(stream(), mark).awaitTermination()
    again = t.inputs.readings.withColumn("ts", F.col("halfHourEndTime").cast("timestamp"))
    totals.merge(again.where("settlementPeriod <= 24"), 0)
    totals.merge(again, 1_000_000)
    found = totals.totals().withColumn("periods", F.bit_count("periods").cast("bigint"))
    return rounded(found, 2)


@query(
    "readings_missing", "P46", "JN-08", "SC-27",
    sql=with_ctes("readings")
    + """, days AS (SELECT CAST(d AS DATE) AS day
                    FROM range((SELECT min(settlementdate) FROM readings),
                               (SELECT max(settlementdate) + 1 FROM readings), INTERVAL 1 DAY) r(d)),
         wanted AS (SELECT u.bmunit, day, p FROM (SELECT DISTINCT bmunit FROM readings) u, days,
                    range(1, 49) q(p))
         SELECT w.bmunit AS "bmUnit", day AS "settlementDate", count(*) AS n,
                CAST(min(p) AS INTEGER) AS first_period, CAST(max(p) AS INTEGER) AS last_period
         FROM wanted w
         WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.bmunit = w.bmunit
                           AND r.settlementdate = day AND r.settlementperiod = p)
         GROUP BY 1, 2""",
)
def _(t):
    """Of all days that have readings; bitmaps of two halves are united first."""
    readings = t.inputs.readings
    halves = [mg.period_bitmaps(readings.where(f"settlementPeriod % 2 = {k}")) for k in (0, 1)]
    bounds = [readings.agg(f("settlementDate")).scalar() for f in (F.min, F.max)]
    missing = mg.missing_periods(mg.unite_bitmaps(*halves), *bounds, periods_in_day(F.col("settlementDate")))
    return missing.groupBy("bmUnit", "settlementDate").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("settlementPeriod").alias("first_period"),
        F.max("settlementPeriod").alias("last_period"),
    )


@query(
    "readings_missing_of_asked_days", "P46", "JN-08", "SC-27",
    sql=with_ctes("readings")
    + """, wanted AS (SELECT u.bmunit, day, p FROM (SELECT DISTINCT bmunit FROM readings) u,
                    (SELECT DISTINCT settlementdate AS day FROM readings WHERE settlementperiod = 48),
                    range(1, 49) q(p))
         SELECT w.bmunit AS "bmUnit", count(*) AS n FROM wanted w
         WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.bmunit = w.bmunit
                           AND r.settlementdate = day AND r.settlementperiod = p)
         GROUP BY 1""",
)
def _(t):
    """Days that are asked for one by one, against the calendar."""
    readings = t.inputs.readings
    days = readings.where("settlementPeriod = 48").select(F.col("settlementDate").alias("settlement_date")).distinct()
    missing = hh.missing_readings(days, readings.select("bmUnit"), readings)
    return missing.groupBy("bmUnit").agg(F.count(F.lit(1)).alias("n"))


@query(
    "readings_deduplicated", "STR-02", "P46",
    sql=with_ctes("readings") + "SELECT count(*) AS n, round(sum(quantity), 2) AS q FROM readings",
)
def _(t):
    readings = t.inputs.readings
    once = hh.batch_without_retries(readings.unionByName(readings))
    return rounded(once.agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q")), 2)


@query(
    "readings_summary", "P46", "AG-17", "SRC-11",
    sql=with_ctes("readings")
    + """SELECT count(*) AS records, min(settlementdate) AS first_day,
                max(settlementdate) AS last_day, count(DISTINCT bmunit) AS units,
                round(sum(quantity), 2) AS total_quantity FROM readings""",
)
def _(t):
    path = scratch_folder(t.spark, "payloads")
    land_payloads(t, path)
    records = rc.read_payloads(t.spark, path, rc.HALF_HOURLY)
    return rounded(run_summary(records, "settlementDate", "bmUnit", "quantity"), 2)
