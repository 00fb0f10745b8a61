"""Half-hourly readings: incremental ingest, retry-safe dedupe, daily totals, audit.

A retrieval that fails is asked for again, so a (unit, date, period) may land
twice. The file source's checkpoint is the resume point; what never arrived is
found afterwards by an anti-join against the settlement calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import settlement_calendar
from ..operators.joins import missing_from
from ..sources.records import HALF_HOURLY, payload_schema

KEYS = ["bmUnit", "settlementDate", "settlementPeriod"]


def read_landing(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """New payload files in a folder, as records with ``ts`` for event time."""
    payloads = (
        spark.readStream.schema(payload_schema(HALF_HOURLY))
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(folder)
    )
    records = payloads.select(F.inline("data"))
    return records.withColumn("ts", F.col("halfHourEndTime").cast("timestamp"))


def without_retries(readings: DataFrame, delay: str) -> DataFrame:
    """One row for each key; state goes once the watermark passes it.

    A reading that lands later than ``delay`` behind the newest one is lost to
    this stream, so the delay must cover the longest retry or back-fill. Where
    none is known, ``land_late`` keeps every reading.
    """
    return readings.withWatermark("ts", delay).dropDuplicatesWithinWatermark(KEYS)


def batch_without_retries(readings: DataFrame) -> DataFrame:
    """The same over a finished table; repeats of a key are copies of one reading."""
    return readings.dropDuplicates(KEYS)


def stream_daily_totals(readings: DataFrame) -> DataFrame:
    """Total for each unit and day of period end; a day comes out when it can no longer change."""
    days = readings.groupBy(F.window("ts", "1 day").alias("w"), "bmUnit").agg(
        F.sum("quantity").alias("generation_mwh")
    )
    return days.select(
        F.to_date(F.col("w.start")).alias("day"), F.col("bmUnit").alias("bmunit"), "generation_mwh"
    )


def daily_totals(readings: DataFrame, by: str = "end_time") -> DataFrame:
    """Batch daily totals, NULLs ignored.

    By end time the last half-hour of a day falls on the next day; by
    ``settlement_date`` it does not.
    """
    day = {
        "end_time": F.to_date("halfHourEndTime"),
        "settlement_date": F.col("settlementDate"),
    }[by]
    return readings.groupBy(day.alias("day"), F.col("bmUnit").alias("bmunit")).agg(
        F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("generation_mwh")
    )


def land_late(readings: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append every reading that lands, however late, to Parquet by its own day, with no watermark.

    Retries of a key are copies of one reading; ``landed_daily_totals`` counts
    each once, so a day that a late reading touches comes out complete.
    """
    landed = readings.withColumn("landed_day", F.to_date("ts"))
    return (
        landed.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .partitionBy("landed_day")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def landed_daily_totals(spark: SparkSession, folder: str, days: list[str] | None = None) -> DataFrame:
    """Daily totals of what ``land_late`` has kept; ``days`` reads only those folders."""
    landed = spark.read.parquet(folder)
    if days:
        landed = landed.where(F.col("landed_day").isin([F.lit(d).cast("date") for d in days]))
    return daily_totals(batch_without_retries(landed))


def start(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to Parquet and stop; run again to resume."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def missing_readings(days: DataFrame, units: DataFrame, received: DataFrame) -> DataFrame:
    """Every half-hour of the given days that a unit should have sent and has not.

    The expectation is built from the calendar and the units. The calendar, whose
    length is that of the audited time, is held as one array and laid out for each
    unit; the units stay distributed.
    """
    slots = settlement_calendar(days).agg(
        F.collect_list(
            F.struct(
                F.col("settlement_date").alias("settlementDate"),
                F.col("settlement_period").alias("settlementPeriod"),
            )
        )
    )
    expected = units.select("bmUnit").distinct().select("bmUnit", F.inline(slots.scalar()))
    return missing_from(expected, received, KEYS)
