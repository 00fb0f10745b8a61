"""Dates, quarter labels and half-hourly settlement periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import ColumnLike, char_slice, col

# Fixed value: the zone whose clock changes set the length of a settlement day.
SETTLEMENT_ZONE = "Europe/London"


def parse_dmy(c: ColumnLike) -> Column:
    """``31/12/2024`` or ``1/2/2024`` to a date; NULL stays NULL."""
    return F.to_date(col(c), "d/M/yyyy")


def parse_quarter(c: ColumnLike) -> Column:
    """``Apr-25`` to 2025-04-01, the first day of the month named."""
    label = F.concat(char_slice(c, 1, 4), F.lit("20"), char_slice(c, 5, 6))
    return F.to_date(label, "MMM-yyyy")


def year_from_label(c: ColumnLike) -> Column:
    """The four digits that end a sheet name, as an integer; NULL when there are none."""
    return F.when(col(c).rlike(r"\d{4}$"), F.right(col(c), F.lit(4))).cast("int")


def sortable_year(c: ColumnLike) -> Column:
    """The year that starts a sortable period number such as 20230000."""
    return char_slice(col(c).cast("string"), 1, 4)


def month_label(c: ColumnLike) -> Column:
    """``March 2024``."""
    return F.date_format(col(c), "MMMM yyyy")


def month_end_before(c: ColumnLike, today: ColumnLike | None = None) -> Column:
    """The date itself while in the past, else the last day of the month before today."""
    now = F.current_date() if today is None else col(today)
    return F.when(col(c) >= now, F.last_day(F.add_months(now, -1))).otherwise(col(c))


def day_start_utc(day: ColumnLike) -> Column:
    """Epoch seconds at which a settlement day starts, whatever the session zone is."""
    midnight = F.timestamp_seconds(F.unix_date(col(day)) * 86400)
    return F.unix_seconds(F.to_utc_timestamp(midnight, SETTLEMENT_ZONE))


def periods_in_day(day: ColumnLike) -> Column:
    """Half-hours in a local day: 48, or 46 and 50 on the clock-change days."""
    seconds = day_start_utc(F.date_add(col(day), 1)) - day_start_utc(day)
    return (seconds / 1800).cast("int")


def settlement_calendar(days: DataFrame, day: str = "settlement_date") -> DataFrame:
    """One row for each half-hour of each given day."""
    return days.withColumn(
        "settlement_period", F.explode(F.sequence(F.lit(1), periods_in_day(day)))
    )


def days_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row for each day, both ends included."""
    span = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    return spark.range(1).select(F.explode(span).alias("settlement_date"))


def half_hour_end(day: ColumnLike, period: ColumnLike) -> Column:
    """The UTC instant at which a settlement period ends."""
    return F.timestamp_seconds(day_start_utc(day) + col(period) * 1800)
