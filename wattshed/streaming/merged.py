"""Daily totals that stay complete, however late a reading lands, without reading history again.

The state has one row for each unit and day: the total and a bitmap of the
half-hours that are in it. A batch adds the readings whose bit is not set, so a
retry counts once, in its own batch or any later one. Only the days that a batch
touches are read and written, as a new version under the batch's own number; a last
small write, the log, says which days the batch has a new version of. Readers and
later batches follow the log, so a batch that fails, or runs again, changes nothing
that another can see before its log is written, and writes the same again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATE = "unit string, total double, periods bigint, day date"
_LOG = "day date, batch bigint"


def half_hour_bit(ts: Column) -> Column:
    """The bit of the half-hour in which a reading's period ends, by UTC: 1 for the one at midnight."""
    slot = (F.pmod(F.unix_seconds(ts.cast("timestamp")), F.lit(86400)) / 1800).cast("int")
    return bit_at(slot)


def bit_at(place: Column) -> Column:
    """A 64-bit word with one bit set."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


class DailyTotals:
    """Totals by unit and day, kept under one folder and merged batch by batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _log(self) -> DataFrame:
        """(day, batch) of every version written, from batches that came to their end."""
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.folder}/log")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def _versions(self, before: int | None) -> DataFrame:
        """The latest version of each day, of batches below a number if one is given."""
        log = self._log()
        log = log if before is None else log.where(F.col("batch") < before)
        return log.groupBy("day").agg(F.max("batch").alias("batch"))

    def _state(self, versions: DataFrame) -> DataFrame:
        """Rows of the versions named; Spark reads the folders of those alone."""
        schema = f"{STATE}, batch bigint"
        try:
            state = self.spark.read.schema(schema).parquet(f"{self.folder}/state")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            state = self.spark.createDataFrame([], schema)
        # A row for each day touched: small beside the state, whatever its size.
        return state.join(versions, ["day", "batch"]).drop("batch")

    def merge(self, readings: DataFrame, batch: int) -> None:
        """Adds readings with ``bmUnit``, ``ts`` and ``quantity``; a batch already logged is left alone.

        Copies of a reading have its unit and time. Readings without unit or time
        cannot be placed and are left out; a NULL quantity counts as received and as 0.
        """
        if not self._log().where(F.col("batch") == batch).isEmpty():
            return
        given = readings.where("bmUnit is not null and ts is not null").select(
            F.col("bmUnit").alias("unit"), F.to_date("ts").alias("day"), half_hour_bit(F.col("ts")).alias("bit"), "quantity"
        )
        given = given.persist()
        try:
            days = given.select("day").distinct()
            before = self._state(self._versions(batch).join(days, "day"))
            keys = ["unit", "day"]
            # Dealt by unit and day once; copies, state and sums then meet where they are.
            once = given.repartition(*keys).groupBy(*keys, "bit").agg(F.max("quantity").alias("quantity"))
            known = once.join(before.select(*keys, "periods"), keys, "left")
            new = known.where(F.coalesce(F.col("periods").bitwiseAND(F.col("bit")), F.lit(0)) == 0)
            added = new.groupBy(*keys).agg(
                F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("total"), F.bit_or("bit").alias("periods")
            )
            # Units of a touched day that sent nothing go into its new version too.
            merged = before.unionByName(added).groupBy(*keys).agg(
                F.sum("total").alias("total"), F.bit_or("periods").alias("periods")
            )
            rows = merged.select("unit", "total", "periods", "day").hint("rebalance", "day")
            rows.write.mode("overwrite").partitionBy("day").parquet(f"{self.folder}/state/batch={batch}")
            days.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/log/batch={batch}")
        finally:
            given.unpersist()

    def totals(self) -> DataFrame:
        """(day, bmunit, generation_mwh, periods) of everything merged so far."""
        found = self._state(self._versions(None))
        return found.select("day", F.col("unit").alias("bmunit"), F.col("total").alias("generation_mwh"), "periods")

    def start(self, readings: DataFrame, checkpoint: str) -> StreamingQuery:
        """Merges what is new in a stream and stops; run again to resume."""
        return (
            readings.writeStream.foreachBatch(self.merge)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def period_bitmaps(readings: DataFrame) -> DataFrame:
    """(bmUnit, settlementDate, periods): bit p - 1 is set if period p has been received.

    A partial sum before the shuffle makes it one word for each unit and day of a
    task; bitmaps of several tables unite by ``unite_bitmaps``.
    """
    bit = bit_at(F.col("settlementPeriod") - 1)
    return readings.groupBy("bmUnit", "settlementDate").agg(F.bit_or(bit).alias("periods"))


def unite_bitmaps(*bitmaps: DataFrame) -> DataFrame:
    both = bitmaps[0]
    for more in bitmaps[1:]:
        both = both.unionByName(more)
    return both.groupBy("bmUnit", "settlementDate").agg(F.bit_or("periods").alias("periods"))


def missing_periods(bitmaps: DataFrame, first: Column, last: Column, periods_in_day: Column | None = None) -> DataFrame:
    """(bmUnit, settlementDate, settlementPeriod) that no reading came for, from first to last day.

    Of the units that the bitmaps have. Whole days are found as gaps between the
    days of a unit, so what is laid out is what is missing and not units by
    half-hours. ``periods_in_day`` is an expression of settlementDate; by default 48.
    """
    many = F.lit(48) if periods_in_day is None else periods_in_day
    inside = bitmaps.where(F.col("settlementDate").between(first, last))
    # A unit without a day inside still has a row, with no day, that ends its gap.
    ends = bitmaps.select("bmUnit").distinct().select("bmUnit", F.lit(None).cast("date").alias("settlementDate"))
    days = inside.select("bmUnit", "settlementDate").unionByName(ends)
    order = W.partitionBy("bmUnit").orderBy(F.col("settlementDate").asc_nulls_last())
    start = F.coalesce(F.date_add(F.lag("settlementDate").over(order), 1), first)
    stop = F.coalesce(F.date_sub("settlementDate", 1), last)
    gaps = days.withColumns({"_start": start, "_stop": stop}).where("_start <= _stop")
    empty = gaps.select("bmUnit", F.explode(F.sequence("_start", "_stop")).alias("settlementDate"), F.lit(0).cast("bigint").alias("periods"))
    full = bit_at(many) - 1
    open_days = inside.unionByName(empty).withColumn("_all", many).where(F.col("periods").bitwiseAND(full) != full)
    laid_out = open_days.select("bmUnit", "settlementDate", "periods", F.explode(F.sequence(F.lit(1), F.col("_all"))).alias("settlementPeriod"))
    came = F.col("periods").bitwiseAND(bit_at(F.col("settlementPeriod") - 1)) != 0
    return laid_out.where(~came).select("bmUnit", "settlementDate", "settlementPeriod")
