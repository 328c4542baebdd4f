"""Date windows for backfills, and the audit of what they brought."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def batch_no(day: Column | str, start: Column | str, days: int) -> Column:
    """The 0-based number of the window that holds ``day``: arithmetic instead of a range join."""
    return F.floor(F.datediff(_col(day), _col(start)) / F.lit(days)).cast("int")


def batch_calendar(
    ranges: DataFrame, start: str, end: str, days: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Inclusive windows of ``days`` days per row of ``ranges``; the last one is clipped to ``end``.

    Gives ``keep`` plus batch, batch_start and batch_end; a range with start > end gives no rows.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    lo, hi = F.col(start).cast("date"), F.col(end).cast("date")
    step = F.make_dt_interval(F.lit(days))
    # sequence() raises on a start past the end.
    starts = F.when(lo <= hi, F.sequence(lo, hi, step))
    return ranges.select(*keep, hi.alias("_end"), F.posexplode(starts).alias("batch", "batch_start")).select(
        *keep,
        "batch",
        "batch_start",
        F.least(F.date_add("batch_start", days - 1), "_end").alias("batch_end"),
    )


def day_calendar(
    ranges: DataFrame, start: str, end: str, days: int = 7, keep: Sequence[str] = ()
) -> DataFrame:
    """Every day of each range with its batch number: ``keep``, day, batch."""
    calendar = batch_calendar(ranges, start, end, 1, keep)
    return calendar.select(
        *keep,
        F.col("batch_start").alias("day"),
        F.floor(F.col("batch") / F.lit(days)).cast("int").alias("batch"),
    )


def batch_audit(
    calendar: DataFrame, results: DataFrame, keys: Sequence[str] = (), day: str = "day"
) -> DataFrame:
    """Per batch: days asked for, days that failed or are missing, and rows received.

    ``calendar`` has ``keys``, the day and ``batch``; ``results`` has ``keys``, the day, ``ok`` and
    ``n_rows``. Results are reduced to one row per day before the join, so a day with many copies
    of a response costs no more than any other.
    """
    on = [*keys, day]
    per_day = results.groupBy(*on).agg(
        F.max(F.col("ok").cast("int")).alias("_ok"),
        F.sum(F.when(F.col("ok"), F.col("n_rows")).otherwise(0)).alias("_rows"),
    )
    return (
        calendar.join(per_day, on, "left")
        .groupBy(*keys, "batch")
        .agg(
            F.min(day).alias("batch_start"),
            F.max(day).alias("batch_end"),
            F.count(F.lit(1)).alias("days"),
            F.sum(F.when(F.col("_ok") == 1, 0).otherwise(1)).alias("failed_days"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        )
    )


def missing_days(
    calendar: DataFrame, results: DataFrame, keys: Sequence[str] = (), day: str = "day"
) -> DataFrame:
    """Calendar days without a usable result."""
    on = [*keys, day]
    usable = results.where("ok").select(*on).distinct()
    return calendar.join(usable, on, "left_anti")


def repair_windows(
    missing: DataFrame, keys: Sequence[str] = (), max_days: int | None = None, day: str = "day"
) -> DataFrame:
    """The fewest windows that hold exactly the days of ``missing``: ``keys``, start, end, days.

    A run of missing days becomes one window, or as few of at most ``max_days`` days as it takes; no window
    holds a day that is not missing. Days that repeat count once, null days not at all. The window below
    orders the days of one key, which are no more than the calendar has.
    """
    if max_days is not None and max_days < 1:
        raise ValueError("max_days must be at least 1")
    days = missing.where(F.col(day).isNotNull()).select(*keys, F.col(day).cast("date").alias("_day")).distinct()
    # Days that follow each other lie as far from the first as their number says.
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_day"))
    runs = days.withColumn("_run", F.date_sub("_day", number))
    part = F.lit(0)
    if max_days is not None:
        first = F.min("_day").over(Window.partitionBy(*keys, "_run"))
        part = F.floor(F.datediff("_day", first) / F.lit(max_days)).cast("int")
    return (
        runs.withColumn("_part", part)
        .groupBy(*keys, "_run", "_part")
        .agg(F.min("_day").alias("start"), F.max("_day").alias("end"), F.count(F.lit(1)).alias("days"))
        .select(*keys, "start", "end", "days")
    )
