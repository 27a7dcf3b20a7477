"""Hour partition calendar, readiness rule and merge windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import hours, partition_key, partition_name, steps
from ..sources.tables import ts_lit



def last_completed_hour(as_of) -> Column:
    """Start of the last completed UTC hour before ``as_of``."""
    return F.date_trunc("hour", ts_lit(as_of)) - hours(1)


def merge_window(hour) -> tuple[Column, Column]:
    """The rolling 2-hour window ``[hour - 1h, hour + 1h)`` of a partition run."""
    end = F.date_trunc("hour", ts_lit(hour)) + hours(1)
    return end - hours(2), end


def partition_calendar(base: DataFrame | SparkSession, start, end) -> DataFrame:
    """One row per hour in ``[trunc(start), trunc(end))``.

    Columns: hour_start, hour_end, partition_key (``yyyy-MM-dd-HH:00``),
    partition_name (``yyyy_MM_dd_HH``). ``start``/``end`` may be columns
    of a one-row ``base`` frame (e.g. data bounds).
    """
    if isinstance(base, SparkSession):
        base = base.range(1)
    first = F.date_trunc("hour", ts_lit(start))
    last = F.date_trunc("hour", ts_lit(end)) - hours(1)
    spine = base.select(F.explode(steps(first, last, hours(1))).alias("hour_start"))
    return spine.select("hour_start", (F.col("hour_start") + hours(1)).alias("hour_end"),
                        partition_key("hour_start").alias("partition_key"),
                        partition_name("hour_start").alias("partition_name"))


def calendar_around(base, as_of, back_hours: int = 24, ahead_hours: int = 72) -> DataFrame:
    """Hours from ``trunc(as_of) - back`` to ``trunc(as_of) + ahead`` (exclusive)."""
    now = F.date_trunc("hour", ts_lit(as_of))
    return partition_calendar(base, now - F.make_dt_interval(hours=F.lit(back_hours)),
                              now + F.make_dt_interval(hours=F.lit(ahead_hours)))


def ready_partitions(calendar: DataFrame, as_of, delay_minutes: int = 3) -> DataFrame:
    """Hours whose run may start: ``as_of >= hour_start + 1 hour + delay``."""
    ready_at = F.col("hour_start") + hours(1) + F.make_dt_interval(mins=F.lit(delay_minutes))
    return calendar.where(ts_lit(as_of) >= ready_at)
