"""Inputs of the registered queries, all derived from the supplied tables.

Every query starts from the whole ``events`` table (see
``sources.events``); windows are the data's own bounds, taken with
scalar subqueries so they stay inside the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import hours
from ..operators.dedup import dedup_latest
from ..operators.silver import to_silver
from ..sources.events import bronze_from_events, read_events
from ..sources.pairs import pair_dimension


def bronze(spark: SparkSession, sf_dir: str, grain: str = "minute", by_pair: bool = False) -> DataFrame:
    ev = read_events(spark, sf_dir)
    return bronze_from_events(ev, grain, pairs=pair_dimension(spark) if by_pair else None)


def silver(spark: SparkSession, sf_dir: str, grain: str = "minute", by_pair: bool = False,
           source_suffix: str | None = None) -> DataFrame:
    b = bronze(spark, sf_dir, grain, by_pair)
    if source_suffix:
        b = b.where(F.col("source").endswith(source_suffix))
    return to_silver(dedup_latest(b))


def event_hours(spark: SparkSession, sf_dir: str):
    """``[first hour, last hour + 1h)`` of all events, from a pass over their times alone."""
    return hour_bounds(read_events(spark, sf_dir), "ts")


def series_of(df: DataFrame) -> DataFrame:
    return df.select("exchange", "symbol").distinct()


def hour_bounds(df: DataFrame, col: str = "interval_start"):
    """``[first hour, last hour + 1h)`` of ``df`` as timestamp literals.

    One global ``min``/``max`` aggregate (a single row reaches the
    driver); literals, unlike scalar subqueries, are pushed down to the
    scan and used for partition pruning. A run with a given ``as_of``
    needs no such pass at all.
    """
    lo, hi = df.agg(F.date_trunc("hour", F.min(col)), F.date_trunc("hour", F.max(col))).first()
    return F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp") + hours(1)


def value_bounds(df: DataFrame, col: str):
    """``(min, max)`` of ``col`` as Python values, in one aggregate."""
    return tuple(df.agg(F.min(col), F.max(col)).first())


def round_cols(df: DataFrame, cols, scale: int = 6) -> DataFrame:
    """Round double sums whose last bits depend on addition order."""
    return df.select(*[F.round(c, scale).alias(c) if c in cols else F.col(c) for c in df.columns])
