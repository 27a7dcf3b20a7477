"""Missing minutes: WS gaps, REST gap fill, gap reports, fetch plan, backfill plan.

No operator here joins a per-minute spine against the fact. Present minutes are
first aggregated per (series, hour) into 60-bit masks (``functions.bits``): two
longs a row, a hash aggregate of fixed width with a partial step. Only that small
result meets the (series x hours) spine, which is generated on executors from the
series rows with ``sequence``; missing minutes are a complement, counts are
``bit_count``, and timestamps are made only for the minutes that are listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bits import minutes_seen, runs, starts, window_mask, without
from ..functions.time import hours, micros, minute_aligned, partition_key, steps
from ..sources.tables import read_window, ts_lit


def _hour_floor(v) -> Column:
    return F.date_trunc("hour", ts_lit(v))


def series_hours(series: DataFrame, window_start, window_end) -> DataFrame:
    """(exchange, symbol, hour) for every series and every hour touching ``[ws, we)``."""
    first = _hour_floor(window_start)
    last = F.date_trunc("hour", ts_lit(window_end) - micros(1))
    return series.select("exchange", "symbol",
                         F.explode(steps(first, last, hours(1))).alias("hour"))


def minute_masks(fact: DataFrame, window_start=None, window_end=None) -> DataFrame:
    """Per (exchange, symbol, hour): rows, and the masks of the minutes with a
    one-minute WS row (``ws``) and with any row (``held``).

    One aggregation from which gaps, their fill and the gap reports follow. WS
    rows are those with ``source = exchange || '_ws'`` and ``interval_seconds =
    60``; only minute-aligned rows have a bit, ``rows`` counts the others, too.
    """
    rows = read_window(fact, window_start, window_end).where(F.col("interval_start").isNotNull())
    is_ws = (F.col("source") == F.concat("exchange", F.lit("_ws"))) & (F.col("interval_seconds") == 60)
    aligned = F.when(minute_aligned("interval_start"), F.col("interval_start"))
    return (rows.groupBy("exchange", "symbol", F.date_trunc("hour", "interval_start").alias("hour"))
            .agg(F.count(F.lit(1)).alias("rows"), minutes_seen(F.when(is_ws, aligned)).alias("ws"),
                 minutes_seen(aligned).alias("held")))


def _missing(masks: DataFrame, series: DataFrame, window_start, window_end) -> DataFrame:
    """``masks`` on every series-hour of ``[ws, we)``, with ``missing``: its minutes without a WS row."""
    ws, we = ts_lit(window_start), ts_lit(window_end)
    none = F.lit(0).cast("long")
    return (series_hours(series, ws, we).join(masks, ["exchange", "symbol", "hour"], "left")
            .withColumn("missing", without(window_mask("hour", ws, we), F.coalesce("ws", none)))
            .withColumn("held", F.coalesce("held", none)).where("missing <> 0"))


def gaps_of(masks: DataFrame, series: DataFrame, window_start, window_end) -> DataFrame:
    """(exchange, symbol, interval_start) of every missing minute, from ``minute_masks``."""
    return _missing(masks, series, window_start, window_end).select(
        "exchange", "symbol", F.explode(starts("hour", "missing")).alias("interval_start"))


def gap_fill_of(masks: DataFrame, series: DataFrame, window_start, window_end) -> DataFrame:
    """Per series with gaps: missing minutes and how many of them any row holds, from ``minute_masks``."""
    return _fill_counts(_missing(masks, series, window_start, window_end))


def _fill_counts(missing: DataFrame) -> DataFrame:
    return (missing.groupBy("exchange", "symbol")
            .agg(F.sum(F.bit_count("missing")).cast("long").alias("ws_missing"),
                 F.sum(F.bit_count(F.col("missing").bitwiseAND(F.col("held")))).cast("long").alias("filled_minutes")))


def ws_gaps(bronze: DataFrame, series: DataFrame, window_start, window_end) -> DataFrame:
    """Minutes in ``[ws, we)`` with no one-minute WS row, per series.

    ``series`` = (exchange, symbol) to check.
    Result: (exchange, symbol, interval_start).
    """
    return gaps_of(minute_masks(bronze, window_start, window_end), series, window_start, window_end)


# Fixed value: candles of one REST response.
PAGE_ROWS = 1000


def gap_ranges(masks: DataFrame, series: DataFrame, window_start, window_end) -> DataFrame:
    """Per series, the maximal runs of missing minutes: (exchange, symbol, start, end, minutes).

    Runs within an hour come from its mask by bit operations (at most 30 an hour);
    a run that starts where the one before it ends continues it (gaps and islands),
    so the window functions see runs, not minutes.
    """
    found = _missing(masks, series, window_start, window_end).select(
        "exchange", "symbol", F.inline(runs("hour", "missing")))
    in_order = Window.partitionBy("exchange", "symbol").orderBy("start")
    begins = F.coalesce((F.col("start") != F.lag("end").over(in_order)).cast("int"), F.lit(1))
    island = F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (found.withColumn("begins", begins).withColumn("island", island)
            .groupBy("exchange", "symbol", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .select("exchange", "symbol", "start", "end",
                    F.expr("(unix_seconds(end) - unix_seconds(start)) div 60").alias("minutes")))


def fetch_plan(ranges: DataFrame, requested: DataFrame | None = None, page_rows: int = PAGE_ROWS) -> DataFrame:
    """The REST requests that fetch ``gap_ranges``: each range cut into pages of ``page_rows`` candles.

    Result: the range's columns, ``page`` (from 1), ``fetch_start`` and ``fetch_end``
    (excluded). Requests already in ``requested`` (exchange, symbol, fetch_start,
    fetch_end) are left out.
    """
    first = F.expr(f"sequence(0L, minutes - 1, {int(page_rows)}L)")
    at = lambda m: F.timestamp_seconds(F.unix_seconds("start") + m * 60)
    pages = ranges.select("*", F.posexplode(first).alias("n", "skip"))
    out = pages.select("exchange", "symbol", "start", "end", "minutes", (F.col("n") + 1).alias("page"), at(F.col("skip")).alias("fetch_start"),
                       F.least("end", at(F.col("skip") + page_rows)).alias("fetch_end"))
    if requested is not None:
        key = ["exchange", "symbol", "fetch_start", "fetch_end"]
        out = out.join(requested.select(*key), key, "left_anti").select(*out.columns)
    return out


def rest_gap_fill(rest: DataFrame, gaps: DataFrame) -> DataFrame:
    """REST rows whose minute is a WS gap (left semi join); others are not appended."""
    return rest.join(gaps.select("exchange", "symbol", "interval_start"),
                     ["exchange", "symbol", "interval_start"], "left_semi")


def gap_fill_check(bronze: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per series: WS-missing minutes and how many of them bronze now holds.

    ``filled_minutes`` = distinct gap minutes with any bronze row (any
    source), as the reference counts it. Both sides become masks per series
    and hour, so the join has one row an hour instead of one a minute.
    """
    key = ["exchange", "symbol", "hour"]
    of_hour = F.date_trunc("hour", "interval_start").alias("hour")
    missing = gaps.groupBy("exchange", "symbol", of_hour).agg(minutes_seen("interval_start").alias("missing"))
    held = minute_masks(bronze).select(*key, "held")
    return _fill_counts(missing.join(held, key, "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long"))))


def hourly_counts(fact: DataFrame, window_start=None, window_end=None) -> DataFrame:
    """Per (exchange, symbol, hour): ``rows``, distinct ``minutes`` and distinct
    minute-aligned ones (``present``).

    First one row per start, then one per hour, so no distinct aggregate
    multiplies the rows.
    """
    starts = (read_window(fact, window_start, window_end).where(F.col("interval_start").isNotNull())
              .groupBy("exchange", "symbol", "interval_start").agg(F.count(F.lit(1)).alias("n")))
    return (starts.groupBy("exchange", "symbol", F.date_trunc("hour", "interval_start").alias("hour"))
            .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("minutes"),
                 F.count_if(minute_aligned("interval_start")).alias("present")))


def gap_report_of(counts: DataFrame, series: DataFrame, window_start, window_end) -> DataFrame:
    """``gap_report`` from present minutes per series and hour (``hourly_counts``, or ``minute_masks``)."""
    return (series_hours(series, window_start, window_end)
            .join(counts.select("exchange", "symbol", "hour", "present"), ["exchange", "symbol", "hour"], "left")
            .select("exchange", "symbol", "hour",
                    (F.lit(60) - F.coalesce("present", F.lit(0))).cast("long").alias("missing_minutes"))
            .where("missing_minutes > 0")
            .orderBy(F.desc("hour"), "exchange", "symbol"))


def gap_report(silver: DataFrame, series: DataFrame, window_start, window_end) -> DataFrame:
    """Missing minutes per (exchange, symbol, hour) over whole hours of the window.

    The window is widened to whole hours (``date_trunc``); pass completed
    hours only (see ``lookback_window``). Every series in ``series`` is
    checked for every hour, so a silent series-hour reports 60. Only rows
    with ``missing_minutes > 0``, newest hour first.
    """
    ws = _hour_floor(window_start)
    we = _hour_floor(window_end)
    return gap_report_of(minute_masks(silver, ws, we).withColumn("present", F.bit_count("held")), series, ws, we)


def gap_report_weighted(silver: DataFrame, window_start) -> DataFrame:
    """The reference's gap count, kept for comparison.

    It builds the 60 expected minutes once per silver **row** at or after
    ``window_start``, so a series-hour with ``n`` rows and ``p`` present
    minutes reports ``n * (60 - p)``; minutes of the first hour before
    ``window_start`` count as missing and silent series-hours are never
    reported. Computed from per-hour counts, without the spine join.
    """
    return (minute_masks(silver, window_start)
            .select("exchange", "symbol", "hour",
                    (F.col("rows") * (F.lit(60) - F.bit_count("held"))).cast("long").alias("missing_minutes"))
                    .where("missing_minutes > 0")
                    .orderBy(F.desc("hour"), "exchange", "symbol"))


def backfill_plan(gaps: DataFrame, run_log: DataFrame | None = None) -> DataFrame:
    """Distinct partition keys (``yyyy-MM-dd-HH:00``) to re-run, ascending.

    Keys already in ``run_log`` (column ``partition_key``) are dropped so
    each key is requested once.
    """
    keys = gaps.select(partition_key("hour").alias("partition_key")).distinct()
    if run_log is not None:
        keys = keys.join(run_log.select("partition_key"), "partition_key", "left_anti")
    return keys.orderBy("partition_key")
