"""Registered queries for windowed reads, run windows, counters and a gapless market.

Windowed queries store every row in partitioned tables first and then read a
stated window of them; the window is the feature. Windows are stated relative
to the data's own bounds so that they hold at every scale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import (alerts, backfill_plan, completeness, dedup_latest, gap_report, hour_ok,
                         last_completed_hour, load_counters, merge_window, rollup, to_silver)
from ..operators.load import parse_ws, to_bronze
from ..session import shared_dir
from ..sources.events import dense_bronze, faulty_rest_responses, read_events, rest_responses
from ..sources.landing import read_landing, write_landing
from ..sources.pairs import pair_dimension, pair_rows
from ..sources.rest import parse_rest, rest_rejects
from ..sources.tables import read_window, write_hours
from ..streaming.streams import run_available_now, stream_landing
from . import inputs as I
from .parse_queries import REST_BINANCE_SQL, REST_KRAKEN_SQL, RUN_COUNTERS_SQL, WS_BRONZE_SQL, _envelopes
from .registry import S_MIN, _w, gold_sql, register
from .stream_queries import raw_feed

# All days of the data but the first and the last.
INNER_DAYS = """(SELECT date_trunc('day', min(ts)) + INTERVAL 1 DAY AS ws, date_trunc('day', max(ts)) AS we FROM events)"""
IN_WINDOW = f"interval_start >= (SELECT ws FROM {INNER_DAYS} w) AND interval_start < (SELECT we FROM {INNER_DAYS} w)"


def _inner_days(events):
    lo, hi = I.value_bounds(events, "ts")
    day = dict(hour=0, minute=0, second=0, microsecond=0)
    return lo.replace(**day) + dt.timedelta(days=1), hi.replace(**day)


def _stored_window(spark, d):
    """Silver of all events as an hour-partitioned table, and the window of it."""
    path = shared_dir(spark, "silver")
    write_hours(I.silver(spark, d, "minute"), path)
    ws, we = _inner_days(read_events(spark, d))
    return spark.read.parquet(path), ws, we


@register("window_scan", _w(f"SELECT * FROM ({S_MIN}) s WHERE {IN_WINDOW}"))
def q_window_scan(spark, d):
    """Half-open window of a partitioned table: only its hours are read."""
    table, ws, we = _stored_window(spark, d)
    return read_window(table, ws, we).drop("hour")


@register("window_scan_open", _w(f"SELECT * FROM ({S_MIN}) s WHERE interval_start >= (SELECT ws FROM {INNER_DAYS} w)"))
def q_window_scan_open(spark, d):
    """The open-ended form: everything from the window's start."""
    table, ws, _ = _stored_window(spark, d)
    return read_window(table, ws).drop("hour")


@register("gold_1h_window", _w(f"SELECT * FROM ({gold_sql(S_MIN, 60)}) g WHERE {IN_WINDOW}"))
def q_gold_1h_window(spark, d):
    table, ws, we = _stored_window(spark, d)
    return I.round_cols(rollup(table, 60, ws, we), {"quote_volume"})


@register("landing_hours", _w(f"""
    SELECT * FROM ({WS_BRONZE_SQL}) b
    WHERE ingestion_ts >= (SELECT ws FROM {INNER_DAYS} w) AND ingestion_ts < (SELECT ws FROM {INNER_DAYS} w) + INTERVAL 1 DAY"""))
def q_landing_hours(spark, d):
    """All envelopes landed; the prefixes of the second day's 24 hours read back."""
    root = shared_dir(spark, "landing")
    write_landing(_envelopes(spark, d), root)
    ws, _ = _inner_days(read_events(spark, d))
    return to_bronze(read_landing(spark, root, [ws + dt.timedelta(hours=i) for i in range(24)]))


@register("rest_window", _w(f"""
    SELECT * FROM ({REST_BINANCE_SQL}) b
    UNION ALL
    SELECT * FROM ({REST_KRAKEN_SQL}) k WHERE interval_start >= (SELECT we FROM {INNER_DAYS} w)"""))
def q_rest_window(spark, d):
    """Kraken ticks before the window start are dropped again."""
    ev = read_events(spark, d)
    return parse_rest(rest_responses(ev), window_start=_inner_days(ev)[1])


@register("run_windows", _w("""
    SELECT DISTINCT date_trunc('hour', ts) AS hour, date_trunc('hour', ts) - INTERVAL 1 HOUR AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, date_trunc('hour', ts) - INTERVAL 1 HOUR AS last_completed
    FROM events"""))
def q_run_windows(spark, d):
    """The merge window of every hour with events, and the hour completed before it."""
    seen = read_events(spark, d).select(F.date_trunc("hour", "ts").alias("hour")).distinct()
    ws, we = merge_window(F.col("hour"))
    return seen.select("hour", ws.alias("window_start"), we.alias("window_end"),
                       last_completed_hour(F.col("hour") + F.expr("INTERVAL 30 MINUTES")).alias("last_completed"))


# -- bad input and counters -----------------------------------------------------

FAULT_SQL = """CASE WHEN event_id % 19 = 0 THEN 'error' WHEN event_id % 23 = 1 THEN 'cut' WHEN event_id % 29 = 2 THEN 'html' END"""


@register("rest_rejects", _w(f"""
    SELECT exchange, CASE WHEN exchange = 'binance' THEN 'not_a_candle_array' ELSE 'no_result' END AS reject_reason,
           count(*) AS responses
    FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'binance' ELSE 'kraken' END AS exchange, {FAULT_SQL} AS fault FROM events)
    WHERE fault IS NOT NULL GROUP BY ALL"""))
def q_rest_rejects(spark, d):
    return (rest_rejects(faulty_rest_responses(read_events(spark, d))).groupBy("exchange", "reject_reason")
            .agg(F.count(F.lit(1)).alias("responses")))


def _good(sql: str) -> str:
    return sql.replace("FROM (SELECT *, ", f"FROM (SELECT *, {FAULT_SQL} AS fault, ") + " AND fault IS NULL"


@register("rest_good_rows", _w(f"{_good(REST_BINANCE_SQL)} UNION ALL {_good(REST_KRAKEN_SQL)}"))
def q_rest_good_rows(spark, d):
    """The candles of the good responses among faulty ones."""
    return parse_rest(faulty_rest_responses(read_events(spark, d)), strict=False)


@register("run_counters", RUN_COUNTERS_SQL)
def q_run_counters(spark, d):
    return load_counters(parse_ws(_envelopes(spark, d)))


@register("stream_landing", _w(WS_BRONZE_SQL))
def q_stream_landing(spark, d):
    """Raw feed -> landing stream; the landed envelopes loaded to bronze."""
    feed, root, chk = shared_dir(spark, "feed"), shared_dir(spark, "landing"), shared_dir(spark, "chk")
    raw_feed(read_events(spark, d)).write.json(feed)
    run_available_now(stream_landing(spark, feed, root, chk))
    return to_bronze(read_landing(spark, root))


# -- a gapless market: the checks can succeed ------------------------------------

FOUR_SQL = "(VALUES " + ", ".join(f"({r[0]}, '{r[1]}', '{r[5]}')" for r in pair_rows()[:4]) + ") p(pair_id, exchange, symbol)"
DENSE_SQL = f"""
    WITH s AS (
      SELECT p.exchange, p.symbol, TIMESTAMP '2025-01-01' + to_minutes(event_id // 4) AS interval_start
      FROM events JOIN {FOUR_SQL} ON p.pair_id = event_id % 4
      WHERE NOT (event_id % 4 = 3 AND (event_id // 240) % 3 = 1 AND (event_id // 4) % 60 = 17)),
    hrs AS (SELECT unnest(range(date_trunc('hour', min(interval_start)),
                                date_trunc('hour', max(interval_start)) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour FROM s),
    comp AS (
      SELECT p.exchange, p.symbol, h.hour, count(DISTINCT s.interval_start) AS minutes,
             count(DISTINCT s.interval_start) = 60 AS ok
      FROM {FOUR_SQL} CROSS JOIN hrs h LEFT JOIN s
        ON s.exchange = p.exchange AND s.symbol = p.symbol AND date_trunc('hour', s.interval_start) = h.hour
      GROUP BY ALL),
    hok AS (SELECT hour, CAST(sum(minutes) AS BIGINT) AS rows, CAST(240 AS BIGINT) AS expected, sum(minutes) = 240 AS ok
            FROM comp GROUP BY hour)"""


def _dense(spark, d):
    pairs = pair_dimension(spark).where("pair_id < 4")
    bronze = dense_bronze(read_events(spark, d), pairs)
    lo, hi = I.hour_bounds(bronze)
    return to_silver(dedup_latest(bronze)), pairs, lo, hi


@register("dense_completeness", _w(DENSE_SQL + " SELECT * FROM comp"))
def q_dense_completeness(spark, d):
    return completeness(*_dense(spark, d))


@register("dense_hour_ok", _w(DENSE_SQL + " SELECT * FROM hok"))
def q_dense_hour_ok(spark, d):
    return hour_ok(*_dense(spark, d))


@register("dense_alerts", _w(DENSE_SQL + """
    SELECT 'incomplete' AS kind, exchange, symbol, hour,
           format('{} {} {}: {}/60', exchange, symbol, strftime(hour, '%Y-%m-%d %H:00'), minutes) AS text
    FROM comp WHERE NOT ok
    UNION ALL
    SELECT 'gap', exchange, symbol, hour,
           format('{} {} {} missing {}/60', exchange, symbol, strftime(hour, '%Y-%m-%d %H:00'), 60 - minutes)
    FROM comp WHERE minutes < 60
    UNION ALL
    SELECT 'ok', NULL, NULL, hour, format('ok {}', strftime(hour, '%Y-%m-%d %H:00')) FROM hok WHERE ok"""))
def q_dense_alerts(spark, d):
    silver, pairs, lo, hi = _dense(spark, d)
    series = pairs.select("exchange", F.col("warehouse_symbol").alias("symbol"))
    return alerts(completeness(silver, pairs, lo, hi), gap_report(silver, series, lo, hi), hour_ok(silver, pairs, lo, hi))


@register("dense_backfill_plan", _w(DENSE_SQL + """
    SELECT DISTINCT strftime(hour, '%Y-%m-%d-%H:00') AS partition_key FROM comp
    WHERE minutes < 60 AND hour(hour) % 2 = 1 ORDER BY partition_key"""))
def q_dense_backfill_plan(spark, d):
    """Hours with gaps that no earlier backfill asked for: the run log holds all even hours."""
    silver, pairs, lo, hi = _dense(spark, d)
    gaps = gap_report(silver, pairs.select("exchange", F.col("warehouse_symbol").alias("symbol")), lo, hi)
    asked = silver.select(F.date_trunc("hour", "interval_start").alias("hour")).distinct().where(F.hour("hour") % 2 == 0)
    return backfill_plan(gaps, asked.select(F.date_format("hour", "yyyy-MM-dd-HH:mm").alias("partition_key")))
