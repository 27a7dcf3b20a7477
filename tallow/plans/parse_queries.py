"""Registered queries for the message, REST and landing layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.load import bronze_binance, bronze_kraken, rejects, to_bronze
from ..operators.load_variant import variant_to_bronze
from ..session import shared_dir
from ..sources.events import binance_messages, kraken_messages, read_events, rest_responses
from ..sources.landing import read_landing, write_landing
from ..sources.ledger import load_new
from ..sources.messages import ENVELOPE_COLS, drop_heartbeats, envelope_binance, envelope_kraken
from ..sources.rest import parse_rest, parse_rest_binance, parse_rest_kraken
from ..sources.variant import read_variant_landing, variant_binance, variant_kraken, write_variant_landing
from .inputs import value_bounds
from .registry import _w, register

ENV_OUT = [c for c in ENVELOPE_COLS if c != "payload"]


def _envelopes(spark, d) -> DataFrame:
    ev = read_events(spark, d)
    return envelope_binance(binance_messages(ev)).unionByName(envelope_kraken(kraken_messages(ev)))


K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
EV = f"(SELECT *, {K} AS k FROM events)"

ENV_BINANCE_SQL = f"""
    SELECT 'binance' AS exchange, upper(event_type) || 'USDT' AS symbol, 1 AS interval_minutes,
           'update' AS event_type, date_trunc('millisecond', ts) AS event_ts,
           CASE WHEN event_id % 17 <> 0 THEN date_trunc('minute', ts) END AS interval_start,
           CASE WHEN event_id % 17 <> 0 THEN date_trunc('minute', ts) + INTERVAL 59999 MILLISECOND END AS interval_end,
           CASE WHEN event_id % 17 <> 0 THEN event_id % 4 <> 0 END AS is_final
    FROM events WHERE user_id % 2 = 0"""

ENV_KRAKEN_SQL = """
    WITH kr AS (SELECT * FROM events WHERE user_id % 2 = 1)
    SELECT 'kraken' AS exchange, upper(event_type) || '/USD' AS symbol, 1 AS interval_minutes,
           CASE WHEN event_id % 4 = 0 THEN 'update' ELSE 'snapshot' END AS event_type, ts AS event_ts,
           date_trunc('minute', ts) AS interval_start,
           date_trunc('minute', ts) + INTERVAL 1 MINUTE AS interval_end, event_id % 4 <> 0 AS is_final
    FROM kr
    UNION ALL
    SELECT 'kraken', upper(event_type) || '/USD', 1,
           CASE WHEN event_id % 4 = 0 THEN 'update' ELSE 'snapshot' END, ts,
           date_trunc('minute', ts) + INTERVAL 1 MINUTE, date_trunc('minute', ts) + INTERVAL 2 MINUTE,
           event_id % 4 <> 0
    FROM kr WHERE event_id % 7 = 0
    UNION ALL
    SELECT 'kraken', upper(event_type) || '/USD', 1, 'status', ts, NULL, NULL, NULL
    FROM kr WHERE event_id % 10 = 3"""

BRONZE_BINANCE_SQL = f"""
    SELECT 'binance' AS exchange, upper(event_type) || 'USDT' AS symbol, 60 AS interval_seconds,
           date_trunc('minute', ts) AS interval_start,
           date_trunc('minute', ts) + INTERVAL 59999 MILLISECOND AS interval_end,
           value AS open, value AS high, value AS low, value AS close, CAST(k AS DOUBLE) AS volume,
           CASE WHEN k > 0 THEN (CASE WHEN event_id % 5 <> 0 THEN value * k ELSE 0.0 END) / k END AS vwap,
           1 AS trade_count, 'binance_ws' AS source, date_trunc('millisecond', ts) AS ingestion_ts
    FROM {EV} e WHERE user_id % 2 = 0 AND event_id % 17 <> 0 AND event_id % 4 <> 0"""


def bronze_kraken_sql(strict_first: bool = False) -> str:
    # second candle: own prices, or the first candle's under strict_first
    p2, v2, n2 = ("value", "CASE WHEN event_id % 13 <> 0 THEN value END", 1) if strict_first \
        else ("value + 1", "value + 1", 2)
    second_ok = "event_id % 11 <> 0" if strict_first else "TRUE"
    return f"""
    SELECT 'kraken' AS exchange, upper(event_type) || 'USD' AS symbol, 60 AS interval_seconds,
           date_trunc('minute', ts) AS interval_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS interval_end,
           value AS open, value AS high, value AS low, value AS close, CAST(k AS DOUBLE) AS volume,
           CASE WHEN event_id % 13 <> 0 THEN value END AS vwap, 1 AS trade_count,
           'kraken_ws' AS source, ts AS ingestion_ts
    FROM {EV} e WHERE user_id % 2 = 1 AND event_id % 11 <> 0
    UNION ALL
    SELECT 'kraken', upper(event_type) || 'USD', 60,
           date_trunc('minute', ts) + INTERVAL 1 MINUTE, date_trunc('minute', ts) + INTERVAL 2 MINUTE,
           {p2}, {p2}, {p2}, {p2}, CAST(k AS DOUBLE), {v2}, {n2}, 'kraken_ws', ts
    FROM {EV} e WHERE user_id % 2 = 1 AND event_id % 7 = 0 AND {second_ok}"""


@register("envelope_binance", _w(ENV_BINANCE_SQL))
def q_envelope_binance(spark, d):
    return envelope_binance(binance_messages(read_events(spark, d))).select(*ENV_OUT)


@register("envelope_kraken", _w(ENV_KRAKEN_SQL))
def q_envelope_kraken(spark, d):
    return envelope_kraken(kraken_messages(read_events(spark, d))).select(*ENV_OUT)


@register("drop_heartbeats", _w("""
    SELECT upper(event_type) || '/USD' AS symbol, 1 AS interval_minutes, ts AS received_ts, 'ohlc' AS channel
    FROM events WHERE user_id % 2 = 1
    UNION ALL
    SELECT upper(event_type) || '/USD', 1, ts, 'status' FROM events
    WHERE user_id % 2 = 1 AND event_id % 10 = 3"""))
def q_drop_heartbeats(spark, d):
    raw = kraken_messages(read_events(spark, d))
    return drop_heartbeats(raw).select("symbol", "interval_minutes", "received_ts",
                                       F.get_json_object("msg", "$.channel").alias("channel"))


@register("bronze_binance", _w(BRONZE_BINANCE_SQL))
def q_bronze_binance(spark, d):
    return bronze_binance(envelope_binance(binance_messages(read_events(spark, d))))


@register("bronze_kraken", _w(bronze_kraken_sql()))
def q_bronze_kraken(spark, d):
    return bronze_kraken(envelope_kraken(kraken_messages(read_events(spark, d))))


@register("bronze_kraken_strict_first", _w(bronze_kraken_sql(strict_first=True)))
def q_bronze_kraken_strict_first(spark, d):
    return bronze_kraken(envelope_kraken(kraken_messages(read_events(spark, d))), strict_first=True)


WS_BRONZE_SQL = f"{BRONZE_BINANCE_SQL} UNION ALL {bronze_kraken_sql()}"


@register("to_bronze", _w(WS_BRONZE_SQL))
def q_to_bronze(spark, d):
    return to_bronze(_envelopes(spark, d))


# Envelopes of an hour and exchange, and those of them that were loaded.
RUN_COUNTERS_SQL = _w(f"""
    WITH seen AS (SELECT date_trunc('hour', event_ts) AS hour, exchange, count(*) AS rows_seen
                  FROM ({ENV_BINANCE_SQL} UNION ALL SELECT * FROM ({ENV_KRAKEN_SQL}) k) e GROUP BY ALL),
    loaded AS (SELECT date_trunc('hour', ingestion_ts) AS hour, exchange, count(*) AS n
               FROM ({BRONZE_BINANCE_SQL} UNION ALL {bronze_kraken_sql()}) b GROUP BY ALL)
    SELECT hour, exchange, rows_seen, coalesce(n, 0) AS rows_loaded, rows_seen - coalesce(n, 0) AS rows_skipped
    FROM seen LEFT JOIN loaded USING (hour, exchange)""")


@register("bronze_rejects", _w("""
    SELECT 'binance' AS exchange,
           CASE WHEN event_id % 17 = 0 THEN 'no_k' ELSE 'not_final' END AS reject_reason, count(*) AS records
    FROM events WHERE user_id % 2 = 0 AND (event_id % 17 = 0 OR event_id % 4 = 0) GROUP BY ALL
    UNION ALL
    SELECT 'kraken', 'missing_keys', count(*) FROM (
      SELECT event_id FROM events WHERE user_id % 2 = 1 AND event_id % 11 = 0
      UNION ALL SELECT event_id FROM events WHERE user_id % 2 = 1 AND event_id % 10 = 3) r
    HAVING count(*) > 0"""))
def q_bronze_rejects(spark, d):
    return (rejects(_envelopes(spark, d)).groupBy("exchange", "reject_reason")
            .agg(F.count(F.lit(1)).alias("records")))


REST_BINANCE_SQL = f"""
    SELECT 'binance' AS exchange, upper(event_type) || 'USDT' AS symbol, 60 AS interval_seconds,
           date_trunc('minute', ts) AS interval_start,
           date_trunc('minute', ts) + INTERVAL 59999 MILLISECOND AS interval_end,
           value AS open, value AS high, value AS low, value AS close, CAST(k AS DOUBLE) AS volume,
           CASE WHEN k > 0 THEN (value * k) / k END AS vwap, 1 AS trade_count,
           'binance_rest' AS source, ts AS ingestion_ts
    FROM {EV} e WHERE user_id % 2 = 0"""

REST_KRAKEN_SQL = f"""
    SELECT 'kraken' AS exchange, upper(event_type) || 'USD' AS symbol, 60 AS interval_seconds,
           date_trunc('minute', ts) AS interval_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS interval_end,
           value AS open, value AS high, value AS low, value AS close, CAST(k AS DOUBLE) AS volume,
           value AS vwap, 1 AS trade_count, 'kraken_rest' AS source, ts AS ingestion_ts
    FROM {EV} e WHERE user_id % 2 = 1"""


@register("rest_binance", _w(REST_BINANCE_SQL))
def q_rest_binance(spark, d):
    return parse_rest_binance(rest_responses(read_events(spark, d)))


@register("rest_kraken", _w(REST_KRAKEN_SQL))
def q_rest_kraken(spark, d):
    return parse_rest_kraken(rest_responses(read_events(spark, d)))


@register("rest_parse", _w(f"{REST_BINANCE_SQL} UNION ALL {REST_KRAKEN_SQL}"))
def q_rest_parse(spark, d):
    return parse_rest(rest_responses(read_events(spark, d)))


@register("landing_roundtrip", _w(WS_BRONZE_SQL))
def q_landing_roundtrip(spark, d):
    """Envelopes -> landing JSON in the shared scratch folder -> scan -> bronze."""
    root = shared_dir(spark, "landing")
    write_landing(_envelopes(spark, d), root)
    return to_bronze(read_landing(spark, root))


@register("variant_bronze", _w(WS_BRONZE_SQL))
def q_variant_bronze(spark, d):
    """Messages parsed on arrival, landed as VARIANT, and loaded from there without any JSON text."""
    path = shared_dir(spark, "variant_landing")
    ev = read_events(spark, d)
    write_variant_landing(variant_binance(binance_messages(ev)).unionByName(variant_kraken(kraken_messages(ev))), path)
    return variant_to_bronze(read_variant_landing(spark, path))


@register("new_landing_objects", _w(f"""
    SELECT part, count(*) AS rows, round(sum(volume), 4) AS volume
    FROM (SELECT *, CASE WHEN ingestion_ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN 'first' ELSE 'second' END AS part
          FROM ({WS_BRONZE_SQL}) b) p GROUP BY part"""))
def q_new_landing_objects(spark, d):
    """What each of two loads of a growing landing zone adds; the second one excludes the first one's objects.

    The envelopes of the first half of the time land, a load reads them, the
    others land, a second load finds them alone.
    """
    root, ledger, out = shared_dir(spark, "landing"), shared_dir(spark, "ledger"), shared_dir(spark, "loaded")
    lo, hi = value_bounds(read_events(spark, d), "ts")
    middle, env = F.lit(lo + (hi - lo) / 2), _envelopes(spark, d)
    parts = []
    for part, rows in (("first", env.where(F.col("event_ts") < middle)), ("second", env.where(F.col("event_ts") >= middle))):
        write_landing(rows, root)
        load = load_new(spark, root, ledger, out, to_bronze)
        parts.append(spark.read.parquet(f"{out}/load_id={load['load_id']}").withColumn("part", F.lit(part)))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("volume"), 4).alias("volume"))
