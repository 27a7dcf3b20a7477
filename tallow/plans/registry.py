"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole supplied
tables. The oracle text computes the same result independently in
DuckDB from the raw ``events`` view (tables are pre-registered views).

This module holds the dedup/silver/gold/gap/quality/calendar queries;
``parse_queries`` adds the message, REST and landing ones and
``stream_queries`` the streaming ones. ``catalog`` imports all three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import hours
from ..operators import (alerts, append_missing, backfill_plan, bronze_union, completeness_of,
                         dedup_latest, fetch_plan, gap_fill_of, gap_ranges, gap_report_of, gap_report_weighted, gaps_of,
                         health_report, hour_ok_of, hourly_counts, lag_quantiles, lag_sketches, merge_changes, merge_silver, minute_masks, refresh, rest_gap_fill, rollup,
                         to_silver, upsert, with_canonical_symbol)
from ..operators.calendar import partition_calendar, ready_partitions
from ..operators.quality import LAG_RANK_ERROR, lag_us
from ..schemas import REFERENCE_UPDATE_COLS
from ..session import shared_dir
from ..sources.bucketed import merge_bucketed, write_bucketed
from ..sources.pairs import pair_dimension, pair_rows
from . import inputs as I

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# Oracle building blocks (DuckDB SQL text)
# --------------------------------------------------------------------------

EXCHANGE_SQL = "CASE WHEN user_id % 2 = 0 THEN 'binance' ELSE 'kraken' END"


def bronze_sql(grain: str = "minute", by_pair: bool = False) -> str:
    secs = {"minute": 60, "hour": 3600}[grain]
    if by_pair:
        values = ", ".join(f"({r[0]}, '{r[1]}', '{r[5]}')" for r in pair_rows())
        src = (f"(SELECT e.*, p.ex AS _ex, p.sym AS _sym FROM events e JOIN "
               f"(VALUES {values}) p(pair_id, ex, sym) ON p.pair_id = e.user_id % 30)")
        ex, sym = "_ex", "_sym"
    else:
        src, ex, sym = "events", EXCHANGE_SQL, "event_type"
    return f"""
    SELECT {ex} AS exchange, {sym} AS symbol, {secs} AS interval_seconds,
           date_trunc('{grain}', ts) AS interval_start,
           date_trunc('{grain}', ts) + INTERVAL {secs} SECOND AS interval_end,
           value AS open, value AS high, value AS low, value AS close,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
           value AS vwap, 1 AS trade_count,
           {ex} || CASE WHEN event_id % 3 = 0 THEN '_rest' ELSE '_ws' END AS source,
           ts AS ingestion_ts
    FROM {src}"""


def dedup_sql(src: str) -> str:
    """The row that arrived last, by ``arg_max`` over whole rows."""
    return f"""
    SELECT unnest(latest) FROM (
      SELECT arg_max(b, ROW(b.ingestion_ts, b.source, b.interval_end, b.open, b.volume)) AS latest
      FROM ({src}) b
      GROUP BY b.exchange, b.symbol, b.interval_seconds, b.interval_start) d"""


def silver_sql(src: str) -> str:
    return f"""
    SELECT exchange, symbol, 'USD' AS quote_asset, interval_seconds, interval_start,
           interval_end, open, high, low, close, volume, volume * close AS quote_volume,
           trade_count, vwap, source, ingestion_ts
    FROM ({src}) s"""


def gold_sql(src: str, minutes: int) -> str:
    """Totals per bucket, joined to the candles of its first and last minute."""
    return f"""
    SELECT t.exchange, t.symbol, t.bucket AS interval_start, t.bucket + INTERVAL {minutes} MINUTE AS interval_end,
           f.open, t.high, t.low, l.close, t.volume, t.quote_volume, t.trade_count, 'derived' AS source, t.ingestion_ts
    FROM (SELECT exchange, symbol, time_bucket(INTERVAL {minutes} MINUTE, interval_start) AS bucket,
                 min(interval_start) AS first_minute, max(interval_start) AS last_minute,
                 max(high) AS high, min(low) AS low, sum(volume) AS volume,
                 round(sum(quote_volume), 6) AS quote_volume, CAST(sum(trade_count) AS BIGINT) AS trade_count,
                 max(ingestion_ts) AS ingestion_ts
          FROM ({src}) c GROUP BY ALL) t
    JOIN ({src}) f ON f.exchange = t.exchange AND f.symbol = t.symbol AND f.interval_start = t.first_minute
    JOIN ({src}) l ON l.exchange = t.exchange AND l.symbol = t.symbol AND l.interval_start = t.last_minute"""


B_MIN = bronze_sql("minute")
B_HOUR = bronze_sql("hour")
B_PAIR = bronze_sql("minute", by_pair=True)
S_MIN = silver_sql(dedup_sql(B_MIN))
S_PAIR = silver_sql(dedup_sql(B_PAIR))


def _w(sql: str) -> str:
    return " ".join(sql.split())


# --------------------------------------------------------------------------
# Dedup, silver, merge
# --------------------------------------------------------------------------

@register("dedup_latest", _w(dedup_sql(B_HOUR)))
def q_dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    return dedup_latest(I.bronze(spark, d, "hour"))


@register("silver_project", _w(S_MIN))
def q_silver_project(spark, d):
    return to_silver(dedup_latest(I.bronze(spark, d, "minute")))


def merge_sql(update_cols=None) -> str:
    src = silver_sql(dedup_sql(B_HOUR))
    tgt = silver_sql(dedup_sql(f"SELECT * FROM ({B_HOUR}) x WHERE source LIKE '%\\_rest' ESCAPE '\\'"))
    cols = ["quote_asset", "interval_end", "open", "high", "low", "close", "volume",
            "quote_volume", "trade_count", "vwap", "source", "ingestion_ts"]
    upd = set(cols if update_cols is None else update_cols)
    sel = []
    for c in cols:
        if c in upd:
            sel.append(f"CASE WHEN t.exchange IS NULL OR s.ingestion_ts > t.ingestion_ts "
                       f"THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t.exchange IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    return _w(f"""
    SELECT coalesce(t.exchange, s.exchange) AS exchange, coalesce(t.symbol, s.symbol) AS symbol,
           coalesce(t.interval_seconds, s.interval_seconds) AS interval_seconds,
           coalesce(t.interval_start, s.interval_start) AS interval_start, {", ".join(sel)}
    FROM ({tgt}) t FULL OUTER JOIN ({src}) s
      ON t.exchange = s.exchange AND t.symbol = s.symbol
     AND t.interval_seconds = s.interval_seconds AND t.interval_start = s.interval_start""")


def _merge_inputs(spark, d):
    b = I.bronze(spark, d, "hour")
    target = to_silver(dedup_latest(b.where(F.col("source").endswith("_rest"))))
    return target, dedup_latest(b)


@register("silver_merge", merge_sql())
def q_silver_merge(spark, d):
    target, source = _merge_inputs(spark, d)
    return merge_silver(target, source)


@register("silver_merge_reference_cols", merge_sql(REFERENCE_UPDATE_COLS))
def q_silver_merge_reference_cols(spark, d):
    target, source = _merge_inputs(spark, d)
    return merge_silver(target, source, update_cols=REFERENCE_UPDATE_COLS)


@register("silver_merge_bucketed", merge_sql())
def q_silver_merge_bucketed(spark, d):
    """The same merge into silver stored in buckets of its key: only the source is shuffled."""
    target, source = _merge_inputs(spark, d)
    path = shared_dir(spark, "silver_buckets")
    table = f"silver_{path.rsplit('/', 1)[-1]}"
    write_bucketed(target, table, 4 * spark.sparkContext.defaultParallelism, path)
    return merge_bucketed(spark, table, source)


# --------------------------------------------------------------------------
# Gold
# --------------------------------------------------------------------------

def _gold_query(minutes: int):
    def q(spark, d):
        return I.round_cols(rollup(I.silver(spark, d, "minute"), minutes), {"quote_volume"})
    return q


for _name, _m in (("gold_5m", 5), ("gold_15m", 15), ("gold_30m", 30), ("gold_1h", 60)):
    register(_name, _w(gold_sql(S_MIN, _m)))(_gold_query(_m))

S_MIN_WS = silver_sql(dedup_sql(f"SELECT * FROM ({B_MIN}) x WHERE source LIKE '%\\_ws' ESCAPE '\\'"))


@register("gold_upsert", _w(f"""
    WITH tgt AS ({gold_sql(S_MIN, 60)}), src AS ({gold_sql(S_MIN_WS, 60)})
    SELECT * FROM tgt WHERE NOT EXISTS (
      SELECT 1 FROM src WHERE src.exchange = tgt.exchange AND src.symbol = tgt.symbol
        AND src.interval_start = tgt.interval_start)
    UNION ALL SELECT * FROM src"""))
def q_gold_upsert(spark, d):
    target = rollup(I.silver(spark, d, "minute"), 60)
    source = rollup(I.silver(spark, d, "minute", source_suffix="_ws"), 60)
    return I.round_cols(upsert(target, source), {"quote_volume"})


# --------------------------------------------------------------------------
# Change set of a merge, and gold rebuilt from it
# --------------------------------------------------------------------------

# Stored silver: the rows that arrived before noon, and all REST rows; the source
# brings what arrived from 10:00 on. So some keys are new, some newer, some known.
def stored_sql(src: str) -> str:
    return silver_sql(dedup_sql(f"SELECT * FROM ({src}) x WHERE hour(ingestion_ts) < 12 OR source LIKE '%\\_rest' ESCAPE '\\'"))


def arrived_sql(src: str) -> str:
    return silver_sql(dedup_sql(f"SELECT * FROM ({src}) x WHERE hour(ingestion_ts) >= 10"))


CHANGES_SQL = f"""
    WITH t AS ({stored_sql(B_HOUR)}), s AS ({arrived_sql(B_HOUR)}),
    judged AS (
      SELECT t, s, CASE WHEN t.exchange IS NULL THEN 'insert'
                        WHEN s.ingestion_ts > t.ingestion_ts THEN 'update' ELSE 'unchanged' END AS change
      FROM t FULL JOIN s USING (exchange, symbol, interval_seconds, interval_start))"""


def _stored_and_arrived(spark, d, grain: str):
    b = I.bronze(spark, d, grain)
    stored = b.where((F.hour("ingestion_ts") < 12) | F.col("source").endswith("_rest"))
    return to_silver(dedup_latest(stored)), dedup_latest(b.where(F.hour("ingestion_ts") >= 10))


@register("silver_changes", _w(CHANGES_SQL + """
    SELECT unnest(CASE WHEN change = 'unchanged' THEN t ELSE s END), change FROM judged"""))
def q_silver_changes(spark, d):
    """The merged rows, each with what the merge did to its key."""
    return merge_changes(*_stored_and_arrived(spark, d, "hour"))


@register("gold_touched", _w(gold_sql(S_MIN, 15)))
def q_gold_touched(spark, d):
    """Stored 15-minute candles brought up to date from the merge's change set alone."""
    stored, arrived = _stored_and_arrived(spark, d, "minute")
    return I.round_cols(refresh(rollup(stored, 15), merge_changes(stored, arrived), 15), {"quote_volume"})


# --------------------------------------------------------------------------
# Bronze set operations and WS gap fill
# --------------------------------------------------------------------------

@register("bronze_union", _w(f"""
    SELECT * FROM ({B_MIN}) a WHERE source LIKE '%\\_ws' ESCAPE '\\'
    UNION ALL SELECT * FROM ({B_MIN}) b WHERE source LIKE '%\\_rest' ESCAPE '\\'"""))
def q_bronze_union(spark, d):
    b = I.bronze(spark, d, "minute")
    return bronze_union(b.where(F.col("source").endswith("_ws")),
                        b.where(F.col("source").endswith("_rest")))


@register("append_missing", _w(f"""
    WITH b AS ({B_MIN}), fresh AS (
      SELECT * FROM b WHERE NOT EXISTS (
        SELECT 1 FROM b e WHERE e.source LIKE '%\\_ws' ESCAPE '\\' AND e.exchange = b.exchange
          AND e.symbol = b.symbol AND e.interval_seconds = b.interval_seconds
          AND e.interval_start = b.interval_start AND e.source = b.source))
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY exchange, symbol, interval_seconds,
        interval_start, source ORDER BY ingestion_ts DESC) AS rn FROM fresh) x
    WHERE rn = 1"""))
def q_append_missing(spark, d):
    b = I.bronze(spark, d, "minute")
    return append_missing(b.where(F.col("source").endswith("_ws")), b)


# A calendar of every series and minute, less the minutes that have a WS row.
GAPS_SQL = f"""
    WITH b AS ({B_MIN}),
    calendar AS (
      SELECT exchange, symbol, unnest(range(lo, hi, INTERVAL 1 MINUTE)) AS interval_start
      FROM (SELECT DISTINCT exchange, symbol FROM b),
           (SELECT date_trunc('hour', min(interval_start)) AS lo,
                   date_trunc('hour', max(interval_start)) + INTERVAL 1 HOUR AS hi FROM b)),
    gaps AS (
      SELECT exchange, symbol, interval_start FROM calendar
      EXCEPT
      SELECT exchange, symbol, interval_start FROM b WHERE source LIKE '%\\_ws' ESCAPE '\\')"""


def _masks(spark, d):
    """Minute masks per series and hour, the series, and the hours of the data."""
    b = I.bronze(spark, d, "minute")
    return minute_masks(b), I.series_of(b), *I.event_hours(spark, d)


def _gaps(spark, d):
    return gaps_of(*_masks(spark, d))


@register("ws_gaps", _w(GAPS_SQL + " SELECT * FROM gaps"))
def q_ws_gaps(spark, d):
    return _gaps(spark, d)


@register("rest_gap_fill", _w(GAPS_SQL + """
    SELECT * FROM b WHERE source LIKE '%\\_rest' ESCAPE '\\' AND EXISTS (
      SELECT 1 FROM gaps g WHERE g.exchange = b.exchange AND g.symbol = b.symbol
        AND g.interval_start = b.interval_start)"""))
def q_rest_gap_fill(spark, d):
    b = I.bronze(spark, d, "minute")
    return rest_gap_fill(b.where(F.col("source").endswith("_rest")), _gaps(spark, d))


@register("gap_fill_check", _w(GAPS_SQL + """,
    filled_bronze AS (
      SELECT * FROM b WHERE source LIKE '%\\_ws' ESCAPE '\\'
      UNION ALL
      SELECT * FROM b WHERE source LIKE '%\\_rest' ESCAPE '\\' AND EXISTS (
        SELECT 1 FROM gaps g WHERE g.exchange = b.exchange AND g.symbol = b.symbol
          AND g.interval_start = b.interval_start)),
    filled AS (SELECT f.exchange, f.symbol, count(DISTINCT f.interval_start) AS filled_minutes
               FROM filled_bronze f JOIN gaps g USING (exchange, symbol, interval_start)
               GROUP BY f.exchange, f.symbol),
    missing AS (SELECT exchange, symbol, count(*) AS ws_missing FROM gaps GROUP BY exchange, symbol)
    SELECT m.exchange, m.symbol, m.ws_missing, coalesce(f.filled_minutes, 0) AS filled_minutes
    FROM missing m LEFT JOIN filled f USING (exchange, symbol)"""))
def q_gap_fill_check(spark, d):
    return gap_fill_of(*_masks(spark, d))


# Missing minutes of all 30 series; a range is a run of minutes whose distance to
# their rank is the same.
FETCH_SQL = f"""
    WITH b AS ({B_PAIR}),
    dim(exchange, symbol, pair) AS (VALUES {", ".join(f"('{r[1]}', '{r[5]}', '{r[3]}')" for r in pair_rows())}),
    gaps AS (
      SELECT exchange, symbol, unnest(range(lo, hi, INTERVAL 1 MINUTE)) AS minute
      FROM (SELECT exchange, symbol FROM dim),
           (SELECT date_trunc('hour', min(interval_start)) AS lo,
                   date_trunc('hour', max(interval_start)) + INTERVAL 1 HOUR AS hi FROM b)
      EXCEPT SELECT exchange, symbol, interval_start FROM b WHERE source LIKE '%\\_ws' ESCAPE '\\'),
    ranked AS (SELECT *, minute - to_minutes(row_number() OVER (PARTITION BY exchange, symbol ORDER BY minute)) AS run FROM gaps),
    ranges AS (SELECT exchange, symbol, min(minute) AS start, max(minute) + INTERVAL 1 MINUTE AS "end", count(*) AS minutes
               FROM ranked GROUP BY exchange, symbol, run)
    SELECT r.exchange, r.symbol, r.start, r."end", r.minutes, CAST(skip // 1000 + 1 AS INTEGER) AS page,
           r.start + to_minutes(skip) AS fetch_start, least(r."end", r.start + to_minutes(skip + 1000)) AS fetch_end, d.pair AS rest_pair
    FROM (SELECT *, unnest(range(0, minutes, 1000)) AS skip FROM ranges) r JOIN dim d USING (exchange, symbol)"""


@register("rest_fetch_plan", _w(FETCH_SQL))
def q_rest_fetch_plan(spark, d):
    """What to ask the REST endpoints for: the gaps of every series of the dimension, in pages."""
    pairs = pair_dimension(spark).select("exchange", F.col("warehouse_symbol").alias("symbol"), "rest_pair")
    masks = minute_masks(I.bronze(spark, d, "minute", by_pair=True))
    return fetch_plan(gap_ranges(masks, pairs, *I.event_hours(spark, d))).join(pairs, ["exchange", "symbol"])


# --------------------------------------------------------------------------
# Gap report, weighted gap report, backfill plan
# --------------------------------------------------------------------------

# Hours of the calendar, each with 60 less its distinct minutes.
GAP_REPORT_SQL = f"""
    WITH s AS ({S_MIN}),
    hours AS (
      SELECT exchange, symbol, unnest(range(lo, hi, INTERVAL 1 HOUR)) AS hour
      FROM (SELECT DISTINCT exchange, symbol FROM s),
           (SELECT date_trunc('hour', min(interval_start)) AS lo,
                   date_trunc('hour', max(interval_start)) + INTERVAL 1 HOUR AS hi FROM s)),
    missing AS (
      SELECT hours.exchange, hours.symbol, hours.hour, 60 - count(DISTINCT s.interval_start) AS missing_minutes
      FROM hours LEFT JOIN s ON s.exchange = hours.exchange AND s.symbol = hours.symbol
                            AND date_trunc('hour', s.interval_start) = hours.hour
      GROUP BY ALL)"""


def _gap_report(spark, d):
    masks = minute_masks(I.silver(spark, d, "minute")).withColumn("present", F.bit_count("held"))
    return gap_report_of(masks, I.series_of(I.bronze(spark, d, "minute")), *I.event_hours(spark, d))


@register("gap_report", _w(GAP_REPORT_SQL + """
    SELECT * FROM missing WHERE missing_minutes > 0 ORDER BY hour DESC"""))
def q_gap_report(spark, d):
    return _gap_report(spark, d)


@register("gap_report_weighted", _w(f"""
    SELECT exchange, symbol, hour, CAST(sum(60 - present) AS BIGINT) AS missing_minutes
    FROM (SELECT exchange, symbol, date_trunc('hour', interval_start) AS hour,
                 count(DISTINCT interval_start) OVER (
                   PARTITION BY exchange, symbol, date_trunc('hour', interval_start)) AS present
          FROM ({S_MIN}) s) per_row
    GROUP BY ALL HAVING sum(60 - present) > 0"""))
def q_gap_report_weighted(spark, d):
    b = I.bronze(spark, d, "minute")
    return gap_report_weighted(to_silver(dedup_latest(b)), I.value_bounds(b, "interval_start")[0])


@register("backfill_plan", _w(GAP_REPORT_SQL + """
    SELECT DISTINCT strftime(hour, '%Y-%m-%d-%H:00') AS partition_key
    FROM missing WHERE missing_minutes > 0 ORDER BY partition_key"""))
def q_backfill_plan(spark, d):
    return backfill_plan(_gap_report(spark, d))


# --------------------------------------------------------------------------
# Completeness, hour check, alerts, health, dimension lookup
# --------------------------------------------------------------------------

PAIRS_SQL = "(VALUES " + ", ".join(f"('{r[1]}', '{r[5]}')" for r in pair_rows()) + ") p(exchange, symbol)"

COMPLETENESS_SQL = f"""
    WITH s AS ({S_PAIR}),
    bounds AS (SELECT date_trunc('hour', min(interval_start)) AS lo,
                      date_trunc('hour', max(interval_start)) AS hi FROM s),
    hrs AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM bounds),
    counts AS (SELECT exchange, symbol, date_trunc('hour', interval_start) AS hour,
                      count(DISTINCT interval_start) AS minutes FROM s GROUP BY ALL),
    comp AS (
      SELECT p.exchange, p.symbol, h.hour, coalesce(c.minutes, 0) AS minutes,
             coalesce(c.minutes, 0) = 60 AS ok
      FROM {PAIRS_SQL} CROSS JOIN hrs h LEFT JOIN counts c
        ON c.exchange = p.exchange AND c.symbol = p.symbol AND c.hour = h.hour),
    hour_counts AS (SELECT date_trunc('hour', interval_start) AS hour, count(interval_start) AS rows
                    FROM s GROUP BY ALL),
    hok AS (SELECT h.hour, coalesce(c.rows, 0) AS rows, 1800 AS expected,
                   coalesce(c.rows, 0) = 1800 AS ok
            FROM hrs h LEFT JOIN hour_counts c USING (hour))"""


def _pair_counts(spark, d):
    return hourly_counts(I.silver(spark, d, "minute", by_pair=True))


@register("completeness", _w(COMPLETENESS_SQL + " SELECT * FROM comp"))
def q_completeness(spark, d):
    return completeness_of(_pair_counts(spark, d), pair_dimension(spark), *I.event_hours(spark, d))


@register("hour_ok", _w(COMPLETENESS_SQL + " SELECT hour, rows, CAST(expected AS BIGINT) AS expected, ok FROM hok"))
def q_hour_ok(spark, d):
    return hour_ok_of(_pair_counts(spark, d), pair_dimension(spark), *I.event_hours(spark, d))


@register("alerts", _w(COMPLETENESS_SQL + """,
    gaps AS (SELECT exchange, symbol, hour, 60 - minutes AS missing_minutes FROM comp WHERE minutes < 60)
    SELECT 'incomplete' AS kind, exchange, symbol, hour,
           format('{} {} {}: {}/60', exchange, symbol, strftime(hour, '%Y-%m-%d %H:00'), minutes) AS text
    FROM comp WHERE NOT ok
    UNION ALL
    SELECT 'gap', exchange, symbol, hour,
           format('{} {} {} missing {}/60', exchange, symbol, strftime(hour, '%Y-%m-%d %H:00'), missing_minutes)
    FROM gaps
    UNION ALL
    SELECT 'ok', NULL, NULL, hour, format('ok {}', strftime(hour, '%Y-%m-%d %H:00')) FROM hok WHERE ok"""))
def q_alerts(spark, d):
    counts, (lo, hi) = _pair_counts(spark, d), I.event_hours(spark, d)
    pairs = pair_dimension(spark)
    gaps = gap_report_of(counts, pairs.select("exchange", F.col("warehouse_symbol").alias("symbol")), lo, hi)
    return alerts(completeness_of(counts, pairs, lo, hi), gaps, hour_ok_of(counts, pairs, lo, hi))


@register("health_report", _w(f"""
    WITH s AS ({S_MIN})
    SELECT exchange, symbol, date_trunc('hour', interval_start) AS hour,
           count(*) AS candles, count(DISTINCT interval_start) AS minutes,
           count(DISTINCT interval_start) / 60.0 AS completeness,
           count(*) FILTER (WHERE source LIKE '%\\_ws' ESCAPE '\\') AS ws_rows,
           count(*) FILTER (WHERE source LIKE '%\\_rest' ESCAPE '\\') AS rest_rows,
           max(high) AS high, min(low) AS low,
           sum(volume) AS volume, round(sum(quote_volume), 6) AS quote_volume,
           CASE WHEN sum(volume) > 0 THEN round(sum(quote_volume), 6) / sum(volume) END AS vwap,
           max(epoch_us(ingestion_ts) - epoch_us(interval_end)) / 1000000.0 AS max_lag_seconds
    FROM s GROUP BY ALL"""))
def q_health_report(spark, d):
    # vwap is re-derived from the rounded quote volume so it does not depend
    # on the order in which either engine adds the doubles
    h = I.round_cols(health_report(I.silver(spark, d, "minute")), {"quote_volume"})
    return h.withColumn("vwap", F.when(F.col("volume") > 0, F.col("quote_volume") / F.col("volume")))


@register("lag_quantiles", _w(f"""
    SELECT exchange, symbol, date_trunc('day', interval_start) AS day, count(*) AS candles, quantile, TRUE AS within_bound
    FROM ({S_MIN}) s, (VALUES (CAST(0.5 AS DOUBLE)), (0.9), (0.99)) q(quantile)
    GROUP BY ALL"""))
def q_lag_quantiles(spark, d):
    """Day quantiles of the ingestion lag from hourly sketches, and whether their exact ranks are within the bound."""
    silver = I.silver(spark, d, "minute").withColumn("span", F.date_trunc("day", "interval_start")).withColumn("us", lag_us())
    found = lag_quantiles(lag_sketches(silver), F.date_trunc("day", "hour"))
    key = ["exchange", "symbol", "span"]
    ranks = silver.select(*key, "us").join(found, key).groupBy(*key, "candles", "quantile").agg(
        (F.count_if(F.col("us") < F.col("lag_us")) / F.col("candles")).alias("below"),
        (F.count_if(F.col("us") <= F.col("lag_us")) / F.col("candles")).alias("upto"))
    within = (F.col("below") <= F.col("quantile") + LAG_RANK_ERROR) & (F.col("upto") >= F.col("quantile") - LAG_RANK_ERROR)
    return ranks.select("exchange", "symbol", F.col("span").alias("day"), "candles", "quantile", within.alias("within_bound"))


@register("canonical_symbol", _w(f"""
    WITH b AS ({B_PAIR}),
    dim AS (VALUES {", ".join(f"('{r[1]}', '{r[5]}', '{r[2]}')" for r in pair_rows())})
    SELECT b.*, dim.col2 AS canonical_symbol FROM b LEFT JOIN dim
      ON dim.col0 = b.exchange AND dim.col1 = b.symbol"""))
def q_canonical_symbol(spark, d):
    return with_canonical_symbol(I.bronze(spark, d, "minute", by_pair=True), pair_dimension(spark))


# --------------------------------------------------------------------------
# Partition calendar and readiness
# --------------------------------------------------------------------------

CALENDAR_SQL = f"""
    WITH b AS ({B_MIN}),
    bounds AS (SELECT date_trunc('hour', min(ingestion_ts)) - INTERVAL 24 HOUR AS lo,
                      date_trunc('hour', max(ingestion_ts)) + INTERVAL 72 HOUR AS hi,
                      max(ingestion_ts) AS as_of FROM b),
    cal AS (SELECT unnest(generate_series(lo, hi - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_start FROM bounds),
    counts AS (SELECT date_trunc('hour', interval_start) AS hour_start, count(*) AS bronze_rows
               FROM b GROUP BY ALL),
    report AS (
      SELECT c.hour_start, c.hour_start + INTERVAL 1 HOUR AS hour_end,
             strftime(c.hour_start, '%Y-%m-%d-%H:%M') AS partition_key,
             strftime(c.hour_start, '%Y_%m_%d_%H') AS partition_name,
             coalesce(n.bronze_rows, 0) AS bronze_rows
      FROM cal c LEFT JOIN counts n USING (hour_start))"""


def _calendar(spark, d):
    """The calendar around the data with bronze rows per hour, and the last ingestion time."""
    bronze = I.bronze(spark, d, "minute")
    counts = bronze.groupBy(F.date_trunc("hour", "interval_start").alias("hour_start")).agg(F.count(F.lit(1)).alias("bronze_rows"))
    first, last = I.value_bounds(bronze, "ingestion_ts")
    lo = F.date_trunc("hour", F.lit(first)) - hours(24)
    hi = F.date_trunc("hour", F.lit(last)) + hours(72)
    cal = (partition_calendar(spark, lo, hi).join(counts, "hour_start", "left")
           .withColumn("bronze_rows", F.coalesce("bronze_rows", F.lit(0)).cast("long")))
    return cal, last


@register("partition_calendar", _w(CALENDAR_SQL + " SELECT * FROM report"))
def q_partition_calendar(spark, d):
    return _calendar(spark, d)[0]


@register("ready_partitions", _w(CALENDAR_SQL + """
    SELECT * FROM report
    WHERE (SELECT as_of FROM bounds) >= hour_start + INTERVAL 1 HOUR + INTERVAL 3 MINUTE"""))
def q_ready_partitions(spark, d):
    cal, last = _calendar(spark, d)
    return ready_partitions(cal, last, delay_minutes=3)

