"""Adapter from the supplied ``events`` table to bronze candles.

The supplied tables hold no market data, so test and benchmark queries
derive bronze rows from ``events`` with fixed rules:

* exchange ``binance`` for even ``user_id``, else ``kraken``;
* symbol = ``event_type``, or, given ``pairs=``, the dimension row ``user_id % 30``;
* interval_start = ``date_trunc(grain, ts)``, interval_seconds = 60 or 3600;
* open = high = low = close = vwap = ``value``;
* volume = ``props.k``; trade_count = 1; ingestion_ts = ``ts``;
* source ``{exchange}_rest`` when ``event_id % 3 = 0``, else ``{exchange}_ws``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


GRAIN_SECONDS = {"minute": 60, "hour": 3600}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read ``events`` and cast its ``TIMESTAMP_NTZ`` once to ``TIMESTAMP`` (UTC)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def exchange_of_user() -> F.Column:
    return F.when(F.col("user_id") % 2 == 0, F.lit("binance")).otherwise(F.lit("kraken"))


def bronze_from_events(events: DataFrame, grain: str = "minute",
                       pairs: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped rows from ``events`` (see module doc).

    With ``pairs`` (the pair dimension) the series is the dimension row
    ``pair_id = user_id % 30`` instead of ``event_type``.
    """
    seconds = GRAIN_SECONDS[grain]
    start = F.date_trunc(grain, "ts")
    ev = events
    if pairs is not None:
        ev = (ev.withColumn("pair_id", (F.col("user_id") % 30).cast("int"))
                .join(pairs.select("pair_id", F.col("exchange").alias("_ex"),
                                   F.col("warehouse_symbol").alias("_sym")), "pair_id"))
        exchange, symbol = F.col("_ex"), F.col("_sym")
    else:
        exchange, symbol = exchange_of_user(), F.col("event_type")
    via_rest = F.col("event_id") % 3 == 0
    end = start + F.make_dt_interval(secs=F.lit(seconds))
    return ev.select(
        exchange.alias("exchange"),
        symbol.alias("symbol"),
        # the candle length, end - start (a column, so keys stay attributes
        # and downstream joins reuse the dedup's hash partitioning)
        (F.unix_seconds(end) - F.unix_seconds(start)).cast("int").alias("interval_seconds"),
        start.alias("interval_start"),
        end.alias("interval_end"),
        F.col("value").alias("open"),
        F.col("value").alias("high"),
        F.col("value").alias("low"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("value").alias("vwap"),
        F.lit(1).alias("trade_count"),
        F.concat(exchange, F.when(via_rest, F.lit("_rest")).otherwise(F.lit("_ws"))).alias("source"),
        F.col("ts").alias("ingestion_ts"),
    )


# --------------------------------------------------------------------------
# Exchange feeds derived from ``events`` (message and REST payload forms)
# --------------------------------------------------------------------------
#
# Binance WS (even user_id): one candle message per event, symbol
#   upper(event_type) || 'USDT'; k.x false when event_id % 4 = 0; no k at
#   all when event_id % 17 = 0; no q when event_id % 5 = 0.
# Kraken WS (odd user_id): one ohlc message per event, symbol
#   upper(event_type) || '/USD'; type 'update' when event_id % 4 = 0 else
#   'snapshot'; a second candle (next minute, prices + 1, 2 trades) when
#   event_id % 7 = 0; first candle without vwap when event_id % 11 = 0,
#   with "vwap": null when event_id % 13 = 0; an extra heartbeat when
#   event_id % 10 = 1 and an extra status message when event_id % 10 = 3.
# REST: one response per event with the event's minute, both exchanges.


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


def binance_messages(events: DataFrame) -> DataFrame:
    """Raw Binance candle messages ``(symbol, interval_minutes, msg)``."""
    ev = events.where(F.col("user_id") % 2 == 0)
    minute = F.date_trunc("minute", "ts")
    t = F.unix_millis(minute)
    px = F.col("value").cast("string")
    k = F.named_struct(
        F.lit("t"), t, F.lit("T"), t + 59_999, F.lit("x"), F.col("event_id") % 4 != 0,
        F.lit("o"), px, F.lit("h"), px, F.lit("l"), px, F.lit("c"), px,
        F.lit("v"), _k().cast("string"),
        F.lit("q"), F.when(F.col("event_id") % 5 != 0, (F.col("value") * _k()).cast("string")),
        F.lit("n"), F.lit(1))
    msg = F.to_json(F.struct(F.unix_millis("ts").alias("E"),
                             F.when(F.col("event_id") % 17 != 0, k).alias("k")))
    return ev.select(F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"),
                     F.lit(1).alias("interval_minutes"), msg.alias("msg"))


def _iso(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def kraken_messages(events: DataFrame) -> DataFrame:
    """Raw Kraken messages ``(symbol, interval_minutes, received_ts, msg)``."""
    ev = events.where(F.col("user_id") % 2 == 1)
    eid = F.col("event_id")
    minute = F.date_trunc("minute", "ts")
    one = F.make_dt_interval(mins=F.lit(1))

    def candle(start, price, trades, vwap):
        return F.struct(_iso(start).alias("interval_begin"), _iso(start + one).alias("timestamp"),
                        price.alias("open"), price.alias("high"), price.alias("low"),
                        price.alias("close"), _k().cast("double").alias("volume"),
                        vwap.alias("vwap"), F.lit(trades).alias("trades"))

    vwap = F.when((eid % 13 != 0) & (eid % 11 != 0), F.col("value"))
    first = F.to_json(candle(minute, F.col("value"), 1, vwap), {"ignoreNullFields": "false"})
    first = F.when(eid % 11 == 0, F.regexp_replace(first, r',"vwap":null', "")).otherwise(first)
    second = F.to_json(candle(minute + one, F.col("value") + 1, 2, F.col("value") + 1))
    data = F.when(eid % 7 == 0, F.concat(F.lit("["), first, F.lit(","), second, F.lit("]"))) \
            .otherwise(F.concat(F.lit("["), first, F.lit("]")))
    ohlc = F.concat(F.lit('{"channel":"ohlc","type":"'),
                    F.when(eid % 4 == 0, F.lit("update")).otherwise(F.lit("snapshot")),
                    F.lit('","timestamp":"'), _iso("ts"), F.lit('","data":'), data, F.lit("}"))
    extra = (F.when(eid % 10 == 1, F.lit('{"channel":"heartbeat"}'))
              .when(eid % 10 == 3, F.lit('{"channel":"status","data":[{"system":"online"}]}')))
    msgs = F.filter(F.array(ohlc, extra), lambda m: m.isNotNull())
    return ev.select(F.concat(F.upper("event_type"), F.lit("/USD")).alias("symbol"),
                     F.lit(1).alias("interval_minutes"), F.col("ts").alias("received_ts"),
                     F.explode(msgs).alias("msg"))


def rest_responses(events: DataFrame, *keep: str) -> DataFrame:
    """Landed REST responses ``(exchange, pair, fetched_ts, body)``, one per event, and columns to ``keep``."""
    minute = F.date_trunc("minute", "ts")
    t = F.unix_millis(minute)
    px = F.col("value").cast("string")
    k = _k()
    binance = F.format_string('[[%d,"%s","%s","%s","%s","%s",%d,"%s",%d]]',
                              t, px, px, px, px, k.cast("double").cast("string"), t + 59_999,
                              (F.col("value") * k).cast("string"), F.lit(1))
    pair_key = F.concat(F.lit("X"), F.upper("event_type"), F.lit("ZUSD"))
    kraken = F.format_string('{"error":[],"result":{"%s":[[%d,"%s","%s","%s","%s","%s","%s",%d]],"last":%d}}',
                             pair_key, F.unix_seconds(minute), px, px, px, px, px,
                             k.cast("double").cast("string"), F.lit(1), F.unix_seconds(minute) + 60)
    is_b = F.col("user_id") % 2 == 0
    return events.select(
        exchange_of_user().alias("exchange"),
        F.when(is_b, F.concat(F.upper("event_type"), F.lit("USDT")))
         .otherwise(F.concat(F.upper("event_type"), F.lit("/USD"))).alias("pair"),
        F.col("ts").alias("fetched_ts"),
        F.when(is_b, binance).otherwise(kraken).alias("body"), *keep)


def faulty_rest_responses(events: DataFrame) -> DataFrame:
    """``rest_responses`` with broken bodies at fixed ``event_id`` residues.

    ``% 19 = 0``: an error object (Binance) or no result (Kraken);
    ``% 23 = 1``: text cut off before its end; ``% 29 = 2``: an HTML page.
    """
    eid, is_b, body = F.col("event_id"), F.col("exchange") == "binance", F.col("body")
    broken = (F.when(eid % 19 == 0, F.when(is_b, F.lit('{"code":-1121,"msg":"Invalid symbol."}')).otherwise(F.lit('{"error":[]}')))
               .when(eid % 23 == 1, F.substr(body, F.lit(1), F.length(body) - 4))
               .when(eid % 29 == 2, F.lit("<html>busy</html>"))
               .otherwise(body))
    return rest_responses(events, "event_id").withColumn("body", broken).drop("event_id")


DENSE_START = "2025-01-01 00:00:00"


def dense_bronze(events: DataFrame, pairs: DataFrame) -> DataFrame:
    """A gapless market: event ``i`` is minute ``i div 4`` of series ``i % 4``.

    The series are the first four rows of the pair dimension. Series 3 lacks
    minute 17 of every third hour, so complete and incomplete hours both occur.
    """
    minute = F.floor(F.col("event_id") / 4).cast("long")
    hole = (F.col("event_id") % 4 == 3) & (F.floor(minute / 60) % 3 == 1) & (minute % 60 == 17)
    start = F.timestamp_seconds(F.unix_seconds(F.lit(DENSE_START).cast("timestamp")) + minute * 60)
    ev = events.where(~hole).withColumn("pair_id", (F.col("event_id") % 4).cast("int")).join(
        pairs.select("pair_id", "exchange", F.col("warehouse_symbol").alias("symbol")), "pair_id")
    px = F.col("value")
    return ev.select(
        "exchange", "symbol", F.lit(60).alias("interval_seconds"), start.alias("interval_start"),
        (start + F.expr("INTERVAL 1 MINUTE")).alias("interval_end"),
        *[px.alias(c) for c in ("open", "high", "low", "close")], _k().cast("double").alias("volume"), px.alias("vwap"),
        F.lit(1).alias("trade_count"), F.concat("exchange", F.lit("_ws")).alias("source"),
        (start + F.expr("INTERVAL 61 SECONDS")).alias("ingestion_ts"))
