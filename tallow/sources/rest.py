"""Landed REST responses -> bronze rows.

Input: ``(exchange, pair, fetched_ts, body)``, one HTTP response body per
row. ``ingestion_ts`` is the fetch time. Each body is parsed once and becomes
an array of candles, exploded once, or a reason why it has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import minutes
from ..schemas import BRONZE_COLS
from .tables import ts_lit

ROWS = "array<array<string>>"


def _candle(start, end, o, h, l, c, v, vwap, n) -> Column:
    return F.struct(start.alias("interval_start"), end.alias("interval_end"),
                    o.cast("double").alias("open"), h.cast("double").alias("high"),
                    l.cast("double").alias("low"), c.cast("double").alias("close"),
                    v.cast("double").alias("volume"), vwap.alias("vwap"),
                    n.cast("int").alias("trade_count"))


def _binance_candles(rows: Column, reference_vwap: bool) -> Column:
    # 0 open ms, 1-4 OHLC, 5 volume, 6 close ms, 7 quote volume, 8 trades
    def one(k):
        v, q = k[5].cast("double"), k[7].cast("double")
        vwap = q if reference_vwap else F.when(v > 0, q / v)
        return _candle(F.timestamp_millis(k[0].cast("long")), F.timestamp_millis(k[6].cast("long")),
                       k[1], k[2], k[3], k[4], k[5], vwap, k[8])
    return F.transform(rows, one)


def _kraken_candles(series: Column) -> Column:
    # [0 time s, 1-4 OHLC, 5 vwap, 6 volume, 7 trades]
    def one(t):
        start = F.timestamp_seconds(t[0].cast("long"))
        return _candle(start, start + minutes(1), t[1], t[2], t[3], t[4], t[6],
                       t[5].cast("double"), t[7])
    return F.flatten(F.transform(series, lambda s: F.transform(s, one)))


def _checked(resp: DataFrame) -> DataFrame:
    """``resp`` with each body parsed once and ``reject_reason`` (NULL = good).

    ``_rows``: the Binance array; ``_series``: the Kraken result's arrays, which
    the one parse leaves as variants and which are cast, not parsed again. A body that is no such JSON, an error object, a truncated array and
    a result whose arrays do not parse all have a reason.
    """
    ex = F.col("exchange")
    binance = F.when(ex == "binance", F.from_json("body", ROWS))
    kraken = F.when(ex == "kraken", F.from_json("body", "struct<error: array<string>, result: map<string,variant>>"))
    one = resp.select("*", F.inline(F.array(F.struct(binance.alias("_rows"), kraken.alias("_kraken")))))
    arrays = F.transform(F.map_entries("_kraken.result"), lambda e: F.when(e["key"] != "last", F.struct(F.try_variant_get(e["value"], "$", ROWS).alias("rows"))))
    one = one.withColumn("_series", F.transform(F.filter(arrays, lambda a: a.isNotNull()), lambda a: a["rows"]))
    short = F.exists("_rows", lambda r: r.isNull() | (F.size(r) < 9))
    broken = F.exists("_series", lambda s: s.isNull())
    failed = F.coalesce(F.size("_kraken.error"), F.lit(0)) > 0
    reason = (F.when(~ex.isin("binance", "kraken") | ex.isNull(), "unsupported_exchange")
               .when(F.col("body").isNull(), "no_body")
               .when((ex == "binance") & F.col("_rows").isNull(), "not_a_candle_array")
               .when((ex == "binance") & short, "short_candle")
               .when((ex == "kraken") & failed, "exchange_error")
               .when((ex == "kraken") & F.col("_series").isNull(), "no_result")
               .when((ex == "kraken") & broken, "broken_result"))
    return one.withColumn("reject_reason", reason)


def rest_rejects(resp: DataFrame) -> DataFrame:
    """Responses that hold no candles to read, with ``reject_reason``."""
    return _checked(resp).where(F.col("reject_reason").isNotNull()).select(*resp.columns, "reject_reason")


def parse_rest(resp: DataFrame, window_start=None, reference_vwap: bool = False, strict: bool = True) -> DataFrame:
    """REST bodies of both exchanges -> bronze rows.

    Binance rows keep ``pair`` as symbol; Kraken rows drop ``/`` and get
    ``interval_end = start + 1 minute``. A body without candles to read - an
    error object, other or truncated text, an unknown exchange - fails the
    query, as the reference raises; ``strict=False`` leaves such responses to
    ``rest_rejects``. Binance ``vwap`` is ``quote volume / volume`` (NULL at
    zero volume); ``reference_vwap=True`` stores the quote volume itself, as
    the reference does. Kraken ticks before ``window_start`` are dropped; no
    upper bound is applied here - the missing-minute semi join is the only
    gate (see ``rest_gap_fill``).
    """
    ex = F.col("exchange")
    checked = _checked(resp)
    good = F.when(ex == "binance", _binance_candles(F.col("_rows"), reference_vwap)).otherwise(_kraken_candles(F.col("_series")))
    reason = F.col("reject_reason")
    if strict:
        fail = F.raise_error(
            F.when(reason == "unsupported_exchange", F.concat(F.lit("Unsupported exchange: "), F.coalesce(ex, F.lit("NULL"))))
             .when(reason == "exchange_error", F.concat(F.lit("Kraken REST error: "), F.to_json("_kraken.error")))
             .otherwise(F.concat(F.lit("REST response of "), ex, F.lit(": "), reason)))
        candles = F.when(reason.isNotNull(), fail).otherwise(good)
    else:
        candles = F.when(reason.isNull(), good)
    symbol = F.when(ex == "kraken", F.regexp_replace("pair", "/", "")).otherwise(F.col("pair"))
    out = checked.select(ex, symbol.alias("symbol"), F.col("fetched_ts").cast("timestamp").alias("ingestion_ts"),
                         F.explode(candles).alias("k"))
    out = out.select("exchange", "symbol", F.lit(60).alias("interval_seconds"), "k.*",
                     F.concat(ex, F.lit("_rest")).alias("source"), "ingestion_ts").select(*BRONZE_COLS)
    if window_start is not None:
        out = out.where((F.col("exchange") != "kraken") | (F.col("interval_start") >= ts_lit(window_start)))
    return out


def parse_rest_binance(resp: DataFrame, reference_vwap: bool = False) -> DataFrame:
    return parse_rest(resp.where(F.col("exchange") == "binance"), reference_vwap=reference_vwap)


def parse_rest_kraken(resp: DataFrame, window_start=None) -> DataFrame:
    return parse_rest(resp.where(F.col("exchange") == "kraken"), window_start)


def land_rest_pages(resp: DataFrame, root: str, load_hour) -> None:
    """Append fetched REST responses ``(exchange, pair, fetched_ts, body)`` under
    ``root/load_hour=<yyyy-MM-dd-HH>/`` (Parquet), where ``run_hour`` of that
    hour picks them up."""
    value = load_hour if isinstance(load_hour, str) else load_hour.strftime("%Y-%m-%d-%H")
    (resp.select("exchange", "pair", F.col("fetched_ts").cast("timestamp").alias("fetched_ts"), "body")
         .withColumn("load_hour", F.lit(value))
         .write.mode("append").partitionBy("load_hour").parquet(root))
