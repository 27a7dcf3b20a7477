"""Exchange candle messages -> landing envelopes.

Input frames hold one raw JSON message per row:

* Binance: ``(symbol, interval_minutes, msg)``;
* Kraken: ``(symbol, interval_minutes, received_ts, msg)`` - ``received_ts``
  stamps status messages, which carry no time of their own.

Envelope columns: ``schemas.ENVELOPE`` (timestamps typed, payload text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENVELOPE

ENVELOPE_COLS = [f.name for f in ENVELOPE.fields]

# Binance ``k`` holds both ``t`` and ``T``; a struct schema would be
# ambiguous under case-insensitive resolution, so ``k`` is read as a map.
BINANCE_MSG = "struct<E: bigint, k: map<string,string>>"
KRAKEN_MSG = ("struct<channel: string, type: string, timestamp: string, "
              "data: array<struct<interval_begin: string, timestamp: string>>>")


def envelope_binance(raw: DataFrame) -> DataFrame:
    """One envelope per Binance candle message (``event_type='update'``)."""
    # The parsed message leaves through a Generate, so its fields are read
    # from one parse instead of one pruned parse each.
    parsed = raw.select("*", F.inline(F.array(F.from_json("msg", BINANCE_MSG))))
    k = F.col("k")
    return parsed.select(
        F.lit("binance").alias("exchange"), "symbol",
        F.col("interval_minutes").cast("int").alias("interval_minutes"),
        F.lit("update").alias("event_type"),
        F.timestamp_millis("E").alias("event_ts"),
        F.timestamp_millis(k["t"].try_cast("long")).alias("interval_start"),
        F.timestamp_millis(k["T"].try_cast("long")).alias("interval_end"),
        k["x"].try_cast("boolean").alias("is_final"),
        F.col("msg").alias("payload"))


def channel() -> F.Column:
    return F.get_json_object("msg", "$.channel")


def drop_heartbeats(raw: DataFrame) -> DataFrame:
    """Drop ``channel = 'heartbeat'`` messages; a message without a channel is kept."""
    return raw.where(F.coalesce(channel() != "heartbeat", F.lit(True)))


def envelope_kraken(raw: DataFrame) -> DataFrame:
    """Kraken messages -> envelopes.

    ``status``: one envelope with NULL interval and ``is_final``, stamped
    with ``received_ts``. ``ohlc``: one envelope **per element** of
    ``data`` (``is_final`` = ``type = 'snapshot'``), each carrying the whole
    message as payload. Heartbeats and other channels yield nothing.

    The message is parsed once into a column and then turned into an
    array of envelopes exploded in one ``Generate`` (one pass, one parse).
    """
    m = F.col("_m")

    def env(event_type, event_ts, start, end, final):
        return F.struct(event_type.alias("event_type"), event_ts.alias("event_ts"),
                        start.alias("interval_start"), end.alias("interval_end"),
                        final.alias("is_final"))

    null_ts = F.lit(None).cast("timestamp")
    status = F.array(env(F.lit("status"), F.col("received_ts").cast("timestamp"),
                         null_ts, null_ts, F.lit(None).cast("boolean")))
    candles = F.transform(F.coalesce(m["data"], F.array()), lambda c: env(
        m["type"], m["timestamp"].try_cast("timestamp"),
        c["interval_begin"].try_cast("timestamp"), c["timestamp"].try_cast("timestamp"),
        m["type"] == "snapshot"))
    envs = (F.when(m["channel"] == "status", status)
             .when(m["channel"] == "ohlc", candles))
    parsed = raw.select("symbol", "interval_minutes", "received_ts", "msg",
                        F.from_json("msg", KRAKEN_MSG).alias("_m"))
    out = parsed.select(
        "symbol", F.col("interval_minutes").cast("int").alias("interval_minutes"),
        F.col("msg").alias("payload"), F.explode(envs).alias("e"))
    return out.select(F.lit("kraken").alias("exchange"), "symbol", "interval_minutes",
                      "e.event_type", "e.event_ts", "e.interval_start", "e.interval_end",
                      "e.is_final", "payload")
