"""Messages parsed once, on arrival, into VARIANT, and a landing table that keeps it.

Input frames are those of ``sources.messages``. The envelopes have the same
columns, with ``payload`` a VARIANT; text that is no JSON has a NULL payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import hour_partition
from ..schemas import ENVELOPE
from .messages import ENVELOPE_COLS
from .tables import LOAD_COL, read_hours, write_hours

VARIANT_ENVELOPE = T.StructType([f if f.name != "payload" else T.StructField("payload", T.VariantType()) for f in ENVELOPE.fields])


def _parsed(raw: DataFrame) -> DataFrame:
    # through a Generate, so that all that reads the message reads one parse of it
    return raw.select("*", F.inline(F.array(F.struct(F.try_parse_json("msg").alias("payload")))))


def _get(path: str, to: str, v: Column | None = None) -> Column:
    return F.try_variant_get(F.col("payload") if v is None else v, path, to)


def variant_binance(raw: DataFrame) -> DataFrame:
    """One envelope per Binance candle message."""
    at = lambda path: F.timestamp_millis(_get(path, "string").try_cast("long"))
    return _parsed(raw).select(
        F.lit("binance").alias("exchange"), "symbol", F.col("interval_minutes").cast("int").alias("interval_minutes"),
        F.lit("update").alias("event_type"), at("$.E").alias("event_ts"), at("$.k.t").alias("interval_start"),
        at("$.k.T").alias("interval_end"), _get("$.k.x", "string").try_cast("boolean").alias("is_final"), "payload")


def variant_kraken(raw: DataFrame) -> DataFrame:
    """Envelopes of Kraken messages: one per candle of ``ohlc``, one of ``status``, none of others."""
    when = lambda path, v=None: _get(path, "string", v).try_cast("timestamp")
    final = _get("$.type", "string") == "snapshot"
    candle = F.transform(F.coalesce(_get("$.data", "array<variant>"), F.array().cast("array<variant>")), lambda c: F.struct(
        _get("$.type", "string").alias("event_type"), when("$.timestamp").alias("event_ts"), when("$.interval_begin", c).alias("interval_start"),
        when("$.timestamp", c).alias("interval_end"), final.alias("is_final")))
    none = F.lit(None)
    status = F.array(F.struct(F.lit("status").alias("event_type"), F.col("received_ts").cast("timestamp").alias("event_ts"),
                              none.cast("timestamp").alias("interval_start"), none.cast("timestamp").alias("interval_end"),
                              none.cast("boolean").alias("is_final")))
    channel = _get("$.channel", "string")
    out = _parsed(raw).select("symbol", F.col("interval_minutes").cast("int").alias("interval_minutes"), "payload",
                              F.inline(F.when(channel == "status", status).when(channel == "ohlc", candle)))
    return out.withColumn("exchange", F.lit("kraken")).select(*ENVELOPE_COLS)


def write_variant_landing(env: DataFrame, path: str) -> None:
    """Land envelopes as Parquet by the hour of ``event_ts``; a re-run replaces its hours."""
    write_hours(env.withColumn(LOAD_COL, hour_partition("event_ts")), path, partition_col=LOAD_COL)


def read_variant_landing(spark: SparkSession, path: str, hours=None) -> DataFrame:
    """Landed envelopes; ``hours`` (datetimes) limits the scan to their partitions."""
    stored = T.StructType([*VARIANT_ENVELOPE.fields, T.StructField(LOAD_COL, T.StringType())])
    if hours is None:
        return spark.read.schema(stored).parquet(path).drop(LOAD_COL)
    return read_hours(spark, path, [h.strftime("%Y-%m-%d-%H") for h in hours], stored, partition_col=LOAD_COL).drop(LOAD_COL)
