"""Declared schemas and key lists (never inferred)."""

from pyspark.sql import types as T

S, I, L, D, B, TS = (T.StringType(), T.IntegerType(), T.LongType(),
                     T.DoubleType(), T.BooleanType(), T.TimestampType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Landing envelope as written by the feed (one JSON object per line).
ENVELOPE = _struct(
    ("exchange", S, False), ("symbol", S, False), ("interval_minutes", I, False),
    ("event_type", S, True), ("event_ts", TS, False),
    ("interval_start", TS, True), ("interval_end", TS, True),
    ("is_final", B, True), ("payload", S, False),
)

# Landing files as read back: body fields plus the Hive path columns.
# year/month/day/hour are strings so "01" stays zero padded.
LANDING_READ = _struct(
    ("event_type", S, True), ("event_ts", TS, True),
    ("interval_start", TS, True), ("interval_end", TS, True),
    ("is_final", B, True), ("payload", S, True),
    ("exchange", S, True), ("symbol", S, True), ("interval_minutes", I, True),
    ("year", S, True), ("month", S, True), ("day", S, True), ("hour", S, True),
)

BRONZE = _struct(
    ("exchange", S, False), ("symbol", S, False), ("interval_seconds", I, False),
    ("interval_start", TS, False), ("interval_end", TS, False),
    ("open", D, True), ("high", D, True), ("low", D, True), ("close", D, True),
    ("volume", D, True), ("vwap", D, True), ("trade_count", I, True),
    ("source", S, False), ("ingestion_ts", TS, False),
)

SILVER = _struct(
    ("exchange", S, False), ("symbol", S, False), ("quote_asset", S, False),
    ("interval_seconds", I, False),
    ("interval_start", TS, False), ("interval_end", TS, False),
    ("open", D, True), ("high", D, True), ("low", D, True), ("close", D, True),
    ("volume", D, True), ("quote_volume", D, True), ("trade_count", I, True),
    ("vwap", D, True), ("source", S, False), ("ingestion_ts", TS, False),
)

GOLD = _struct(
    ("exchange", S, True), ("symbol", S, True),
    ("interval_start", TS, True), ("interval_end", TS, True),
    ("open", D, True), ("high", D, True), ("low", D, True), ("close", D, True),
    ("volume", D, True), ("quote_volume", D, True), ("trade_count", L, True),
    ("source", S, True), ("ingestion_ts", TS, True),
)

BRONZE_COLS = [f.name for f in BRONZE.fields]
SILVER_COLS = [f.name for f in SILVER.fields]
GOLD_COLS = [f.name for f in GOLD.fields]

# One silver row per series and minute; gold is unique per series and bucket.
SERIES_KEY = ["exchange", "symbol"]
SILVER_KEY = ["exchange", "symbol", "interval_seconds", "interval_start"]
GOLD_KEY = ["exchange", "symbol", "interval_start"]

# Fixed value: the nine columns the reference's silver UPDATE sets; with
# these, quote_volume and interval_end of an updated row stay stale.
REFERENCE_UPDATE_COLS = ("open", "high", "low", "close", "volume", "vwap",
                         "trade_count", "source", "ingestion_ts")

# Fixed value: the eight columns the gold ON CONFLICT clause replaces.
GOLD_UPDATE_COLS = ("open", "high", "low", "close", "volume", "quote_volume",
                    "trade_count", "ingestion_ts")
