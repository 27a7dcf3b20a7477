"""tallow: one-minute OHLCV candles on Spark.

Bronze (append-only raw candles) -> silver (one candle per series and
minute) -> gold (5m/15m/30m/1h rollups) plus gap and completeness
reports. Every operator is a plain ``DataFrame -> DataFrame`` function
built from Spark SQL built-ins, usable in batch and, where Spark allows,
in Structured Streaming.

Common entry points are re-exported here::

    from tallow import build_session, pair_dimension, run_hour, rollup
"""

from .operators import (alerts, append_missing, assert_unique, backfill_plan, bronze_union,
                        completeness, dedup_latest, gap_fill_check, gap_report,
                        gap_report_weighted, gold_from_gold, health_report, hour_ok,
                        merge_silver, partition_calendar, ready_partitions, rest_gap_fill,
                        rollup, to_silver, upsert, with_canonical_symbol, ws_gaps)
from .operators.load import bronze_binance, bronze_kraken, rejects, to_bronze
from .plans.hourly import Layout, run_backfill, run_hour
from .session import build_session, shared_dir
from .sources.landing import read_landing, write_landing
from .sources.messages import drop_heartbeats, envelope_binance, envelope_kraken
from .sources.pairs import pair_dimension
from .sources.rest import land_rest_pages, parse_rest

__version__ = "0.1.0"

__all__ = [
    "alerts", "append_missing", "assert_unique", "backfill_plan", "bronze_union", "completeness",
    "dedup_latest", "gap_fill_check", "gap_report", "gap_report_weighted", "gold_from_gold",
    "health_report", "hour_ok", "merge_silver", "partition_calendar", "ready_partitions",
    "rest_gap_fill", "rollup", "to_silver", "upsert", "with_canonical_symbol", "ws_gaps",
    "bronze_binance", "bronze_kraken", "rejects", "to_bronze", "Layout", "run_backfill", "run_hour",
    "build_session", "shared_dir", "read_landing", "write_landing", "drop_heartbeats",
    "envelope_binance", "envelope_kraken", "pair_dimension", "parse_rest", "land_rest_pages",
]
