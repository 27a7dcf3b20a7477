"""Gold candles: tumbling-bucket rollups of silver and keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import GOLD_KEY, GOLD_UPDATE_COLS
from ..sources.tables import read_window
from .silver import touched

# Fixed value: source tag of every gold row.
DERIVED = "derived"
BUCKETS = {"5m": 5, "15m": 15, "30m": 30, "1h": 60}


def rollup(silver: DataFrame, minutes: int, window_start=None,
           window_end=None) -> DataFrame:
    """Roll one-minute silver candles up to ``minutes``-wide gold candles.

    Per (exchange, symbol, bucket): open of the earliest minute, max high,
    min low, close of the latest minute, summed volume, quote volume and
    trade count, ``'derived'``, latest ``ingestion_ts``. A NULL open or
    close in the first or last minute stays NULL (``min_by``/``max_by``
    keep NULL values, like ``(array_agg(x ORDER BY t))[1]``).

    All aggregates are declarative with fixed-width buffers, so Spark
    plans a hash aggregate with a map-side partial step: a hot series is
    reduced per task before the shuffle, and no per-bucket list is built.
    ``window()`` is used for the bucket so the same code runs on a
    watermarked stream. Without a window the whole input is rolled up;
    with an hour-aligned window only those buckets are rebuilt.
    """
    df = silver
    if window_start is not None or window_end is not None:
        df = read_window(df, window_start, window_end)
    return _candles(df, minutes)


def gold_from_gold(gold: DataFrame, minutes: int) -> DataFrame:
    """Fold finer gold candles into coarser ones (``minutes`` a multiple).

    Equal to ``rollup(silver, minutes)`` because open/close follow bucket
    start times and the other aggregates are associative; reads one row
    per finer bucket instead of one per minute.
    """
    return _candles(gold, minutes)


def bucket_of(minutes: int, c: str = "interval_start"):
    """The start of the ``minutes``-wide bucket of ``c``."""
    return F.window(c, f"{minutes} minutes").start.alias("bucket")


def rollup_touched(changes: DataFrame, minutes: int) -> DataFrame:
    """The gold candles of the buckets that a merge changed (``silver.merge_changes``).

    ``changes`` holds the merged rows of at least the hours it touched, so a
    changed bucket is complete in it. Buckets without a change are not
    aggregated: a semi join on (exchange, symbol, bucket) leaves them out
    before the shuffle of the rollup.
    """
    keyed = changes.withColumn("bucket", bucket_of(minutes))
    rows = keyed.join(touched(changes, bucket_of(minutes)), ["exchange", "symbol", "bucket"], "left_semi")
    return _candles(rows, minutes)


def refresh(gold: DataFrame, changes: DataFrame, minutes: int) -> DataFrame:
    """``gold`` with the buckets that a merge changed rebuilt, the others as they are.

    On conflict the eight value columns are replaced (``GOLD_UPDATE_COLS``);
    equal to ``rollup`` of the whole merged silver.
    """
    return upsert(gold, rollup_touched(changes, minutes), update_cols=GOLD_UPDATE_COLS)


def _candles(df: DataFrame, minutes: int) -> DataFrame:
    w = F.window("interval_start", f"{minutes} minutes")
    g = (df.groupBy("exchange", "symbol", w.alias("bucket"))
           .agg(F.min_by("open", "interval_start").alias("open"),
                F.max("high").alias("high"),
                F.min("low").alias("low"),
                F.max_by("close", "interval_start").alias("close"),
                F.sum("volume").alias("volume"),
                F.sum("quote_volume").alias("quote_volume"),
                F.sum("trade_count").cast("long").alias("trade_count"),
                F.max("ingestion_ts").alias("ingestion_ts")))
    return g.select(
        "exchange", "symbol",
        F.col("bucket.start").alias("interval_start"),
        F.col("bucket.end").alias("interval_end"),
        "open", "high", "low", "close", "volume", "quote_volume", "trade_count",
        F.lit(DERIVED).alias("source"), "ingestion_ts")


def upsert(target: DataFrame, source: DataFrame, key=tuple(GOLD_KEY),
           update_cols=None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE`` as a DataFrame.

    ``update_cols=None`` replaces the whole row: target rows whose key is
    in ``source`` are dropped (left anti join on the key only) and the
    source rows appended. With ``update_cols`` a full outer join keeps
    the target's other columns on conflict.
    """
    key = list(key)
    cols = target.columns
    if update_cols is None:
        kept = target.join(source.select(*key), key, "left_anti")
        return kept.unionByName(source.select(*cols))
    upd = set(update_cols)
    j = (target.withColumn("_t", F.lit(True)).alias("t")
         .join(source.withColumn("_s", F.lit(True)).alias("s"), key, "full_outer"))
    out = []
    for c in cols:
        if c in key:
            out.append(F.col(c))
        elif c in upd:
            out.append(F.when(F.col("s._s"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("t._t"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


__all__ = ["rollup", "rollup_touched", "refresh", "gold_from_gold", "upsert", "BUCKETS", "DERIVED"]
