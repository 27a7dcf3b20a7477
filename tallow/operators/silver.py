"""Silver fact: projection, merge and uniqueness check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SILVER_COLS, SILVER_KEY

# Fixed value: quote asset written on every silver row.
QUOTE_ASSET = "USD"


def to_silver(bronze: DataFrame, normalize_end: bool = False) -> DataFrame:
    """Bronze-shaped rows -> silver columns (``quote_volume = volume * close``).

    ``interval_end`` differs by source (Binance close time ``start + 59.999 s``,
    Kraken ``start + 1 min``); ``normalize_end=True`` sets it to
    ``interval_start + interval_seconds`` for every row.
    """
    end = F.col("interval_end")
    if normalize_end:
        end = F.col("interval_start") + F.make_dt_interval(secs=F.col("interval_seconds"))
    return bronze.select(
        "exchange", "symbol", F.lit(QUOTE_ASSET).alias("quote_asset"),
        "interval_seconds", "interval_start", end.alias("interval_end"),
        "open", "high", "low", "close", "volume",
        (F.col("volume") * F.col("close")).alias("quote_volume"),
        "trade_count", "vwap", "source", "ingestion_ts",
    )


def merge_silver(target: DataFrame, source: DataFrame,
                 update_cols=None) -> DataFrame:
    """Merged silver state for the keys of ``target`` and ``source``.

    ``source`` is deduped bronze (one row per key). Per key:

    * only in target -> target row unchanged;
    * only in source -> inserted (``to_silver``);
    * in both and ``source.ingestion_ts > target.ingestion_ts`` (strict)
      -> ``update_cols`` taken from source, all others from target;
    * otherwise -> target row unchanged.

    ``update_cols=None`` refreshes every non-key column;
    ``schemas.REFERENCE_UPDATE_COLS`` reproduces the reference's nine
    columns (``quote_volume`` and ``interval_end`` stay stale).

    One full outer join on the silver key replaces UPDATE + INSERT; the
    caller restricts ``target`` to the touched hour partitions and writes
    the result back with a dynamic partition overwrite. Merging the same
    source twice gives the same state.
    """
    return _merged(target, source, update_cols, False)


def _merged(target: DataFrame, source: DataFrame, update_cols, with_change: bool) -> DataFrame:
    src = to_silver(source).withColumn("_s", F.lit(True))
    tgt = target.select(*SILVER_COLS).withColumn("_t", F.lit(True))
    key = SILVER_KEY
    values = [c for c in SILVER_COLS if c not in key]
    upd = set(values if update_cols is None else update_cols)
    j = tgt.alias("t").join(src.alias("s"), key, "full_outer")
    t_absent = F.col("t._t").isNull()
    newer = F.col("s._s") & (F.col("s.ingestion_ts") > F.col("t.ingestion_ts"))
    cols = []
    for c in SILVER_COLS:
        if c in key:
            cols.append(F.col(c))
        elif c in upd:
            cols.append(F.when(t_absent | newer, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.when(t_absent, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    if with_change:
        cols.append(F.when(t_absent, INSERT).when(newer, UPDATE).otherwise(UNCHANGED).alias(CHANGE))
    return j.select(*cols)


# What a merge does to a key.
INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"
CHANGE = "change"


def merge_changes(target: DataFrame, source: DataFrame, update_cols=None) -> DataFrame:
    """``merge_silver`` with a column ``change`` per key: insert, update or unchanged.

    ``insert``: the key was not in ``target``; ``update``: the source row is
    newer (strictly) and replaced ``update_cols``; all others are
    ``unchanged``, also keys of ``source`` that are not newer. The rows that
    are not ``unchanged`` are the merge's change set: what depends on silver
    needs to be rebuilt for them only (``touched``).
    """
    return _merged(target, source, update_cols, True)


def touched(changes: DataFrame, unit) -> DataFrame:
    """Distinct (exchange, symbol, ``unit``) of the changed rows; ``unit`` is a column such as a bucket."""
    return changes.where(F.col(CHANGE) != UNCHANGED).select("exchange", "symbol", unit).distinct()


def assert_unique(df: DataFrame, key=tuple(SILVER_KEY)) -> DataFrame:
    """Raise ``ValueError`` if ``key`` repeats in ``df``; else return ``df``.

    One aggregation job; only a single offending key (``limit(1)``) ever
    reaches the driver.
    """
    key = list(key)
    dup = df.groupBy(*key).count().where("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dup[0].asDict()}")
    return df
