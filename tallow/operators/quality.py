"""Completeness, all-series hour check, alert rows, health report, run counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.time import hours, steps
from ..sources.tables import ts_lit
from .gaps import hourly_counts, series_hours

HOUR_TEXT = "yyyy-MM-dd HH:00"


def _pair_series(pairs: DataFrame) -> DataFrame:
    if "warehouse_symbol" in pairs.columns:
        return pairs.select("exchange", F.col("warehouse_symbol").alias("symbol"))
    return pairs.select("exchange", "symbol")


def completeness_of(counts: DataFrame, pairs: DataFrame, window_start, window_end) -> DataFrame:
    """``completeness`` from ``hourly_counts``."""
    seen = F.coalesce("minutes", F.lit(0)).cast("long")
    return (series_hours(_pair_series(pairs), window_start, window_end)
            .join(counts.select("exchange", "symbol", "hour", "minutes"), ["exchange", "symbol", "hour"], "left")
            .select("exchange", "symbol", "hour", seen.alias("minutes"), (seen == 60).alias("ok")))


def completeness(silver: DataFrame, pairs: DataFrame, window_start, window_end) -> DataFrame:
    """Distinct minutes per (exchange, symbol, hour) for every dimension series.

    ``ok`` is ``minutes = 60``. The spine comes from the dimension, so a
    series with no rows in an hour reports 0 instead of being absent.
    Matching is exact on the warehouse symbol, not ``LIKE``.
    """
    ws = F.date_trunc("hour", ts_lit(window_start))
    we = F.date_trunc("hour", ts_lit(window_end))
    return completeness_of(hourly_counts(silver, ws, we), pairs, ws, we)


def hour_ok_of(counts: DataFrame, pairs: DataFrame, window_start, window_end) -> DataFrame:
    """``hour_ok`` from ``hourly_counts``."""
    expected = 60 * _pair_series(pairs).count()
    per_hour = counts.groupBy("hour").agg(F.sum("rows").alias("rows"))
    spine = (counts.sparkSession.range(1)
             .select(F.explode(steps(window_start, window_end - hours(1), hours(1))).alias("hour")))
    return (spine.join(per_hour, "hour", "left")
            .select("hour", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
                    F.lit(expected).cast("long").alias("expected"),
                    (F.coalesce("rows", F.lit(0)) == expected).alias("ok")))


def hour_ok(silver: DataFrame, pairs: DataFrame, window_start, window_end) -> DataFrame:
    """Per hour: silver rows (non-null ``interval_start``) vs ``60 * #series``."""
    ws = F.date_trunc("hour", ts_lit(window_start))
    we = F.date_trunc("hour", ts_lit(window_end))
    return hour_ok_of(hourly_counts(silver, ws, we), pairs, ws, we)


def alerts(completeness_df: DataFrame | None = None, gaps: DataFrame | None = None,
           hour_checks: DataFrame | None = None) -> DataFrame:
    """Text alert rows (kind, exchange, symbol, hour, text); delivery is not built.

    * ``incomplete``: a completeness row with ``minutes != 60``;
    * ``gap``: a gap-report row;
    * ``ok``: an ``hour_ok`` row with ``ok``.
    """
    parts = []
    if completeness_df is not None:
        parts.append(completeness_df.where(~F.col("ok")).select(
            F.lit("incomplete").alias("kind"), "exchange", "symbol", "hour",
            F.format_string("%s %s %s: %d/60", "exchange", "symbol",
                            F.date_format("hour", HOUR_TEXT), "minutes").alias("text")))
    if gaps is not None:
        parts.append(gaps.select(
            F.lit("gap").alias("kind"), "exchange", "symbol", "hour",
            F.format_string("%s %s %s missing %d/60", "exchange", "symbol",
                            F.date_format("hour", HOUR_TEXT), "missing_minutes").alias("text")))
    if hour_checks is not None:
        parts.append(hour_checks.where("ok").select(
            F.lit("ok").alias("kind"), F.lit(None).cast("string").alias("exchange"),
            F.lit(None).cast("string").alias("symbol"), "hour",
            F.format_string("ok %s", F.date_format("hour", HOUR_TEXT)).alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def health_report(silver: DataFrame) -> DataFrame:
    """Ingestion health per (exchange, symbol, hour).

    candles, distinct minutes, completeness ratio, WS / REST row mix,
    volume, quote volume, volume-weighted price and the largest
    ``ingestion_ts - interval_end`` lag in seconds. One hash aggregate.
    """
    vol = F.sum("volume")
    qv = F.sum("quote_volume")
    lag_us = F.unix_micros("ingestion_ts") - F.unix_micros("interval_end")
    g = (silver.groupBy("exchange", "symbol", F.date_trunc("hour", "interval_start").alias("hour"))
               .agg(F.count(F.lit(1)).alias("candles"),
                    F.count_distinct("interval_start").alias("minutes"),
                    F.count_if(F.col("source").endswith("_ws")).alias("ws_rows"),
                    F.count_if(F.col("source").endswith("_rest")).alias("rest_rows"),
                    F.max("high").alias("high"), F.min("low").alias("low"),
                    vol.alias("volume"), qv.alias("quote_volume"),
                    F.when(vol > 0, qv / vol).alias("vwap"),
                    (F.max(lag_us) / F.lit(1_000_000.0)).alias("max_lag_seconds")))
    return g.select("exchange", "symbol", "hour", "candles", "minutes",
                    (F.col("minutes") / F.lit(60.0)).alias("completeness"),
                    "ws_rows", "rest_rows", "high", "low", "volume", "quote_volume",
                    "vwap", "max_lag_seconds")


# Size of a lag sketch; ranks of its quantiles are within LAG_RANK_ERROR of the exact ones.
LAG_K, LAG_RANK_ERROR = 400, 0.01


def lag_us() -> F.Column:
    """Microseconds from a candle's end to its ingestion."""
    return F.unix_micros("ingestion_ts") - F.unix_micros("interval_end")


def lag_sketches(silver: DataFrame) -> DataFrame:
    """Per (exchange, symbol, hour): candles and a KLL sketch of their lag.

    A sketch has a bounded size whatever the rows; stored with the hour, it is
    merged into any longer span without reading silver again.
    """
    return (silver.groupBy("exchange", "symbol", F.date_trunc("hour", "interval_start").alias("hour"))
            .agg(F.count(lag_us()).alias("candles"), F.kll_sketch_agg_bigint(lag_us(), LAG_K).alias("lag")))


def lag_quantiles(sketches: DataFrame, span, quantiles=(0.5, 0.9, 0.99), by=("exchange", "symbol")) -> DataFrame:
    """Lag quantiles over longer spans, from merged ``lag_sketches``.

    ``span`` is a column of ``hour``, such as its day. Result: ``by``, ``span``,
    candles, quantile, lag_us; one row per quantile.
    """
    merged = (sketches.where("candles > 0").groupBy(*by, span.alias("span"))
              .agg(F.sum("candles").alias("candles"), F.kll_merge_agg_bigint("lag", LAG_K).alias("lag")))
    each = F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_bigint("lag", F.lit(float(q))).alias("lag_us"))
                     for q in quantiles])
    return merged.select(*by, "span", "candles", F.inline(each))


def load_counters(parsed: DataFrame) -> DataFrame:
    """Per landing hour and exchange: envelopes seen, loaded and skipped.

    ``parsed`` is ``parse_ws`` output; the hour is that of ``event_ts``.
    """
    skipped = F.col("reject_reason").isNotNull()
    return (parsed.groupBy(F.date_trunc("hour", "event_ts").alias("hour"), "exchange")
            .agg(F.count(F.lit(1)).alias("rows_seen"), F.count_if(~skipped).alias("rows_loaded"),
                 F.count_if(skipped).alias("rows_skipped")))


def run_metrics(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """Attach run counters: ``rows`` plus ``count_if`` of each named condition.

    The counts are collected while the write that consumes the returned
    frame runs (no second pass); read them with ``obs.get`` afterwards.
    """
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(c).alias(k) for k, c in conditions.items()]
    return df.observe(obs, *aggs), obs
