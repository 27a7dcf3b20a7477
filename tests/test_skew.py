"""A hot key holding a third of all rows: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from tallow.operators import dedup_latest, gap_report, merge_silver, rollup, to_silver
from tallow.schemas import BRONZE

from test_pruning import plan

H = dt.datetime(2025, 12, 1, 0, 0)


def skewed(spark, n=3000):
    """n rows: a third are re-deliveries of one minute of one series."""
    hot = spark.range(n // 3).select(
        F.lit("binance").alias("exchange"), F.lit("BTCUSDT").alias("symbol"), F.lit(60).alias("interval_seconds"),
        F.lit(H).cast("timestamp").alias("interval_start"),
        (F.lit(H).cast("timestamp") + F.expr("INTERVAL 1 MINUTE")).alias("interval_end"),
        F.col("id").cast("double").alias("open"), F.col("id").cast("double").alias("high"),
        F.col("id").cast("double").alias("low"), F.col("id").cast("double").alias("close"),
        F.lit(1.0).alias("volume"), F.lit(1.0).alias("vwap"), F.lit(1).alias("trade_count"),
        F.lit("binance_ws").alias("source"),
        (F.lit(H).cast("timestamp") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)") / 1000)).alias("ingestion_ts"))
    rest = spark.range(n - n // 3).select(
        F.lit("kraken").alias("exchange"), F.concat(F.lit("S"), (F.col("id") % 7).cast("string")).alias("symbol"),
        F.lit(60).alias("interval_seconds"),
        (F.lit(H).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 120).cast("int"))).alias("interval_start"),
        (F.lit(H).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 120 + 1).cast("int"))).alias("interval_end"),
        F.col("id").cast("double").alias("open"), F.col("id").cast("double").alias("high"),
        F.col("id").cast("double").alias("low"), F.col("id").cast("double").alias("close"),
        F.lit(1.0).alias("volume"), F.lit(1.0).alias("vwap"), F.lit(1).alias("trade_count"),
        F.lit("kraken_ws").alias("source"),
        (F.lit(H).cast("timestamp") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ingestion_ts"))
    return spark.createDataFrame(hot.unionByName(rest).repartition(6).rdd, BRONZE)


def test_hot_key_dedup_rollup_merge(spark):
    b = skewed(spark)
    d = dedup_latest(b)
    hot = d.where("exchange = 'binance'").collect()
    assert len(hot) == 1 and hot[0].close == 999.0          # the latest of 1,000 re-deliveries
    assert d.count() == 1 + 840          # other keys: (id % 7, id % 120) over 2,000 ids = lcm(7, 120)
    # the partial aggregate runs before the shuffle, so the hot key crosses it once per task
    p = plan(d).split("\n\n")[0]
    assert p.index("Exchange") < p.rindex("SortAggregate")
    s = to_silver(d)
    g = rollup(s, 60).where("exchange = 'binance'").first()
    assert (g.open, g.close, g.trade_count) == (999.0, 999.0, 1)
    merged = merge_silver(s.limit(0), d)
    assert merged.count() == d.count()
    series = s.select("exchange", "symbol").distinct()
    gaps = {(r.exchange, r.hour): r.missing_minutes for r in
            gap_report(s, series, H, H + dt.timedelta(hours=2)).collect() if r.exchange == "binance"}
    assert gaps == {("binance", H): 59, ("binance", H + dt.timedelta(hours=1)): 60}
