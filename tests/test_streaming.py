"""Streaming stages: landing round trip, watermark drops, last update wins."""

import datetime as dt

from pyspark.sql import functions as F

from tallow.operators.load import to_bronze
from tallow.schemas import BRONZE
from tallow.sources.events import binance_messages, kraken_messages, read_events
from tallow.sources.messages import envelope_binance, envelope_kraken
from tallow.streaming import (final_candles, run_available_now, stream_bronze, stream_landing,
                                stream_rollup)

from conftest import SF_SMALL

H = dt.datetime(2025, 12, 1, 1, 0)


def test_feed_to_landing_to_bronze_stream_equals_batch(spark, scratch):
    ev = read_events(spark, SF_SMALL)
    b, k = binance_messages(ev), kraken_messages(ev)
    feed = f"{scratch}/feed"
    (b.select(F.lit("binance").alias("exchange"), "symbol", "interval_minutes",
              F.lit(None).cast("timestamp").alias("received_ts"), "msg")
     .unionByName(k.select(F.lit("kraken").alias("exchange"), "symbol", "interval_minutes", "received_ts", "msg"))
     .write.json(feed))
    run_available_now(stream_landing(spark, feed, f"{scratch}/landing", f"{scratch}/chk1"))
    run_available_now(stream_bronze(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/chk2",
                                    from_landing=True))
    streamed = spark.read.parquet(f"{scratch}/bronze").drop("load_hour", "batch")
    batch = to_bronze(envelope_binance(b).unionByName(envelope_kraken(k)))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    # a second availableNow run finds no new files and appends nothing
    run_available_now(stream_bronze(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/chk2",
                                    from_landing=True))
    assert spark.read.parquet(f"{scratch}/bronze").count() == batch.count()


def _row(minute, price, ingest_s, source="binance_ws"):
    t = H + dt.timedelta(minutes=minute)
    return ("binance", "BTCUSDT", 60, t, t + dt.timedelta(minutes=1), price, price, price, price,
            1.0, price, 1, source, t + dt.timedelta(seconds=ingest_s))


def _batches(spark, folder, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, BRONZE).coalesce(1).write.parquet(f"{folder}/b{i}")


def test_rollup_stream_drops_rows_behind_watermark(spark, scratch):
    src = f"{scratch}/src"
    # batch 0: minutes 0..4 and a row 3 hours later (moves the watermark to 02:00)
    # batch 1: an on-time row; batch 2: a late row for minute 2 -> dropped
    # (late input is judged against the previous batch's watermark)
    _batches(spark, src, [_row(i, 10.0 + i, 5) for i in range(5)] + [_row(180, 50.0, 5)],
             [_row(181, 51.0, 5)], [_row(2, 99.0, 500)])
    stream = (spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    run_available_now(stream_rollup(stream, f"{scratch}/gold", 5, f"{scratch}/chk"))
    gold = spark.read.parquet(f"{scratch}/gold").collect()
    assert len(gold) == 1                      # only the closed 01:00 window is emitted
    g = gold[0]
    assert (g.interval_start, g.open, g.close, g.high, g.trade_count) == (H, 10.0, 14.0, 14.0, 5)


def test_final_candles_keep_latest_update(spark, scratch):
    src = f"{scratch}/src"
    _batches(spark, src, [_row(0, 1.0, 10), _row(0, 2.0, 50), _row(1, 3.0, 10)],
             [_row(0, 4.0, 40), _row(300, 9.0, 1)])          # older update for minute 0 loses
    stream = (spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    q = (final_candles(stream).writeStream.format("parquet").option("path", f"{scratch}/silver")
         .option("checkpointLocation", f"{scratch}/chk").outputMode("append")
         .trigger(availableNow=True).start())
    run_available_now(q)
    got = {r.interval_start: r.close for r in spark.read.parquet(f"{scratch}/silver").collect()}
    assert got == {H: 2.0, H + dt.timedelta(minutes=1): 3.0}


def test_continuous_trigger_landing(spark, scratch):
    from tallow.sources.landing import read_landing
    ev = read_events(spark, SF_SMALL)
    feed = f"{scratch}/feed"
    (binance_messages(ev).select(F.lit("binance").alias("exchange"), "symbol", "interval_minutes",
                                 F.lit(None).cast("timestamp").alias("received_ts"), "msg")
     .write.json(feed))
    q = stream_landing(spark, feed, f"{scratch}/landing", f"{scratch}/chk", trigger_seconds=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    landed = read_landing(spark, f"{scratch}/landing")
    assert landed.count() == binance_messages(ev).count() > 0
    assert landed.where("exchange = 'binance' AND symbol LIKE '%USDT'").count() == landed.count()


def _feed(spark, folder, minutes, price="1.0"):
    rows = []
    for minute in minutes:
        start = H + dt.timedelta(minutes=minute)
        ms = int(start.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        rows.append(("binance", "BTCUSDT", 1, None, f'{{"E":{ms + 60_000},"k":{{"t":{ms},"T":{ms + 59_999},"x":true,"o":"{price}","h":"1","l":"1",'
                                                    f'"c":"1","v":"1","q":"1","n":1}}}}'))
    spark.createDataFrame(rows, "exchange string, symbol string, interval_minutes int, received_ts timestamp, msg string") \
        .coalesce(1).write.mode("append").json(folder)


def test_redelivered_messages_land_once_and_the_state_is_bounded(spark, scratch):
    from tallow.sources.landing import read_landing
    feed, root = f"{scratch}/feed", f"{scratch}/landing"

    def run():
        q = run_available_now(stream_landing(spark, feed, root, f"{scratch}/chk", redelivery="2 hours", n_state_partitions=2))
        return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]

    _feed(spark, feed, [*range(100), *range(50)])
    run()
    assert read_landing(spark, root).count() == 100
    _feed(spark, feed, [*range(90, 110)])                       # ten again, in a later batch
    run()
    assert read_landing(spark, root).count() == 110
    _feed(spark, feed, range(100_000, 100_010))                 # the watermark passes all that came before
    _, *_ = run()
    _feed(spark, feed, [*range(5), *range(100_005, 100_015)])   # late ones are dropped, new ones land
    held = run()
    assert read_landing(spark, root).count() == 125 and held[-1] <= 15


def test_a_replayed_batch_overwrites_its_own_rows_and_counters(spark, scratch):
    from tallow.streaming.streams import read_stream_counters, write_batch
    feed, out, counters = (f"{scratch}/{n}" for n in ("feed", "bronze", "counters"))
    _feed(spark, feed, range(30), price="x")
    _feed(spark, feed, range(30, 70))
    for _ in range(2):
        run_available_now(stream_bronze(spark, feed, out, f"{scratch}/chk", counters_path=counters))
    seen = {r.hour: (r.rows_seen, r.rows_loaded, r.rows_skipped) for r in read_stream_counters(spark, counters).collect()}
    assert seen == {H: (59, 29, 30), H + dt.timedelta(hours=1): (11, 11, 0)}
    assert spark.read.parquet(out).count() == 40
    # the same batch of the same stream again: its folders are replaced; another stream's are not
    rows = spark.createDataFrame([_row(0, 1.0, 5)], BRONZE).withColumn("load_hour", F.lit("2025-12-01-01"))
    for tag in ("a", "a", "b"):
        write_batch(f"{scratch}/other", tag, "load_hour")(rows, 0)
    assert spark.read.parquet(f"{scratch}/other").count() == 2


def test_live_gold_has_open_buckets_and_a_replay_changes_nothing(spark, scratch):
    from tallow.operators import dedup_latest, rollup, to_silver
    from tallow.streaming.streams import merge_batch_live
    silver, gold = f"{scratch}/silver", {5: f"{scratch}/gold5", 60: f"{scratch}/gold60"}
    merge = merge_batch_live(spark, silver, gold)
    batches = [[_row(i, 10.0 + i, 5) for i in range(3)], [_row(3, 50.0, 5), _row(1, 99.0, 90)], [_row(1, 1.0, 1), _row(64, 7.0, 5)]]
    frames = [spark.createDataFrame(b, BRONZE) for b in batches]
    for i, f in enumerate(frames):
        merge(f, i)
        so_far = to_silver(dedup_latest(spark.createDataFrame(sum(batches[:i + 1], []), BRONZE)))
        for minutes, path in gold.items():
            live, whole = spark.read.parquet(path).drop("hour"), rollup(so_far, minutes)
            assert sorted(map(tuple, live.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    files = [sorted(spark.read.parquet(p).inputFiles()) for p in (silver, *gold.values())]
    for i, f in enumerate(frames):
        merge(f, i)
    assert [sorted(spark.read.parquet(p).inputFiles()) for p in (silver, *gold.values())] == files
