"""Registered streaming queries: run with ``availableNow``, return the sink's rows.

Sources and sinks live in fresh folders under the shared checkpoint
location. Oracles describe what the stream has emitted when it stops:
for watermarked stages, only keys/windows already behind the watermark
(``max(interval_start) - 2 hours``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import dedup_latest
from ..operators.load import to_bronze
from ..operators.silver import to_silver
from ..schemas import BRONZE_COLS, GOLD_COLS, SILVER_COLS
from ..session import shared_dir
from ..sources.events import (binance_messages, bronze_from_events, kraken_messages,
                              read_events)
from ..sources.landing import read_landing
from ..streaming.streams import (REDELIVERY, read_stream_counters, run_available_now, stream_bronze, stream_gold_live, stream_landing,
                                 stream_rollup, stream_silver, stream_silver_merge)
from .inputs import round_cols, value_bounds
from .parse_queries import RUN_COUNTERS_SQL, WS_BRONZE_SQL
from .registry import S_MIN, _w, gold_sql, merge_sql, register


def events_stream(spark, sf_dir, max_files_per_trigger=None):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def raw_feed(events):
    """The raw messages of both exchanges, as the feed's files hold them."""
    return (binance_messages(events).select(F.lit("binance").alias("exchange"), "symbol", "interval_minutes",
                                            F.lit(None).cast("timestamp").alias("received_ts"), "msg")
            .unionByName(kraken_messages(events).select(F.lit("kraken").alias("exchange"), "symbol",
                                                        "interval_minutes", "received_ts", "msg")))


@register("stream_bronze", _w(WS_BRONZE_SQL))
def q_stream_bronze(spark, d):
    """Raw message files (derived from events) -> stream -> bronze Parquet sink."""
    feed = shared_dir(spark, "feed")
    raw_feed(read_events(spark, d)).write.json(feed)
    out, chk = shared_dir(spark, "bronze"), shared_dir(spark, "chk")
    run_available_now(stream_bronze(spark, feed, out, chk))
    return spark.read.parquet(out).select(*BRONZE_COLS)


@register("stream_counters", RUN_COUNTERS_SQL)
def q_stream_counters(spark, d):
    """The load counters that a stream persists with each of its batches."""
    feed, out, chk, counters = (shared_dir(spark, n) for n in ("feed", "bronze", "chk", "counters"))
    raw_feed(read_events(spark, d)).write.json(feed)
    run_available_now(stream_bronze(spark, feed, out, chk, counters_path=counters))
    return read_stream_counters(spark, counters)


@register("stream_redelivery", _w(WS_BRONZE_SQL))
def q_stream_redelivery(spark, d):
    """A feed in three parts of the time, of which every third message comes again, in its part and in the next."""
    feed, root, chk = shared_dir(spark, "feed"), shared_dir(spark, "landing"), shared_dir(spark, "chk")
    ev = read_events(spark, d)
    lo, hi = value_bounds(ev, "ts")
    again = None
    for i in range(3):
        part = ev.where((F.col("ts") >= F.lit(lo + (hi - lo) * i / 3)) & (F.lit(i == 2) | (F.col("ts") < F.lit(lo + (hi - lo) * (i + 1) / 3))))
        repeated = part.where("event_id % 3 = 0")
        sent = raw_feed(part).union(raw_feed(repeated))
        (sent if again is None else sent.union(raw_feed(again))).write.mode("append").json(feed)
        again = repeated
        # each run takes up what has come and stops; the next one resumes its state
        run_available_now(stream_landing(spark, feed, root, chk, redelivery=REDELIVERY,
                                         n_state_partitions=spark.sparkContext.defaultParallelism))
    return to_bronze(read_landing(spark, root))


CLOSED = "(SELECT max(interval_start) - INTERVAL 2 HOUR FROM ({s}) m)"


@register("stream_silver", _w(f"""
    SELECT * FROM ({S_MIN}) s WHERE interval_start <= {CLOSED.format(s=S_MIN)}"""))
def q_stream_silver(spark, d):
    out, chk = shared_dir(spark, "silver"), shared_dir(spark, "chk")
    run_available_now(stream_silver(bronze_from_events(events_stream(spark, d)), out, chk,
                                    n_state_partitions=spark.sparkContext.defaultParallelism))
    return spark.read.parquet(out).select(*SILVER_COLS)


@register("stream_rollup", _w(f"""
    SELECT * FROM ({gold_sql(S_MIN, 5)}) g WHERE interval_end <= {CLOSED.format(s=S_MIN)}"""))
def q_stream_rollup(spark, d):
    out, chk = shared_dir(spark, "gold5m"), shared_dir(spark, "chk")
    run_available_now(stream_rollup(bronze_from_events(events_stream(spark, d)), out, 5, chk,
                                    n_state_partitions=spark.sparkContext.defaultParallelism))
    return round_cols(spark.read.parquet(out).select(*GOLD_COLS), {"quote_volume"})


@register("stream_silver_merge", merge_sql())
def q_stream_silver_merge(spark, d):
    """Seed silver with the REST rows, then merge the event stream in several micro-batches."""
    ev = read_events(spark, d)
    staged = shared_dir(spark, "events")
    ev.withColumn("day", F.to_date("ts")).hint("rebalance", "day").write.partitionBy("day").parquet(staged)
    silver_path, chk = shared_dir(spark, "silver"), shared_dir(spark, "chk")
    from ..sources.tables import write_hours
    seed = to_silver(dedup_latest(bronze_from_events(ev, "hour").where(F.col("source").endswith("_rest"))))
    write_hours(seed, silver_path)
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 8).parquet(staged))
    run_available_now(stream_silver_merge(spark, bronze_from_events(stream, "hour"), silver_path, chk,
                                          n_partitions=spark.sparkContext.defaultParallelism))
    return spark.read.parquet(silver_path).select(*SILVER_COLS)


@register("stream_gold_live", _w(gold_sql(S_MIN, 5)))
def q_stream_gold_live(spark, d):
    """5-minute candles as the stream keeps them, the buckets still open included."""
    staged, silver_path, gold_path, chk = (shared_dir(spark, n) for n in ("events", "silver", "gold5m", "chk"))
    ev = read_events(spark, d)
    ev.repartitionByRange(4, "event_id").write.parquet(staged)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(staged)
    run_available_now(stream_gold_live(spark, bronze_from_events(stream), silver_path, {5: gold_path}, chk,
                                       n_partitions=spark.sparkContext.defaultParallelism))
    return round_cols(spark.read.parquet(gold_path).select(*GOLD_COLS), {"quote_volume"})
