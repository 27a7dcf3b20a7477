"""End-to-end hourly runs on disk: landing -> bronze -> REST fill -> silver -> gold."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tallow.operators.rollup import rollup
from tallow.plans.hourly import (BRONZE_STORED, GOLD_STORED, SILVER_STORED, Layout, gaps_for, run_backfill,
                                   run_hour)
from tallow.sources.landing import read_landing, write_landing
from tallow.sources.messages import envelope_binance, envelope_kraken
from tallow.sources.pairs import pair_dimension
from tallow.sources.rest import land_rest_pages
from tallow.sources.tables import delete_path, read_hours

H = dt.datetime(2025, 12, 1, 1, 0)
EPOCH = dt.datetime(1970, 1, 1)


def ms(t):
    return int((t - EPOCH).total_seconds() * 1000)


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def binance_msg(start, price):
    end = start + dt.timedelta(minutes=1)
    return json.dumps({"E": ms(end) + 1000, "k": {
        "t": ms(start), "T": ms(end) - 1, "x": True, "o": str(price), "h": str(price + 1),
        "l": str(price - 1), "c": str(price), "v": "2.0", "q": str(2 * price), "n": 3}})


def kraken_msg(start, price):
    end = start + dt.timedelta(minutes=1)
    return json.dumps({"channel": "ohlc", "type": "snapshot", "timestamp": iso(end + dt.timedelta(seconds=1)),
                       "data": [{"interval_begin": iso(start), "timestamp": iso(end), "open": price,
                                 "high": price + 1, "low": price - 1, "close": price, "volume": 2.0,
                                 "vwap": price, "trades": 3}]})


def build_inputs(spark, layout):
    mins = [H + dt.timedelta(minutes=i) for i in range(60)]
    b = [("BTCUSDT", 1, binance_msg(H - dt.timedelta(minutes=2), 99.0))] + \
        [("BTCUSDT", 1, binance_msg(t, 100.0 + i)) for i, t in enumerate(mins)]
    k = [("BTC/USD", 1, t, kraken_msg(t, 200.0 + i)) for i, t in enumerate(mins[:58])]
    env = envelope_binance(spark.createDataFrame(b, "symbol string, interval_minutes int, msg string")) \
        .unionByName(envelope_kraken(spark.createDataFrame(
            k, "symbol string, interval_minutes int, received_ts timestamp, msg string")))
    write_landing(env, layout.landing)
    body = json.dumps({"error": [], "result": {"XXBTZUSD": [
        [int((t - EPOCH).total_seconds()), "7", "8", "6", "7", "7", "1.0", 1] for t in mins], "last": 0}})
    land_rest_pages(spark.createDataFrame([("kraken", "BTC/USD", H + dt.timedelta(hours=1, minutes=3), body)],
                                          "exchange string, pair string, fetched_ts timestamp, body string"),
                    layout.rest, H)


def silver_hour(spark, layout, h="2025-12-01-01"):
    return read_hours(spark, layout.silver, [h], SILVER_STORED)


def snapshot(spark, layout):
    s = sorted(map(tuple, silver_hour(spark, layout).drop("hour").collect()))
    g = sorted(map(tuple, read_hours(spark, layout.gold_5m, ["2025-12-01-01"], GOLD_STORED).collect()))
    return s, g


def test_hourly_runs_late_minute_gap_fill_and_rerun(spark, scratch):
    layout = Layout(scratch)
    pairs = pair_dimension(spark)
    build_inputs(spark, layout)
    # minute 59 closes at 02:00 and its message lands under hour=02 (hour of event_ts)
    assert read_landing(spark, layout.landing, [H]).where("exchange = 'binance'").count() == 59
    assert read_landing(spark, layout.landing, [H + dt.timedelta(hours=1)]).count() == 1

    r1 = run_hour(spark, "2025-12-01-01:00", layout, pairs)
    counts = {(x.exchange, x.symbol): x.minutes for x in r1.completeness.collect()}
    assert counts[("binance", "BTCUSDT")] == 59
    assert counts[("kraken", "BTCUSD")] == 60              # 58 WS + 2 REST-filled minutes
    fill = {x.exchange: (x.ws_missing, x.filled_minutes) for x in r1.gap_fill.collect()
            if x.symbol in ("BTCUSD", "BTCUSDT")}
    assert fill["kraken"] == (62, 2)
    rest_rows = silver_hour(spark, layout).where("source = 'kraken_rest'").count()
    assert rest_rows == 2
    assert r1.metrics["ws_load"]["rows_skipped"] == 0
    assert r1.metrics["ws_load"]["rows"] == 59 + 58 and r1.metrics["ws_load"]["objects_seen"] >= 2
    assert r1.metrics["bronze_append"] == {"rows": 59 + 58 + 2, "ws_rows": 59 + 58, "rest_rows": 2}

    # the next hour's REST pages cover the same two Kraken minutes again
    (spark.read.parquet(layout.rest).drop("load_hour").withColumn("load_hour", F.lit("2025-12-01-02"))
     .write.mode("append").partitionBy("load_hour").parquet(layout.rest))
    run_hour(spark, "2025-12-01-02:00", layout, pairs)     # window [01:00, 03:00) picks minute 59 up
    rest_bronze = spark.read.parquet(layout.bronze).where("source = 'kraken_rest'")
    assert rest_bronze.count() == 2                          # not appended a second time
    assert silver_hour(spark, layout).where("exchange = 'binance'").count() == 60
    before = snapshot(spark, layout)
    assert len(before[1]) == 24                              # 12 five-minute buckets x 2 series
    run_hour(spark, "2025-12-01-02:00", layout, pairs)     # re-run: nothing changes
    assert snapshot(spark, layout) == before

    gaps = gaps_for(spark, layout, pairs, H + dt.timedelta(hours=3), lookback_hours=3)
    got = {(x.exchange, x.symbol, x.hour): x.missing_minutes for x in gaps.collect()}
    assert ("binance", "BTCUSDT", H) not in got and got[("kraken", "ETHUSD", H)] == 60
    keys = run_backfill(spark, layout, pairs.where("canonical_symbol = 'BTC-USD'"),
                        H + dt.timedelta(hours=3), lookback_hours=3)
    assert keys == ["2025-12-01-02:00", "2025-12-01-03:00"]     # hour 01 is complete
    assert run_backfill(spark, layout, pairs.where("canonical_symbol = 'BTC-USD'"),
                        H + dt.timedelta(hours=3), lookback_hours=3) == []   # requested once


def test_command_line_runs_an_hour(spark, scratch):
    from tallow.plans.run import main
    layout = Layout(scratch)
    build_inputs(spark, layout)
    out = main(["--root", scratch, "--hour", "2025-12-01-01:00"])
    assert out["all_series_complete"] is False
    assert "binance BTCUSDT 2025-12-01 01:00: 59/60" in out["alerts"]
    assert len(out["alerts"]) == 29                       # 28 silent series + BTCUSDT at 59
    back = main(["--root", scratch, "--backfill", "--as-of", "2025-12-01 03:10:00", "--lookback-hours", "1"])
    assert back["backfilled"] == ["2025-12-01-02:00"]


def test_hourly_runs_equal_batch_operators(spark, scratch):
    """Three on-disk runs over events-derived messages == the batch operators on them."""
    from tallow.operators import dedup_latest, rollup, to_silver
    from tallow.operators.load import to_bronze
    from tallow.sources.events import binance_messages, kraken_messages, read_events

    ev = read_events(spark, "/root/testdata/sf0.01")
    first = ev.agg(F.date_trunc("hour", F.min("ts"))).first()[0]
    hours = [first + dt.timedelta(hours=i) for i in range(3)]
    env = envelope_binance(binance_messages(ev)).unionByName(envelope_kraken(kraken_messages(ev)))
    env = env.where(F.date_trunc("hour", "event_ts").isin(hours))
    layout = Layout(scratch)
    write_landing(env, layout.landing)
    pairs = spark.createDataFrame(
        [(i, ex, sym, sym, sym, sym) for i, (ex, sym) in enumerate(
            (ex, f"{t.upper()}{q}") for ex, q in (("binance", "USDT"), ("kraken", "USD"))
            for t in ("click", "error", "purchase", "signup", "view"))],
        "pair_id int, exchange string, canonical_symbol string, rest_pair string, ws_pair string, "
        "warehouse_symbol string")
    folded = Layout(f"{scratch}/folded")
    write_landing(env, folded.landing)
    for h in hours:
        run_hour(spark, h, layout, pairs)
        run_hour(spark, h, folded, pairs, gold_from_5m=True)
    expected = to_silver(dedup_latest(to_bronze(env)))
    got = spark.read.parquet(layout.silver).drop("hour")
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0
    rounded = lambda df: df.withColumn("quote_volume", F.round("quote_volume", 6))  # addition order
    gold = rounded(spark.read.parquet(layout.gold_5m).drop("hour"))
    want = rounded(rollup(expected, 5))
    assert gold.exceptAll(want).count() == 0 and want.exceptAll(gold).count() == 0
    for size in ("gold_15m", "gold_30m", "gold_1h"):
        a = rounded(spark.read.parquet(getattr(layout, size)))
        b = rounded(spark.read.parquet(getattr(folded, size)))
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_run_hour_stops_on_duplicate_silver_keys(spark, scratch):
    import pytest
    from tallow.operators import to_silver
    from tallow.schemas import BRONZE
    from tallow.sources.tables import write_hours
    layout = Layout(scratch)
    t = H - dt.timedelta(hours=1)
    row = ("binance", "BTCUSDT", 60, t, t + dt.timedelta(minutes=1), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1,
           "binance_ws", t + dt.timedelta(seconds=5))
    dup = to_silver(spark.createDataFrame([row, row], BRONZE))
    write_hours(dup, layout.silver)                      # a corrupted hour: one key twice
    with pytest.raises(ValueError, match="duplicate key"):
        run_hour(spark, H, layout, pair_dimension(spark))
    assert spark.read.parquet(layout.silver).count() == 2  # not rewritten before the check


def _stages(spark):
    from tallow.session import checkpoint_root
    from tallow.sources.tables import existing_paths
    root = checkpoint_root(spark)
    return existing_paths(spark, [f"{root}/stages/*/*", f"{root}/*/rdd-*"])


def test_empty_rerun_clears_the_hour_and_nothing_is_left_behind(spark, scratch):
    layout, pairs = Layout(scratch), pair_dimension(spark).where("canonical_symbol = 'BTC-USD'")
    build_inputs(spark, layout)
    before = _stages(spark)
    first = run_hour(spark, H, layout, pairs)
    assert first.metrics["bronze_append"]["rows"] > 0
    # one WS minute of hour 01 is landed in hour 02; the REST page fills Kraken's last two minutes
    assert first.metrics["gap_fill"]["filled_minutes"] >= 2
    assert first.metrics["window"] == {"start": "2025-12-01T00:00:00", "end": "2025-12-01T02:00:00"}
    delete_path(spark, layout.landing)
    delete_path(spark, layout.rest)
    again = run_hour(spark, H, layout, pairs)
    assert again.metrics["bronze_append"]["rows"] == 0
    assert read_hours(spark, layout.bronze, ["2025-12-01-01"], BRONZE_STORED, partition_col="load_hour").count() == 0
    assert again.gap_fill.count() > 0 and _stages(spark) == before


def test_a_bad_rest_body_stops_the_hour_or_is_counted(spark, scratch):
    import pytest
    from pyspark.errors import PySparkException
    layout, pairs = Layout(scratch), pair_dimension(spark).where("canonical_symbol = 'BTC-USD'")
    build_inputs(spark, layout)
    bad = spark.createDataFrame([("kraken", "BTC/USD", H, '{"error":["EGeneral:Busy"]}'), ("binance", "BTCUSDT", H, "<html>")],
                                "exchange string, pair string, fetched_ts timestamp, body string")
    land_rest_pages(bad, layout.rest, H)
    with pytest.raises(PySparkException):
        run_hour(spark, H, layout, pairs)
    r = run_hour(spark, H, layout, pairs, strict_rest=False)
    assert r.metrics["rest_rejects"] == {"exchange_error": 1, "not_a_candle_array": 1}
    assert r.metrics["bronze_append"]["rest_rows"] == 2


def _files(spark, path):
    return sorted(spark.read.parquet(path).inputFiles())


def test_idle_rerun_writes_nothing_and_a_late_row_only_its_hour_and_buckets(spark, scratch):
    layout, pairs = Layout(scratch), pair_dimension(spark).where("canonical_symbol = 'BTC-USD'")
    build_inputs(spark, layout)
    first = run_hour(spark, H, layout, pairs)
    assert first.metrics["silver_merge"] == {"insert": 119, "update": 0, "unchanged": 0, "hours_written": 1}
    tables = [layout.silver, *[getattr(layout, f"gold_{n}") for n in ("5m", "15m", "30m", "1h")]]
    before = {t: _files(spark, t) for t in tables}
    again = run_hour(spark, H, layout, pairs)
    assert again.metrics["silver_merge"] == {"insert": 0, "update": 0, "unchanged": 119, "hours_written": 0}
    assert {t: _files(spark, t) for t in tables} == before

    # a run that stopped before it wrote silver: gold is ahead, and the next run ends up the same
    kept = sorted(map(tuple, spark.read.parquet(layout.gold_15m).collect()))
    delete_path(spark, layout.silver)
    run_hour(spark, H, layout, pairs)
    assert sorted(map(tuple, spark.read.parquet(layout.gold_15m).collect())) == kept

    # minute 59 lands in the next hour's prefix: one insert, one bucket of each size
    old = {n: {tuple(r)[:3]: tuple(r) for r in spark.read.parquet(getattr(layout, f"gold_{n}")).drop("hour").collect()} for n in ("5m", "1h")}
    later = run_hour(spark, H + dt.timedelta(hours=1), layout, pairs)
    assert later.metrics["silver_merge"]["insert"] == 1 and later.metrics["silver_merge"]["hours_written"] == 1
    for n, rows in old.items():
        new = {tuple(r)[:3]: tuple(r) for r in spark.read.parquet(getattr(layout, f"gold_{n}")).drop("hour").collect()}
        assert sum(new[k] != v for k, v in rows.items()) == 1 and len(new) == len(rows)
    whole = rollup(spark.read.parquet(layout.silver), 5)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, spark.read.parquet(layout.gold_5m).select(whole.columns).collect()))


def test_hourly_run_on_streamed_bronze(spark, scratch):
    from tallow.streaming.streams import run_available_now, stream_bronze
    mins = [H + dt.timedelta(minutes=i) for i in range(59)]
    feed = [("binance", "BTCUSDT", 1, None, binance_msg(t, 100.0)) for t in mins] + \
        [("kraken", "BTC/USD", 1, t, kraken_msg(t, 200.0)) for t in mins]
    spark.createDataFrame(feed, "exchange string, symbol string, interval_minutes int, received_ts timestamp, msg string") \
        .write.json(f"{scratch}/feed")
    layout = Layout(f"{scratch}/tables")
    run_available_now(stream_bronze(spark, f"{scratch}/feed", layout.bronze_stream, f"{scratch}/chk"))
    pairs = pair_dimension(spark).where("canonical_symbol = 'BTC-USD'")
    for _ in range(2):  # a re-run takes the rows up again
        r = run_hour(spark, H, layout, pairs, from_landing=False)
        # minute 58 ends at :59 and is stamped a second later, so all 59 are in the hour
        assert r.metrics["bronze_append"]["ws_rows"] == 118
        assert silver_hour(spark, layout).count() == 118
    # both tables can be read whole, and the stream's is untouched
    assert spark.read.parquet(layout.bronze).count() == 118 == spark.read.parquet(layout.bronze_stream).count()
