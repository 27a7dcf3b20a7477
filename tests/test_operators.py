"""Dedup, merge, rollup, gap and completeness semantics (FIXTURES.md cases)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallow.operators import (completeness, dedup_latest, gap_report, gap_report_weighted,
                                hour_ok, merge_silver, rest_gap_fill, rollup, to_silver, upsert,
                                with_canonical_symbol, ws_gaps, append_missing, assert_unique,
                                backfill_plan, alerts)
from tallow.operators.rollup import gold_from_gold
from tallow.schemas import BRONZE, REFERENCE_UPDATE_COLS
from tallow.sources.pairs import pair_dimension

H = dt.datetime(2025, 12, 1, 1, 0)


def m(i):
    return H + dt.timedelta(minutes=i)


def row(minute, price=100.0, ingest=0, source="binance_ws", symbol="BTCUSDT", exchange="binance",
        volume=1.0, open_=None):
    t = m(minute)
    return (exchange, symbol, 60, t, t + dt.timedelta(seconds=60),
            price if open_ is None else open_, price + 1, price - 1, price, volume, price, 1, source,
            t + dt.timedelta(seconds=30 + ingest))


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def test_dedup_latest_wins_and_tie_break(spark):
    b = bronze(spark, [row(0, 1.0, ingest=0), row(0, 2.0, ingest=5),
                       row(1, 3.0, ingest=0, source="binance_rest"), row(1, 4.0, ingest=0, source="binance_ws")])
    got = {r.interval_start.minute: (r.close, r.source) for r in dedup_latest(b).collect()}
    assert got == {0: (2.0, "binance_ws"), 1: (4.0, "binance_ws")}
    # the same survivor whatever the input order / partitioning
    again = {r.interval_start.minute: (r.close, r.source) for r in dedup_latest(b.repartition(3)).collect()}
    assert again == got


def _silver(spark, rows):
    return to_silver(bronze(spark, rows))


def test_merge_older_newer_insert_and_idempotent(spark):
    target = _silver(spark, [row(0, 10.0, ingest=10), row(1, 10.0, ingest=0)])
    source = bronze(spark, [row(0, 20.0, ingest=5),        # older -> target kept
                            row(1, 30.0, ingest=9, volume=2.0),   # newer -> updated
                            row(2, 40.0)])                  # absent -> inserted
    out = {r.interval_start.minute: r for r in merge_silver(target, source).collect()}
    assert out[0].close == 10.0
    assert out[1].close == 30.0 and out[1].quote_volume == 60.0
    assert out[2].close == 40.0 and out[2].quote_asset == "USD"
    ref = {r.interval_start.minute: r for r in
           merge_silver(target, source, update_cols=REFERENCE_UPDATE_COLS).collect()}
    assert ref[1].close == 30.0 and ref[1].quote_volume == 10.0      # stale, as in the reference
    once = merge_silver(target, source)
    twice = merge_silver(once, source)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_merge_changes_and_touched_buckets(spark):
    from tallow.operators import merge_changes, refresh, touched
    from tallow.operators.rollup import bucket_of
    stored = _silver(spark, [row(0, 1.0), row(1, 2.0), row(20, 3.0), row(40, 4.0, ingest=50)])
    new = bronze(spark, [row(1, 9.0, ingest=40), row(20, 8.0), row(40, 8.0, ingest=10), row(21, 5.0)])
    changes = merge_changes(stored, dedup_latest(new))
    assert {r.interval_start: (r.change, r.close) for r in changes.collect()} == {
        m(0): ("unchanged", 1.0), m(1): ("update", 9.0), m(20): ("unchanged", 3.0),     # equal ingestion time: kept
        m(40): ("unchanged", 4.0), m(21): ("insert", 5.0)}
    assert changes.drop("change").exceptAll(merge_silver(stored, dedup_latest(new))).count() == 0
    assert {r.bucket for r in touched(changes, bucket_of(5)).collect()} == {m(0), m(20)}
    for minutes in (5, 15, 60):
        fresh = refresh(rollup(stored, minutes), changes, minutes)
        full = rollup(changes.drop("change"), minutes)
        assert fresh.exceptAll(full).count() == 0 and full.exceptAll(fresh).count() == 0
    none = merge_changes(stored, dedup_latest(new.limit(0)))
    assert touched(none, bucket_of(5)).count() == 0 and refresh(rollup(stored, 5), none, 5).exceptAll(rollup(stored, 5)).count() == 0


def test_assert_unique(spark):
    s = _silver(spark, [row(0), row(1)])
    assert assert_unique(s) is s
    with pytest.raises(ValueError):
        assert_unique(s.unionByName(s))


def test_rollup_null_open_and_missing_minutes(spark):
    s = _silver(spark, [row(0, 10.0, open_=None), row(2, 12.0), row(4, 14.0)])
    s = s.withColumn("open", F.when(F.minute("interval_start") == 0, F.lit(None)).otherwise(F.col("open")))
    g = rollup(s, 5).collect()
    assert len(g) == 1
    g = g[0]
    assert g.open is None and g.close == 14.0 and g.high == 15.0 and g.low == 9.0
    assert g.volume == 3.0 and g.trade_count == 3 and g.source == "derived"
    assert g.interval_start == H and g.interval_end == m(5)


def test_rollup_sizes_and_fold(spark):
    s = _silver(spark, [row(i, 100.0 + i) for i in range(60)])
    for minutes, n in ((5, 12), (15, 4), (30, 2), (60, 1)):
        assert rollup(s, minutes).count() == n
    direct = rollup(s, 60).first()
    folded = gold_from_gold(rollup(s, 5), 60).first()
    assert (direct.open, direct.close, direct.high, direct.low, direct.volume) == \
           (folded.open, folded.close, folded.high, folded.low, folded.volume)
    # window: only buckets inside [ws, we)
    assert rollup(s, 5, m(10), m(20)).count() == 2


def test_upsert_replaces_conflicts(spark):
    s = _silver(spark, [row(i, 100.0) for i in range(10)])
    old = rollup(s, 5)
    new = rollup(_silver(spark, [row(i, 200.0) for i in range(5)]), 5)
    out = {r.interval_start.minute: r.close for r in upsert(old, new).collect()}
    assert out == {0: 200.0, 5: 100.0}
    part = {r.interval_start.minute: (r.close, r.source) for r in
            upsert(old, new.withColumn("source", F.lit("x")), update_cols=("close",)).collect()}
    assert part == {0: (200.0, "derived"), 5: (100.0, "derived")}


def series(spark):
    return spark.createDataFrame([("binance", "BTCUSDT"), ("kraken", "BTCUSD")], "exchange string, symbol string")


def test_gap_report_full_partial_silent(spark):
    rows = [row(i) for i in range(60) if i not in (7, 8)]                 # 58 of 60
    s = _silver(spark, rows)
    got = {(r.exchange, r.hour): r.missing_minutes
           for r in gap_report(s, series(spark), H, H + dt.timedelta(hours=1)).collect()}
    assert got == {("binance", H): 2, ("kraken", H): 60}                  # silent series: 60
    w = gap_report_weighted(s, H).collect()
    assert [(r.exchange, r.missing_minutes) for r in w] == [("binance", 116)]   # 58 rows x 2


def test_completeness_and_hour_ok(spark):
    pairs = pair_dimension(spark)
    full = [row(i) for i in range(60)]
    partial = [row(i, exchange="kraken", symbol="BTCUSD", source="kraken_ws") for i in range(59)]
    s = _silver(spark, full + partial)
    got = {(r.exchange, r.symbol): (r.minutes, r.ok)
           for r in completeness(s, pairs, H, H + dt.timedelta(hours=1)).collect()}
    assert got[("binance", "BTCUSDT")] == (60, True)
    assert got[("kraken", "BTCUSD")] == (59, False)
    assert got[("kraken", "ETHUSD")] == (0, False)
    assert len(got) == 30
    ok = hour_ok(s, pairs, H, H + dt.timedelta(hours=1)).first()
    assert (ok.rows, ok.expected, ok.ok) == (119, 1800, False)
    comp = completeness(s, pairs, H, H + dt.timedelta(hours=1))
    texts = [r.text for r in alerts(comp).collect()]
    assert "kraken BTCUSD 2025-12-01 01:00: 59/60" in texts and len(texts) == 29


def test_ws_gaps_rest_fill_window_edges(spark):
    ws, we = H, H + dt.timedelta(hours=1)
    b = bronze(spark, [row(i) for i in range(60) if i != 30] +
               [row(5, source="binance_rest")])                            # REST does not count as WS
    gaps = ws_gaps(b, series(spark).where("exchange = 'binance'"), ws, we)
    assert [r.interval_start for r in gaps.collect()] == [m(30)]
    rest = bronze(spark, [row(30, 7.0, source="binance_rest"),              # fills the gap
                          row(31, 7.0, source="binance_rest"),              # present minute: not appended
                          row(60, 7.0, source="binance_rest")])             # first minute after window
    filled = rest_gap_fill(rest, gaps).collect()
    assert [r.interval_start for r in filled] == [m(30)]


def test_append_missing(spark):
    existing = bronze(spark, [row(0), row(1)])
    new = bronze(spark, [row(1), row(2), row(2, ingest=3)])
    got = [(r.interval_start.minute, r.ingestion_ts.second) for r in append_missing(existing, new).collect()]
    assert got == [(2, 33)]


def test_backfill_plan_distinct_sorted_and_logged(spark):
    s = _silver(spark, [row(i) for i in range(50)])
    gaps = gap_report(s, series(spark), H - dt.timedelta(hours=1), H + dt.timedelta(hours=1))
    keys = [r.partition_key for r in backfill_plan(gaps).collect()]
    assert keys == ["2025-12-01-00:00", "2025-12-01-01:00"]
    log = spark.createDataFrame([("2025-12-01-00:00",)], "partition_key string")
    assert [r.partition_key for r in backfill_plan(gaps, log).collect()] == ["2025-12-01-01:00"]


def test_thousand_unit_token_one_dimension_row(spark):
    pairs = pair_dimension(spark)
    rekt = {(r.exchange, r.warehouse_symbol, r.canonical_symbol, r.rest_pair, r.ws_pair)
            for r in pairs.where("canonical_symbol = 'REKT-USD'").collect()}
    assert rekt == {("binance", "1000REKTUSDT", "REKT-USD", "1000REKTUSDT", "1000rektusdt"),
                    ("kraken", "REKTUSD", "REKT-USD", "REKT/USD", "rekt/usd")}
    b = bronze(spark, [row(0, symbol="1000REKTUSDT")])
    assert with_canonical_symbol(b, pairs).first().canonical_symbol == "REKT-USD"
    assert pairs.count() == 30


def test_to_silver_normalizes_interval_end(spark):
    b = bronze(spark, [row(0)]).withColumn("interval_end", F.col("interval_start") + F.expr("INTERVAL 59.999 SECONDS"))
    assert to_silver(b).first().interval_end == m(0) + dt.timedelta(seconds=59.999)
    assert to_silver(b, normalize_end=True).first().interval_end == m(1)


def test_empty_or_partial_minute_windows_do_not_fail(spark):
    s = _silver(spark, [row(i) for i in range(3)])
    assert gap_report(s, series(spark), H, H).count() == 0                     # empty window
    b = bronze(spark, [row(0)])
    odd_end = H + dt.timedelta(hours=1, seconds=30)                            # ends inside a minute
    got = ws_gaps(b, series(spark).where("exchange = 'binance'"), H, odd_end).count()
    assert got == 59


def test_health_report_counts_mix_vwap_and_lag(spark):
    from tallow.operators import health_report
    rows = [row(0, 10.0, volume=1.0), row(1, 20.0, volume=3.0, source="binance_rest", ingest=90)]
    r = health_report(_silver(spark, rows)).first()
    assert (r.candles, r.minutes, r.ws_rows, r.rest_rows) == (2, 2, 1, 1)
    assert r.completeness == pytest.approx(2 / 60)
    assert (r.high, r.low, r.volume, r.quote_volume) == (21.0, 9.0, 4.0, 70.0)
    assert r.vwap == pytest.approx(70.0 / 4.0)
    # ingestion_ts - interval_end: row 1 is ingested 60 s after its minute closed
    assert r.max_lag_seconds == pytest.approx(60.0)


def test_lag_quantiles_of_merged_sketches_are_within_the_rank_error(spark):
    from tallow.operators import lag_quantiles, lag_sketches
    from tallow.operators.quality import LAG_RANK_ERROR
    n = 60_000   # 24 hours of many candles each, far more than a sketch keeps
    start = F.timestamp_seconds(F.unix_seconds(F.lit(H)) + (F.col("id") * 7) % (24 * 3600))
    us = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) * F.pmod(F.hash("id"), F.lit(7))
    silver = spark.range(n).select(F.lit("binance").alias("exchange"), F.lit("BTCUSDT").alias("symbol"), start.alias("interval_start"),
                                   start.alias("interval_end"), F.timestamp_micros(F.unix_micros(start) + us).alias("ingestion_ts"))
    lags = sorted(r[0] for r in silver.select(F.unix_micros("ingestion_ts") - F.unix_micros("interval_end")).collect())
    sketches = lag_sketches(silver)
    assert sketches.count() == 24
    found = lag_quantiles(sketches, F.lit("all"), quantiles=(0.0, 0.25, 0.5, 0.9, 0.99, 1.0)).collect()
    for r in found:
        below, upto = (sum(x < r.lag_us for x in lags) / n, sum(x <= r.lag_us for x in lags) / n)
        assert r.candles == n and below - LAG_RANK_ERROR <= r.quantile <= upto + LAG_RANK_ERROR
    assert lag_quantiles(lag_sketches(silver.limit(0)), F.lit("all")).count() == 0
