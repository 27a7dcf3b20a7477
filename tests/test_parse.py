"""Message and REST parsing: the hand-written cases of FIXTURES.md."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallow.operators.load import bronze_kraken, parse_ws, rejects, to_bronze
from tallow.sources.messages import drop_heartbeats, envelope_binance, envelope_kraken
from tallow.sources.rest import parse_rest, rest_rejects

BIN = {"E": 1764550860012, "k": {"t": 1764550800000, "T": 1764550859999, "x": True, "o": "100.0",
                                 "h": "102.0", "l": "99.0", "c": "101.0", "v": "4.0", "q": "402.0", "n": 7}}
KR_TWO = ('{"channel":"ohlc","type":"snapshot","timestamp":"2025-12-01T01:02:00.123456789Z","data":['
          '{"interval_begin":"2025-12-01T01:00:00Z","timestamp":"2025-12-01T01:01:00Z","open":100.0,"high":102.0,'
          '"low":99.0,"close":101.0,"volume":4.0,"vwap":100.5,"trades":7},'
          '{"interval_begin":"2025-12-01T01:01:00Z","timestamp":"2025-12-01T01:02:00Z","open":101.0,"high":103.0,'
          '"low":100.0,"close":102.0,"volume":2.0,"vwap":101.5,"trades":3}]}')
KR_STATUS = '{"channel":"status","data":[{"system":"online"}]}'
KR_HEARTBEAT = '{"channel":"heartbeat"}'
RECEIVED = dt.datetime(2025, 12, 1, 1, 2, 30)


def binance(spark, *msgs):
    rows = [("BTCUSDT", 1, json.dumps(m)) for m in msgs]
    return envelope_binance(spark.createDataFrame(rows, "symbol string, interval_minutes int, msg string"))


def kraken(spark, *msgs):
    rows = [("BTC/USD", 1, RECEIVED, m) for m in msgs]
    return envelope_kraken(spark.createDataFrame(
        rows, "symbol string, interval_minutes int, received_ts timestamp, msg string"))


def with_k(**kw):
    m = json.loads(json.dumps(BIN))
    for key, val in kw.items():
        if val is None:
            m["k"].pop(key, None)
        else:
            m["k"][key] = val
    return m


def test_binance_final_candle_to_bronze(spark):
    r = to_bronze(binance(spark, BIN)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.exchange, r.symbol, r.interval_seconds, r.source) == ("binance", "BTCUSDT", 60, "binance_ws")
    assert r.interval_start == dt.datetime(2025, 12, 1, 1, 0)
    assert r.interval_end == dt.datetime(2025, 12, 1, 1, 0, 59, 999000)
    assert (r.open, r.high, r.low, r.close, r.volume, r.trade_count) == (100.0, 102.0, 99.0, 101.0, 4.0, 7)
    assert r.vwap == pytest.approx(100.5)
    assert r.ingestion_ts == dt.datetime(2025, 12, 1, 1, 1, 0, 12000)


def test_binance_rejects_nonfinal_missing_and_empty_k(spark):
    no_k = {"E": 1764550860012}
    empty_k = {"E": 1764550860012, "k": {}}
    env = binance(spark, with_k(x=False), no_k, empty_k, BIN)
    assert to_bronze(env).count() == 1
    reasons = sorted(r.reject_reason for r in rejects(env).collect())
    assert reasons == ["no_k", "no_k", "not_final"]


def test_binance_zero_volume_and_missing_q(spark):
    rows = {r.volume: r.vwap for r in to_bronze(binance(spark, with_k(v="0"))).collect()}
    assert rows == {0.0: None}
    rows = to_bronze(binance(spark, with_k(q=None))).collect()
    assert rows[0].vwap == 0.0


def test_kraken_two_candles_each_own_prices(spark):
    env = kraken(spark, KR_TWO)
    assert env.count() == 2
    got = sorted((r.interval_start.minute, r.open, r.trade_count) for r in to_bronze(env).collect())
    assert got == [(0, 100.0, 7), (1, 101.0, 3)]
    ref = sorted((r.interval_start.minute, r.open, r.trade_count)
                 for r in bronze_kraken(env, strict_first=True).collect())
    assert ref == [(0, 100.0, 7), (1, 100.0, 7)]
    r = to_bronze(env).collect()[0]
    assert r.symbol == "BTCUSD" and r.ingestion_ts == dt.datetime(2025, 12, 1, 1, 2, 0, 123456)


def test_kraken_missing_key_rejected_null_kept(spark):
    missing = KR_TWO.replace('"vwap":100.5,', "")
    null = KR_TWO.replace('"vwap":100.5', '"vwap":null')
    got = {r.interval_start.minute: r.vwap for r in to_bronze(kraken(spark, missing)).collect()}
    assert got == {1: 101.5}                       # minute 0 lacks the key
    got = {r.interval_start.minute: r.vwap for r in to_bronze(kraken(spark, null)).collect()}
    assert got == {0: None, 1: 101.5}              # present-but-null is kept


def test_kraken_status_landed_then_rejected_heartbeat_dropped(spark):
    raw = spark.createDataFrame([("BTC/USD", 1, RECEIVED, m) for m in (KR_STATUS, KR_HEARTBEAT)],
                                "symbol string, interval_minutes int, received_ts timestamp, msg string")
    assert drop_heartbeats(raw).count() == 1
    env = envelope_kraken(raw).collect()
    assert len(env) == 1 and env[0].event_type == "status" and env[0].is_final is None
    assert env[0].event_ts == RECEIVED and env[0].interval_start is None
    assert to_bronze(envelope_kraken(raw)).count() == 0
    assert [r.reject_reason for r in rejects(envelope_kraken(raw)).collect()] == ["missing_keys"]


def test_unknown_exchange_fails(spark):
    env = binance(spark, BIN).withColumn("exchange", F.lit("coinx"))
    with pytest.raises(PySparkException, match="Unsupported exchange"):
        parse_ws(env).collect()


REST = "exchange string, pair string, fetched_ts timestamp, body string"
FETCHED = dt.datetime(2025, 12, 1, 2, 5)


def test_rest_binance_and_kraken(spark):
    rows = [("binance", "BTCUSDT", FETCHED,
             '[[1764550800000,"100.0","102.0","99.0","101.0","4.0",1764550859999,"402.0",7]]'),
            ("kraken", "BTC/USD", FETCHED,
             '{"error":[],"result":{"XXBTZUSD":[[1764550800,"100.0","102.0","99.0","101.0","100.5","4.0",7]],'
             '"last":1764550860}}')]
    out = {r.exchange: r for r in parse_rest(spark.createDataFrame(rows, REST)).collect()}
    b, k = out["binance"], out["kraken"]
    assert (b.symbol, b.source, b.vwap, b.ingestion_ts) == ("BTCUSDT", "binance_rest", 100.5, FETCHED)
    assert b.interval_end == dt.datetime(2025, 12, 1, 1, 0, 59, 999000)
    assert (k.symbol, k.source, k.vwap, k.volume, k.trade_count) == ("BTCUSD", "kraken_rest", 100.5, 4.0, 7)
    assert k.interval_end == dt.datetime(2025, 12, 1, 1, 1)
    ref = parse_rest(spark.createDataFrame(rows[:1], REST), reference_vwap=True).first()
    assert ref.vwap == 402.0


def test_rest_kraken_window_start_and_error(spark):
    body = ('{"error":[],"result":{"XXBTZUSD":[[1764550740,"1","1","1","1","1","1",1],'
            '[1764550800,"2","2","2","2","2","2",1]],"last":1764550860}}')
    df = spark.createDataFrame([("kraken", "BTC/USD", FETCHED, body)], REST)
    got = [r.open for r in parse_rest(df, window_start=dt.datetime(2025, 12, 1, 1, 0)).collect()]
    assert got == [2.0]
    err = spark.createDataFrame([("kraken", "BTC/USD", FETCHED, '{"error":["EGeneral:Too many requests"]}')], REST)
    with pytest.raises(PySparkException, match="Kraken REST error"):
        parse_rest(err).collect()
    bad = spark.createDataFrame([("coinx", "BTC", FETCHED, "[]")], REST)
    with pytest.raises(PySparkException, match="Unsupported exchange"):
        parse_rest(bad).collect()


def test_bad_number_rejected_or_fails_when_strict(spark):
    env = binance(spark, with_k(o="abc"), BIN)
    assert [r.reject_reason for r in rejects(env).collect()] == ["bad_value"]
    assert to_bronze(env).count() == 1
    with pytest.raises(PySparkException):
        to_bronze(env, strict=True).collect()


KR_CANDLE = ('{"channel":"ohlc","type":"snapshot","timestamp":"2025-12-01T01:02:00Z","data":[{"interval_begin":"2025-12-01T01:00:00Z",'
             '"timestamp":"2025-12-01T01:01:00Z","open":100.0,"high":102.0,"low":99.0,"close":101.0,"volume":4.0,"vwap":100.5,"trades":7}]}')


def test_kraken_bad_values_are_rejected_and_integral_text_counts(spark):
    bad = KR_CANDLE.replace('"open":100.0', '"open":"abc"')
    whole = KR_CANDLE.replace('"trades":7', '"trades":4.0')
    env = kraken(spark, bad, whole)
    assert [r.reject_reason for r in rejects(env).collect()] == ["bad_value"]
    assert [r.trade_count for r in to_bronze(env).collect()] == [4]
    with pytest.raises(PySparkException):
        to_bronze(kraken(spark, bad), strict=True).collect()
    with pytest.raises(PySparkException):
        to_bronze(kraken(spark, KR_CANDLE.replace('"trades":7', '"trades":4.5')), strict=True).collect()


def test_kraken_candle_must_match_the_envelope_and_the_last_one_wins(spark):
    moved = kraken(spark, KR_CANDLE).withColumn("interval_start", F.col("interval_start") + F.expr("INTERVAL 5 MINUTES"))
    assert [r.reject_reason for r in rejects(moved).collect()] == ["no_matching_candle"]
    assert to_bronze(moved, strict_first=True).count() == 1
    candle = KR_CANDLE[KR_CANDLE.index("[") + 1:-2]
    twice = KR_CANDLE.replace(candle, candle + "," + candle.replace('"close":101.0', '"close":109.0'))
    assert {r.close for r in to_bronze(kraken(spark, twice)).collect()} == {109.0}


def test_strict_fails_on_a_missing_binance_key(spark):
    env = binance(spark, with_k(v=None))
    assert [r.reject_reason for r in rejects(env).collect()] == ["bad_value"]
    with pytest.raises(PySparkException, match="without v"):
        to_bronze(env, strict=True).collect()


@pytest.mark.parametrize("exchange, body, reason", [
    ("binance", '{"code":-1121,"msg":"Invalid symbol."}', "not_a_candle_array"),
    ("binance", '[[1764550800000,"1","2"', "not_a_candle_array"),
    ("binance", "<html>busy</html>", "not_a_candle_array"),
    ("binance", "[[1764550800000]]", "short_candle"),
    ("binance", None, "no_body"),
    ("kraken", '{"error":[]}', "no_result"),
    ("kraken", "<html>busy</html>", "no_result"),
    ("kraken", '{"error":["EGeneral"]}', "exchange_error"),
    ("kraken", '{"error":[],"result":{"X":"[[1,"}}', "broken_result"),
])
def test_malformed_rest_bodies_fail_or_are_counted(spark, exchange, body, reason):
    good = ("kraken", "BTC/USD", FETCHED, '{"error":[],"result":{"X":[[1764550800,"2","2","2","2","2","2",1]],"last":1}}')
    df = spark.createDataFrame([(exchange, "P", FETCHED, body), good], REST)
    assert [r.reject_reason for r in rest_rejects(df).collect()] == [reason]
    assert parse_rest(df, strict=False).count() == 1
    with pytest.raises(PySparkException):
        parse_rest(df).collect()
