"""The VARIANT loader gives what the text loader gives, also for odd messages, without parsing text again."""

import pytest
from pyspark.errors import PySparkException

from tallow.operators.load import parse_ws
from tallow.operators.load_variant import parse_variant, variant_to_bronze
from tallow.sources.messages import envelope_binance, envelope_kraken
from tallow.sources.variant import read_variant_landing, variant_binance, variant_kraken, write_variant_landing

K = '{"E":1733014801000,"k":{"t":1733014800000,"T":1733014859999,"x":%s,"o":"1.5","h":"2","l":"1","c":%s,"v":"%s"%s,"n":%s}}'
BINANCE = [K % ("true", '"1.7"', "3", ',"q":"4.5"', "7"), K % ("true", '"1.7"', "0", "", '"7.0"'), K % ("false", '"1.7"', "3", "", "7"),
           K % ("true", '"abc"', "3", "", "7"), K % ("true", "null", "3", "", "7"), K % ("true", "true", "3", "", "7"), K % ("null", "1", "3", "", "7"),
           '{"E":1733014801000}', '{"E":1733014801000,"k":{}}', '{"E":1733014801000,"k":null}', '{"E":1733014801000,"k":{"y":1}}']
C = ('{"interval_begin":"2024-12-01T01:%02d:00Z","timestamp":"2024-12-01T01:%02d:00Z","open":%s,"high":2,"low":1,"close":1.7,"volume":3.0,'
     '"vwap":%s,"trades":%s}')
M = '{"channel":"ohlc","type":"%s","timestamp":"2024-12-01T01:05:00.5Z","data":%s}'
KRAKEN = [M % ("update", f"[{C % (3, 4, '1.5', '1.6', '7')}]"), M % ("snapshot", f"[{C % (3, 4, '1.5', 'null', '4.0')},{C % (4, 5, '9', '9', '9')}]"),
          M % ("update", f"[{C % (3, 4, '1', '1', '1')},{C % (3, 4, '2', '2', '2')}]"), M % ("update", f"[{C % (3, 4, 'true', '1', '1')}]"),
          M % ("update", f"[{C % (3, 4, '[1]', '1', '1')}]"), M % ("update", f"[{C % (3, 4, '1', '1', '1.5')}]"), M % ("update", "[]"),
          M % ("update", '[{"interval_begin":"2024-12-01T01:03:00Z","timestamp":"2024-12-01T01:04:00Z","open":1}]'),
          '{"channel":"heartbeat"}', '{"channel":"status","data":[{"system":"online"}]}', '{"type":"x"}']
OUT = ["exchange", "_symbol", "interval_seconds", "interval_start", "interval_end", "open", "high", "low", "close", "volume", "vwap",
       "trade_count", "source", "event_ts", "event_type", "is_final", "reject_reason"]


def raw(spark, messages, symbol):
    return spark.createDataFrame([(symbol, 1, m) for m in messages], "symbol string, interval_minutes int, msg string").selectExpr(
        "symbol", "interval_minutes", "timestamp '2024-12-01 01:06:00' AS received_ts", "msg")


def rows(df):
    return sorted((tuple(r) for r in df.select(*OUT).collect()), key=str)


@pytest.mark.parametrize("strict_first", [False, True])
def test_equals_the_text_loader(spark, strict_first):
    b, k = raw(spark, BINANCE, "BTCUSDT"), raw(spark, KRAKEN, "BTC/USD")
    text = parse_ws(envelope_binance(b).unionByName(envelope_kraken(k)), strict_first)
    variant = parse_variant(variant_binance(b).unionByName(variant_kraken(k)), strict_first)
    assert rows(variant) == rows(text)
    assert {r.reject_reason for r in variant.collect()} >= {None, "no_k", "not_final", "bad_value", "missing_keys"}


def test_landed_variants_load_without_parsing_text(spark, scratch):
    import datetime as dt
    k = raw(spark, KRAKEN[:3], "BTC/USD")
    write_variant_landing(variant_kraken(k), scratch)
    loaded = variant_to_bronze(read_variant_landing(spark, scratch, [dt.datetime(2024, 12, 1, 1)]))
    assert loaded.count() == 5 and read_variant_landing(spark, scratch, [dt.datetime(2024, 12, 1, 2)]).count() == 0
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan and "PythonUDF" not in plan


def test_text_that_is_no_json_and_unknown_exchanges(spark):
    broken = variant_binance(raw(spark, ["{", ""], "BTCUSDT"))
    assert [r.reject_reason for r in parse_variant(broken).collect()] == ["no_k", "no_k"]
    with pytest.raises(PySparkException, match="Unsupported exchange"):
        parse_variant(broken.selectExpr("'other' AS exchange", *[c for c in broken.columns if c != "exchange"])).collect()
