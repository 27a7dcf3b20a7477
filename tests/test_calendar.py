"""Calendar, readiness, partition keys and symbol helpers."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from pyspark.sql import functions as F

from tallow.functions import (from_epoch_ms, from_epoch_ns, interval_label, to_iso, normalize_symbol, partition_key, partition_key_to_ts,
                              partition_name, symbol_from_path)
from tallow.operators.calendar import (calendar_around, last_completed_hour, merge_window,
                                       partition_calendar, ready_partitions)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_last_completed_hour_and_merge_window(spark):
    r = one(spark, last_completed_hour("2025-12-01 05:17:00").alias("h"),
            *[c.alias(n) for c, n in zip(merge_window("2025-12-01 05:00:00"), ("ws", "we"))])
    assert r.h == dt.datetime(2025, 12, 1, 4)
    assert (r.ws, r.we) == (dt.datetime(2025, 12, 1, 4), dt.datetime(2025, 12, 1, 6))


def test_calendar_names_and_span(spark):
    cal = partition_calendar(spark, "2025-12-01 00:00:00", "2025-12-01 03:00:00").collect()
    assert [(r.partition_key, r.partition_name) for r in cal] == [
        ("2025-12-01-00:00", "2025_12_01_00"), ("2025-12-01-01:00", "2025_12_01_01"),
        ("2025-12-01-02:00", "2025_12_01_02")]
    assert cal[0].hour_end == dt.datetime(2025, 12, 1, 1)
    around = calendar_around(spark, "2025-12-01 05:17:00").orderBy("hour_start").collect()
    assert len(around) == 96
    assert around[0].hour_start == dt.datetime(2025, 11, 30, 5)
    assert around[-1].hour_start == dt.datetime(2025, 12, 4, 4)


def test_ready_partitions_three_minutes_after_close(spark):
    cal = partition_calendar(spark, "2025-12-01 04:00:00", "2025-12-01 06:00:00")
    ready = lambda as_of: [r.partition_key for r in ready_partitions(cal, as_of).orderBy("hour_start").collect()]
    assert ready("2025-12-01 06:02:59") == ["2025-12-01-04:00"]
    assert ready("2025-12-01 06:03:00") == ["2025-12-01-04:00", "2025-12-01-05:00"]


def test_partition_key_round_trip_and_labels(spark):
    t = F.lit("2025-12-01 05:42:10").cast("timestamp")
    r = one(spark, partition_key(t).alias("k"), partition_name(t).alias("n"),
            partition_key_to_ts(partition_key(t)).alias("back"), interval_label(F.lit(5)).alias("lab"))
    assert (r.k, r.n, r.back, r.lab) == ("2025-12-01-05:00", "2025_12_01_05", dt.datetime(2025, 12, 1, 5), "5m")


def test_symbol_helpers(spark):
    r = one(spark,
            symbol_from_path(F.lit("s3a://b/exchange=kraken/symbol=ETH-USD/interval_minutes=1/x.json")).alias("p"),
            normalize_symbol(F.lit("BTC/USD")).alias("a"), normalize_symbol(F.lit("BTC-USD")).alias("b"))
    assert (r.p, r.a, r.b) == ("ethusd", "BTCUSD", "BTCUSD")
    with pytest.raises(PySparkException, match="No symbol in path"):
        one(spark, symbol_from_path(F.lit("s3a://b/exchange=kraken/x.json")).alias("p"))


def test_epoch_and_iso(spark):
    r = one(spark, from_epoch_ms(F.lit(1764550800123)).alias("ms"),
            from_epoch_ns(F.lit(1764550800123456789)).alias("ns"),
            to_iso(from_epoch_ns(F.lit(1764550800123456789))).alias("iso"))
    assert r.ms == dt.datetime(2025, 12, 1, 1, 0, 0, 123000)
    assert r.ns == dt.datetime(2025, 12, 1, 1, 0, 0, 123456)
    assert r.iso == "2025-12-01T01:00:00.123456Z"


def test_as_hour_accepts_keys_iso_and_datetimes():
    from tallow.plans.hourly import as_hour
    h = dt.datetime(2025, 12, 1, 18)
    assert as_hour("2025-12-01-18:00") == h
    assert as_hour("2025-12-01 18:42:10") == h
    assert as_hour("2025-12-01T19:42:10+01:00") == h
    assert as_hour("2025-12-01T18:05:00Z") == h
    assert as_hour(dt.datetime(2025, 12, 1, 18, 59)) == h
