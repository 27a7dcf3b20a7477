"""Minute masks against plain minutes, and what they plan to."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallow.functions.bits import minute_bit, runs, starts, window_mask, without
from tallow.operators.gaps import fetch_plan, gap_fill_check, gap_ranges, minute_masks, ws_gaps
from tallow.schemas import BRONZE

H = dt.datetime(2025, 12, 1, 1)
MINUTE = dt.timedelta(minutes=1)


def row(minute, symbol="BTCUSDT", source="binance_ws", seconds=0):
    t = H + minute * MINUTE + dt.timedelta(seconds=seconds)
    return ("binance", symbol, 60, t, t + MINUTE, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, source, t)


def series(spark, *symbols):
    return spark.createDataFrame([("binance", s) for s in symbols], "exchange string, symbol string")


def minutes_of(mask):
    return [m for m in range(60) if mask >> m & 1]


def test_masks_hold_every_minute_of_an_hour(spark):
    df = spark.createDataFrame([(H + m * MINUTE,) for m in range(60)], "t timestamp")
    assert df.agg(F.bit_or(minute_bit("t"))).first()[0] == 2 ** 60 - 1
    full = spark.range(1).select(F.lit(H).alias("h"), F.lit(2 ** 60 - 1).alias("m"), F.lit(1 << 59).alias("last"), F.lit(0).cast("long").alias("none"))
    r = full.select(starts("h", "m").alias("all"), runs("h", "m").alias("run"), starts("h", "last").alias("last"),
                    runs("h", "none").alias("none"), without("m", "last").alias("rest")).first()
    assert r["all"] == [H + m * MINUTE for m in range(60)] and r["last"] == [H + 59 * MINUTE] and r["none"] == []
    assert [tuple(x) for x in r["run"]] == [(H, H + 60 * MINUTE)] and r["rest"] == 2 ** 59 - 1


@pytest.mark.parametrize("start, end, expected", [
    (0, 3600, range(60)), (-7200, 9000, range(60)), (60, 180, range(1, 3)), (61, 180, range(2, 3)), (0, 90, range(1)),
    (3600, 7200, []), (-60, 0, []), (120, 120, []), (180, 60, []), (3540, 3600, [59])])
def test_window_mask_has_the_whole_minutes_of_the_window(spark, start, end, expected):
    at = lambda s: F.lit(H + dt.timedelta(seconds=s))
    assert minutes_of(spark.range(1).select(window_mask(F.lit(H), at(start), at(end))).first()[0]) == list(expected)


def test_runs_equal_plain_runs(spark):
    r = random.Random(1)
    masks = [r.getrandbits(60) & r.getrandbits(60) for _ in range(40)] + [0, 1, 1 << 59, (1 << 60) - 1, (1 << 59) | 1]
    got = spark.createDataFrame([(i, H, m) for i, m in enumerate(masks)], "i int, h timestamp, m long").select(
        "i", runs("h", "m").alias("runs")).collect()
    for g in got:
        held = [H + m * MINUTE for m in minutes_of(masks[g["i"]])]
        expected = []
        for t in held:
            if expected and expected[-1][1] == t:
                expected[-1] = (expected[-1][0], t + MINUTE)
            else:
                expected.append((t, t + MINUTE))
        assert [tuple(x) for x in g["runs"]] == expected


def test_gaps_of_random_minutes(spark):
    r = random.Random(2)
    present = {m for m in range(-30, 200) if r.random() < 0.6}
    rows = [row(m) for m in present] + [row(5, source="binance_rest"), row(7, seconds=30), row(9)]
    b = spark.createDataFrame(rows, BRONZE)
    got = [x.interval_start for x in ws_gaps(b, series(spark, "BTCUSDT"), H, H + 150 * MINUTE).collect()]
    assert sorted(got) == [H + m * MINUTE for m in range(150) if m not in present | {9}]


def test_masks_count_rows_and_keep_odd_rows_out(spark):
    b = spark.createDataFrame([row(0), row(0), row(1, seconds=30), row(2, source="binance_rest")], BRONZE)
    m = minute_masks(b).first()
    assert (m.rows, minutes_of(m.ws), minutes_of(m.held)) == (4, [0], [0, 2])
    only_odd = minute_masks(spark.createDataFrame([row(1, seconds=30)], BRONZE)).first()
    assert (only_odd.rows, only_odd.ws, only_odd.held) == (1, 0, 0)


def test_ranges_cross_hours_and_are_cut_into_pages(spark):
    end = H + dt.timedelta(hours=40)
    rows = [row(m) for m in range(60 * 40) if not (50 <= m < 70 or 100 <= m < 2150)]
    b = spark.createDataFrame(rows + [row(3, "ETHUSDT")], BRONZE)
    ranges = gap_ranges(minute_masks(b), series(spark, "BTCUSDT", "SOLUSDT"), H, end)
    found = sorted((x.symbol, x.start, x.end, x.minutes) for x in ranges.collect())
    assert found == [("BTCUSDT", H + 50 * MINUTE, H + 70 * MINUTE, 20), ("BTCUSDT", H + 100 * MINUTE, H + 2150 * MINUTE, 2050),
                     ("SOLUSDT", H, end, 2400)]  # a silent series is one range
    plan = fetch_plan(ranges)
    btc = sorted((x.page, x.fetch_start, x.fetch_end) for x in plan.where("symbol = 'BTCUSDT' AND minutes > 1000").collect())
    assert btc == [(1, H + 100 * MINUTE, H + 1100 * MINUTE), (2, H + 1100 * MINUTE, H + 2100 * MINUTE), (3, H + 2100 * MINUTE, H + 2150 * MINUTE)]
    asked = plan.where("symbol = 'SOLUSDT' OR page = 1")
    assert [x.page for x in fetch_plan(ranges, asked).orderBy("page").collect()] == [2, 3]
    assert gap_ranges(minute_masks(b), series(spark, "BTCUSDT"), H, H).count() == 0


def test_masks_plan_to_hash_aggregates(spark):
    b = spark.createDataFrame([row(0)], BRONZE)
    gaps = ws_gaps(b, series(spark, "BTCUSDT"), H, H + 60 * MINUTE)
    for df in (gaps, gap_fill_check(b, gaps)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "collect_set" not in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
