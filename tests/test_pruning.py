"""Window reads prune hour partitions at the scan; dedup/merge plans shuffle once."""

import contextlib
import datetime as dt
import io

from tallow.operators import dedup_latest, merge_silver, rollup, to_silver
from tallow.schemas import BRONZE
from tallow.sources.tables import read_hours, read_window, write_hours

H = dt.datetime(2025, 12, 1, 0, 0)


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def rows(n_hours):
    out = []
    for i in range(n_hours * 60):
        t = H + dt.timedelta(minutes=i)
        out.append(("binance", "BTCUSDT", 60, t, t + dt.timedelta(minutes=1), 1.0, 1.0, 1.0, 1.0, 1.0,
                    1.0, 1, "binance_ws", t + dt.timedelta(seconds=5)))
    return out


def test_read_window_prunes_hour_partitions(spark, scratch):
    silver = to_silver(spark.createDataFrame(rows(4), BRONZE))
    write_hours(silver, scratch)
    stored = spark.read.parquet(scratch)
    w = read_window(stored, H + dt.timedelta(hours=1), H + dt.timedelta(hours=2))
    p = plan(w)
    assert "PartitionFilters: [isnotnull(hour" in p and "2025-12-01-01" in p
    assert "PushedFilters: [IsNotNull(interval_start), GreaterThanOrEqual(interval_start" in p
    assert w.count() == 60
    g = rollup(stored, 5, H + dt.timedelta(hours=1), H + dt.timedelta(hours=2))
    assert "PartitionFilters: [isnotnull(hour" in plan(g) and g.count() == 12


def test_read_hours_lists_only_requested(spark, scratch):
    silver = to_silver(spark.createDataFrame(rows(3), BRONZE))
    write_hours(silver, scratch)
    got = read_hours(spark, scratch, ["2025-12-01-01", "2025-12-01-07"], silver.schema.add("hour", "string"))
    assert got.count() == 60
    assert all("hour=2025-12-01-01" in f for f in got.inputFiles())


def test_merge_joins_on_dedup_partitioning(spark):
    b = spark.createDataFrame(rows(2), BRONZE)
    merged = merge_silver(to_silver(dedup_latest(b.where("minute(interval_start) < 30"))), dedup_latest(b))
    tree = plan(merged).split("\n\n")[0]
    # exactly one shuffle per side (the dedup's); the join reuses its partitioning
    assert tree.count("Exchange") == 2
    assert "SortMergeJoin FullOuter" in tree
    # partial aggregation before each shuffle
    assert tree.count("SortAggregate") == 4


def test_bucketed_merge_does_not_shuffle_the_table(spark, scratch):
    import pytest
    from tallow.sources.bucketed import buckets_of, merge_bucketed, write_bucketed
    b = spark.createDataFrame(rows(2), BRONZE)
    target, source = to_silver(dedup_latest(b.where("minute(interval_start) < 30"))), dedup_latest(b)
    table = "bucketed_" + scratch.rsplit("/", 1)[-1]
    write_bucketed(target, table, 6, scratch)
    assert buckets_of(spark, table) == 6
    before = spark.conf.get("spark.sql.shuffle.partitions")
    plain = merge_silver(target, source)
    try:
        for partitions in ("2", "40"):  # fewer and more than buckets
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            merged = merge_bucketed(spark, table, source)
            stored = plan(merged).split("\n\n")[0].split("SortMergeJoin FullOuter")[1]
            stored = stored[:stored.index("Scan parquet") if "Scan parquet" in stored else None]
            assert "Exchange" not in stored
            assert merged.exceptAll(plain).count() == 0 and merged.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError):
        spark.range(1).createOrReplaceTempView("plain_view")
        buckets_of(spark, "plain_view")
