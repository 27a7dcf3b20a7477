"""The hourly partition run and the gap-driven backfill, on partitioned Parquet.

Table layout under one root (a shared, durable folder):

* ``landing/``  Hive-partitioned JSON envelopes (``sources.landing``);
* ``rest/load_hour=H/``  landed REST responses ``(exchange, pair, fetched_ts, body)``;
* ``bronze_stream/load_hour=H/batch=B/``  rows loaded by streams, which alone write it;
* ``bronze/load_hour=H/``  bronze rows loaded by the run of hour ``H``;
* ``silver/hour=H/``  one row per series and minute;
* ``gold_{5m,15m,30m,1h}/hour=H/``  rollups;
* ``runs/``  one row per finished run (the run log);
* ``backfills/``  partition keys already requested by a backfill.

Every stage writes its own partitions with a dynamic overwrite, and the
next stage reads what was written, so a lost executor costs at most one
stage's recomputation and re-running an hour rewrites the same rows.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bronze import append_missing, bronze_union
from ..operators.dedup import dedup_latest
from ..operators.gaps import (backfill_plan, fetch_plan, gap_fill_check, gap_ranges, gap_report, minute_masks, rest_gap_fill,
                              ws_gaps)
from ..operators.load import accepted, parse_ws
from ..operators.quality import completeness, hour_ok, run_metrics
from ..operators.rollup import BUCKETS, gold_from_gold, refresh, rollup
from ..operators.silver import CHANGE, INSERT, UNCHANGED, UPDATE, assert_unique, merge_changes
from ..schemas import BRONZE, GOLD, SILVER
from ..session import checkpoint_root
from ..sources.landing import read_landing
from ..sources.rest import parse_rest, rest_rejects
from ..sources.tables import LOAD_COL, delete_path, existing_paths, read_hours, read_window, staged, with_hour_partition, write_hours

REST_LANDED = T.StructType([T.StructField("exchange", T.StringType()), T.StructField("pair", T.StringType()),
                            T.StructField("fetched_ts", T.TimestampType()), T.StructField("body", T.StringType())])


def _with(schema: T.StructType, col: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(col, T.StringType())])


BRONZE_STORED = _with(BRONZE, LOAD_COL)
SILVER_STORED = _with(SILVER, "hour")
GOLD_STORED = _with(GOLD, "hour")
REST_STORED = _with(REST_LANDED, LOAD_COL)


@dataclass(frozen=True)
class Layout:
    root: str

    def __getattr__(self, name):  # landing, rest, bronze, silver, runs, gold_5m ...
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def as_hour(key) -> dt.datetime:
    """Partition key ``yyyy-MM-dd-HH:mm``, ISO-8601 text or a datetime -> hour start (naive UTC)."""
    if isinstance(key, str):
        try:
            key = dt.datetime.strptime(key, "%Y-%m-%d-%H:%M")
        except ValueError:
            key = dt.datetime.fromisoformat(key.replace("Z", "+00:00"))
    if key.tzinfo is not None:
        key = key.astimezone(dt.timezone.utc)
    return key.replace(minute=0, second=0, microsecond=0, tzinfo=None)


def hour_value(h: dt.datetime) -> str:
    return h.strftime("%Y-%m-%d-%H")


@dataclass
class RunResult:
    hour: dt.datetime
    metrics: dict
    completeness: DataFrame
    hour_ok: DataFrame
    gap_fill: DataFrame


def run_hour(spark: SparkSession, key, layout: Layout, pairs: DataFrame,
             update_cols=None, gold_from_5m: bool = False, check_unique: bool = True,
             from_landing: bool = True, strict_rest: bool = True) -> RunResult:
    """Run partition ``key``: load, gap-fill, merge, roll up and report.

    ``pairs`` is the series dimension (``sources.pairs.pair_dimension``).
    The merge window is ``merge_window(key)``, two hours, so rows of the
    previous hour that landed late (e.g. minute 59 after the hour) are
    merged by the next run. ``from_landing=False`` takes the WS rows that
    ``stream_bronze`` has put into the hour's folder of ``bronze_stream``
    instead of loading the landing prefix; that table stays as it is.
    A REST body without candles fails the run, as the reference raises;
    ``strict_rest=False`` leaves it out and counts it by reason instead.
    ``gold_from_5m=True`` folds the 15m/30m/1h candles from the 5m partitions just written (one fifth of the rows)
    instead of re-reading silver; the result is the same. ``check_unique``
    fails the run, before silver is touched, if the rows to be written hold
    a key twice (the reference's unique index, checked with one aggregation).

    A re-run replaces the hour's bronze partition, also by nothing if nothing
    was loaded. Stages in the shared folder are removed as soon as the tables
    that need them are written. Silver and gold are written by change: hours in
    which the merge inserts or updates nothing are left alone, and within the
    others only gold buckets with a change are rebuilt, so an idle re-run writes
    neither.
    """
    checkpoint_root(spark)                # the stages below need the shared folder
    h = as_hour(key)
    ws, we = h - dt.timedelta(hours=1), h + dt.timedelta(hours=1)
    loads = [hour_value(h + dt.timedelta(hours=i)) for i in (-1, 0, 1)]
    this_load, tag = hour_value(h), f"{hour_value(h)}_{uuid.uuid4().hex[:8]}"
    series = pairs.select("exchange", F.col("warehouse_symbol").alias("symbol"))
    metrics = {"window": {"start": ws.isoformat(), "end": we.isoformat()}}

    with contextlib.ExitStack() as stages:
        # 1. WS rows of this hour, with reject counters.
        if from_landing:
            # the raw payload is not staged: nothing after the parse needs it
            parsed = parse_ws(read_landing(spark, layout.landing, [h], with_file=True)).drop("payload")
            parsed, ws_obs = run_metrics(parsed, f"ws_load_{tag}", rows_skipped=F.col("reject_reason").isNotNull())
            parsed = stages.enter_context(staged(parsed, "ws_load"))
            metrics["ws_load"] = {**ws_obs.get, "objects_seen": parsed.select(F.count_distinct("_file")).first()[0]}
            ws_rows = accepted(parsed)
        else:
            streamed = read_hours(spark, layout.bronze_stream, [this_load], BRONZE_STORED, partition_col=LOAD_COL)
            ws_rows = stages.enter_context(staged(streamed.drop(LOAD_COL).where(F.col("source").endswith("_ws")), "ws_load"))
            metrics["ws_load"] = {"rows": ws_rows.count()}

        # 2. REST gap fill: minutes of the window without a WS row, filled from this run's REST pages.
        earlier = read_hours(spark, layout.bronze, [x for x in loads if x != this_load], BRONZE_STORED,
                             partition_col=LOAD_COL).drop(LOAD_COL)
        ws_known = bronze_union(earlier.where(F.col("source").endswith("_ws")), ws_rows)
        gaps = stages.enter_context(staged(ws_gaps(ws_known, series, ws, we), "gaps"))
        pages = read_hours(spark, layout.rest, [this_load], REST_STORED, partition_col=LOAD_COL).drop(LOAD_COL)
        rest = parse_rest(pages, window_start=ws, strict=strict_rest)
        if not strict_rest:
            reasons = rest_rejects(pages).groupBy("reject_reason").count().collect()  # one row a reason
            metrics["rest_rejects"] = {r["reject_reason"]: r["count"] for r in reasons}
        # ON CONFLICT DO NOTHING on (silver key, source): a minute already filled
        # by an earlier run's REST pages is not appended twice
        fill = append_missing(earlier, rest_gap_fill(rest, gaps))
        loaded = bronze_union(ws_rows, fill).withColumn(LOAD_COL, F.lit(this_load)).hint("rebalance", LOAD_COL)
        loaded, append_obs = run_metrics(loaded, f"bronze_append_{tag}",
                                         ws_rows=F.col("source").endswith("_ws"),
                                         rest_rows=F.col("source").endswith("_rest"))
        write_hours(loaded, layout.bronze, partition_col=LOAD_COL, rebalanced=True)
        metrics["bronze_append"] = append_obs.get
        if not append_obs.get["rows"]:
            # a dynamic overwrite replaces only partitions that have rows
            delete_path(spark, f"{layout.bronze}/{LOAD_COL}={this_load}")

        # 3. Silver merge over the window; only hours that the merge changes are written.
        bronze_w = read_window(read_hours(spark, layout.bronze, loads, BRONZE_STORED, partition_col=LOAD_COL)
                               .drop(LOAD_COL), ws, we)
        silver_hours = [hour_value(ws), hour_value(h)]
        target = read_hours(spark, layout.silver, silver_hours, SILVER_STORED).drop("hour")
        merged = stages.enter_context(staged(with_hour_partition(merge_changes(target, dedup_latest(bronze_w), update_cols)), "silver"))
        if check_unique:
            assert_unique(merged)
        per_hour = merged.groupBy("hour").agg(F.count_if(F.col(CHANGE) == INSERT).alias(INSERT), F.count_if(F.col(CHANGE) == UPDATE).alias(UPDATE),
                                              F.count_if(F.col(CHANGE) == UNCHANGED).alias(UNCHANGED)).collect()  # at most two hours
        changed = [r["hour"] for r in per_hour if r[INSERT] or r[UPDATE]]
        metrics["silver_merge"] = {c: sum(r[c] for r in per_hour) for c in (INSERT, UPDATE, UNCHANGED)} | {"hours_written": len(changed)}
        rewritten = merged.where(F.col("hour").isin(changed))

        # 4. Gold: the changed buckets of these hours, from the change set. Silver is
        # written last: a run that stops in between leaves the change set as it was,
        # so the next one writes the same gold again.
        for name, minutes in BUCKETS.items():
            path = getattr(layout, f"gold_{name}")
            if not changed:
                continue
            if gold_from_5m and name != "5m":
                gold = gold_from_gold(read_hours(spark, layout.gold_5m, changed, GOLD_STORED).drop("hour"), minutes)
                write_hours(gold, path)
                continue
            old = read_hours(spark, path, changed, GOLD_STORED).drop("hour")
            with staged(refresh(old, rewritten.drop("hour"), minutes), f"gold_{name}") as gold:
                write_hours(gold, path)
        if changed:
            write_hours(rewritten.drop(CHANGE), layout.silver)
        silver_w = read_hours(spark, layout.silver, silver_hours, SILVER_STORED).drop("hour")

        # 5. Gap-fill counters: one row per series of the dimension.
        bronze_after = read_hours(spark, layout.bronze, loads, BRONZE_STORED, partition_col=LOAD_COL)
        per_series = gap_fill_check(bronze_after.drop(LOAD_COL), gaps)
        fill_check = spark.createDataFrame(per_series.collect(), per_series.schema)

    totals = fill_check.agg(F.coalesce(F.sum("ws_missing"), F.lit(0)), F.coalesce(F.sum("filled_minutes"), F.lit(0))).first()
    metrics["gap_fill"] = {"ws_missing": totals[0], "filled_minutes": totals[1]}

    # 6. Reports for the hour, and the run log.
    comp = completeness(silver_w, pairs, h, we)
    ok = hour_ok(silver_w, pairs, h, we)
    (spark.createDataFrame([(h.strftime("%Y-%m-%d-%H:%M"), this_load)], "partition_key string, hour string")
     .withColumn("finished_at", F.current_timestamp())
     .write.mode("append").parquet(layout.runs))
    return RunResult(h, metrics, comp, ok, fill_check)


def gaps_for(spark: SparkSession, layout: Layout, pairs: DataFrame, as_of, lookback_hours: int = 12) -> DataFrame:
    """Gap report over the completed hours of the lookback window."""
    end = as_hour(as_of)
    start = end - dt.timedelta(hours=lookback_hours)
    hours_ = [hour_value(start + dt.timedelta(hours=i)) for i in range(lookback_hours)]
    silver = read_hours(spark, layout.silver, hours_, SILVER_STORED).drop("hour")
    series = pairs.select("exchange", F.col("warehouse_symbol").alias("symbol"))
    return gap_report(silver, series, start, end)


def fetches_for(spark: SparkSession, layout: Layout, pairs: DataFrame, as_of, lookback_hours: int = 12,
                requested: DataFrame | None = None) -> DataFrame:
    """REST requests for the WS gaps in the completed hours of the lookback window.

    What they return is landed with ``sources.rest.land_rest_pages`` and taken up
    by ``run_hour``.
    """
    end = as_hour(as_of)
    start = end - dt.timedelta(hours=lookback_hours)
    loads = [hour_value(start + dt.timedelta(hours=i)) for i in range(lookback_hours + 1)]
    bronze = read_hours(spark, layout.bronze, loads, BRONZE_STORED, partition_col=LOAD_COL).drop(LOAD_COL)
    series = pairs.select("exchange", F.col("warehouse_symbol").alias("symbol"), "rest_pair")
    ranges = gap_ranges(minute_masks(bronze, start, end), series, start, end)
    return fetch_plan(ranges, requested).join(series, ["exchange", "symbol"])


def run_backfill(spark: SparkSession, layout: Layout, pairs: DataFrame, as_of,
                 lookback_hours: int = 12, **run_options) -> list[str]:
    """Re-run every incomplete hour of the lookback window once, oldest first.

    Keys already requested by an earlier backfill (``layout.backfills``)
    are skipped, so each key is requested once. The plan holds at most
    ``lookback_hours`` keys, so collecting it is bounded. ``run_options``
    (``update_cols``, ``gold_from_5m``, ...) go to ``run_hour``.
    """
    requested = spark.read.parquet(layout.backfills) if existing_paths(spark, [layout.backfills]) else None
    plan = backfill_plan(gaps_for(spark, layout, pairs, as_of, lookback_hours), requested)
    keys = [r.partition_key for r in plan.collect()]
    for k in keys:
        run_hour(spark, k, layout, pairs, **run_options)
        spark.createDataFrame([(k,)], "partition_key string").write.mode("append").parquet(layout.backfills)
    return keys


__all__ = ["Layout", "RunResult", "run_hour", "run_backfill", "gaps_for", "fetches_for", "as_hour"]
