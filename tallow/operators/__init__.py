"""DataFrame -> DataFrame operators of the candle pipeline."""

from .dedup import dedup_latest
from .silver import assert_unique, merge_changes, merge_silver, to_silver, touched
from .rollup import gold_from_gold, refresh, rollup, rollup_touched, upsert
from .gaps import (backfill_plan, fetch_plan, gap_fill_check, gap_fill_of, gap_ranges, gap_report, gap_report_of,
                   gap_report_weighted, gaps_of, hourly_counts, minute_masks, rest_gap_fill, series_hours, ws_gaps)
from .quality import (alerts, completeness, completeness_of, health_report, hour_ok, hour_ok_of, lag_quantiles,
                      lag_sketches, load_counters, run_metrics)
from .calendar import (last_completed_hour, merge_window, partition_calendar,
                       ready_partitions)
from .bronze import append_missing, bronze_union
from .dimension import with_canonical_symbol

__all__ = [
    "dedup_latest", "assert_unique", "merge_changes", "merge_silver", "touched", "refresh", "rollup_touched", "to_silver", "rollup", "upsert",
    "gold_from_gold", "backfill_plan", "fetch_plan", "gap_ranges", "gap_fill_check", "gap_report",
    "gap_report_weighted", "gap_report_of", "gap_fill_of", "gaps_of", "hourly_counts", "minute_masks",
    "completeness_of", "hour_ok_of", "rest_gap_fill", "series_hours", "ws_gaps", "alerts",
    "completeness", "health_report", "hour_ok", "lag_quantiles", "lag_sketches", "load_counters", "run_metrics", "last_completed_hour",
    "merge_window", "partition_calendar", "ready_partitions", "append_missing",
    "bronze_union", "with_canonical_symbol",
]
