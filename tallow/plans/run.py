"""Command line for the hourly job and the gap backfill (what a scheduler calls).

    spark-submit --py-files tallow.zip scripts/run_hour.py --root s3a://bucket/candles --hour 2025-12-01-05:00
    python -m tallow.plans.run --root /data/candles --backfill --as-of "2025-12-01 18:00:00"

Prints one JSON line: the run counters and the completeness alerts of the
hour (or the keys a backfill re-ran). Only the alert rows of one hour
(at most one per series) are collected.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from ..operators.quality import alerts
from ..schemas import REFERENCE_UPDATE_COLS
from ..session import build_session
from ..sources.pairs import pair_dimension
from .hourly import Layout, run_backfill, run_hour


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="tallow.plans.run")
    ap.add_argument("--root", required=True, help="shared folder holding landing/, rest/, bronze/, silver/, gold_*")
    ap.add_argument("--hour", help="partition key yyyy-MM-dd-HH:mm")
    ap.add_argument("--backfill", action="store_true", help="re-run incomplete hours of the lookback")
    ap.add_argument("--as-of", help="reference time for --backfill (UTC)")
    ap.add_argument("--lookback-hours", type=int, default=12)
    ap.add_argument("--reference-update-cols", action="store_true",
                    help="update only the reference's nine silver columns on merge")
    ap.add_argument("--gold-from-5m", action="store_true",
                    help="fold 15m/30m/1h candles from the 5m partitions instead of silver")
    ap.add_argument("--streamed-bronze", action="store_true",
                    help="take the hour's WS rows from bronze, where stream_bronze put them, instead of landing")
    args = ap.parse_args(argv)
    spark = build_session()
    layout, pairs = Layout(args.root), pair_dimension(spark)
    options = {"update_cols": REFERENCE_UPDATE_COLS if args.reference_update_cols else None,
               "gold_from_5m": args.gold_from_5m, "from_landing": not args.streamed_bronze}
    if args.backfill:
        keys = run_backfill(spark, layout, pairs, args.as_of, args.lookback_hours, **options)
        out = {"backfilled": keys}
    else:
        r = run_hour(spark, args.hour, layout, pairs, **options)
        texts = [a.text for a in alerts(r.completeness).select("text").orderBy("text").collect()]
        ok = r.hour_ok.select(F.col("ok")).first()
        out = {"hour": args.hour, "metrics": r.metrics, "all_series_complete": bool(ok and ok.ok),
               "alerts": texts}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
