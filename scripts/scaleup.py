"""Synthetic scale-up: the headline operators on events replicated k times.

    python scripts/scaleup.py [sf_dir] [k ...]

Replica r of an event becomes series ``{event_type}_{r}`` with its
``event_id``/``user_id`` shifted, so rows and series grow k-fold while
the time span stays the same (more series x same days). Prints one JSON
line per k with seconds per operator (noop sink, best of 2).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def replicated(events, k):
    r = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_r")
    ev = events.select("*", r)
    return ev.select(
        (F.col("event_id") * k + F.col("_r")).alias("event_id"), "ts",
        (F.col("user_id") * k + F.col("_r")).alias("user_id"),
        F.concat_ws("_", "event_type", F.col("_r").cast("string")).alias("event_type"),
        "value", "props")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ks = [int(x) for x in sys.argv[2:]] or [1, 4, 16]
    from tallow.operators import dedup_latest, gap_report, merge_silver, rollup, to_silver
    from tallow.plans.inputs import hour_bounds, series_of
    from tallow.session import build_session
    from tallow.sources.events import bronze_from_events, read_events
    spark = build_session("local[8]", app="tallow-scaleup", shuffle_partitions=8,
                          conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    base = read_events(spark, sf)
    for k in ks:
        ev = replicated(base, k).persist()
        n = ev.count()
        hour_b = bronze_from_events(ev, "hour")
        min_b = bronze_from_events(ev, "minute")
        silver = to_silver(dedup_latest(min_b))
        lo, hi = hour_bounds(silver)
        qs = {
            "dedup_latest": lambda: dedup_latest(hour_b),
            "silver_merge": lambda: merge_silver(
                to_silver(dedup_latest(hour_b.where(F.col("source").endswith("_rest")))), dedup_latest(hour_b)),
            "gold_5m": lambda: rollup(silver, 5),
            "gap_report": lambda: gap_report(silver, series_of(silver), lo, hi),
        }
        out = {}
        for name, q in qs.items():
            best = None
            for _ in range(2):
                t0 = time.perf_counter()
                q().write.format("noop").mode("overwrite").save()
                d = time.perf_counter() - t0
                best = d if best is None else min(best, d)
            out[name] = round(best, 3)
        print(json.dumps({"k": k, "rows": n, "series": 10 * k, "seconds": out}), flush=True)
        ev.unpersist()


if __name__ == "__main__":
    main()
