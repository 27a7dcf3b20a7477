"""Latest-row-wins dedup (bronze -> one row per key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SILVER_KEY
from ..sources.tables import read_window


def dedup_latest(bronze: DataFrame, window_start=None, window_end=None,
                 tie_break=("source",), key=tuple(SILVER_KEY)) -> DataFrame:
    """Keep, per ``key``, the row with the greatest ``ingestion_ts``.

    Equal ``ingestion_ts`` is broken by ``tie_break`` (descending, so a
    ``*_ws`` row beats a ``*_rest`` row) and then by the remaining
    columns, so the survivor is the same on every run.

    Written as ``max(struct(order..., values...))`` per key instead of
    ``row_number()``: the partial aggregate keeps one row per key in each
    map task before the shuffle, so a key holding a large share of the
    rows never reaches one reducer whole, and the same operator runs on
    a stream (where ``row_number`` is not allowed).
    """
    df = bronze
    if window_start is not None or window_end is not None:
        df = read_window(df, window_start, window_end)
    key = list(key)
    head = ["ingestion_ts", *[c for c in tie_break if c != "ingestion_ts"]]
    rest = [c for c in df.columns if c not in key and c not in head]
    best = F.max(F.struct(*head, *rest)).alias("_best")
    out = df.groupBy(*key).agg(best)
    return out.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c)
                        for c in df.columns])
