"""Bronze set operations: union of loaders and append-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import BRONZE_COLS, SILVER_KEY

# Bronze has no declared key; conflicts are judged on the silver key plus source.
APPEND_KEY = (*SILVER_KEY, "source")


def bronze_union(*parts: DataFrame) -> DataFrame:
    """Bag union (``UNION ALL``) of loader outputs in bronze column order."""
    out = parts[0].select(*BRONZE_COLS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*BRONZE_COLS))
    return out


def append_missing(existing: DataFrame, new: DataFrame, key=APPEND_KEY) -> DataFrame:
    """Rows of ``new`` whose ``key`` is not in ``existing`` (``ON CONFLICT DO NOTHING``).

    Also drops repeats of a key inside ``new``, keeping the latest
    ``ingestion_ts``, so the appended rows never conflict with each other.
    """
    from .dedup import dedup_latest
    key = list(key)
    fresh = new.join(existing.select(*key), key, "left_anti")
    return dedup_latest(fresh, key=key).select(*new.columns)
