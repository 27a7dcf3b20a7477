"""Symbol helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_symbol(c) -> Column:
    """Warehouse symbol: drop ``/`` and ``-`` (``BTC/USD``, ``BTC-USD`` -> ``BTCUSD``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "[/-]", "")


def symbol_from_path(path_col="path") -> Column:
    """``symbol=ETH-USD`` path segment -> ``ethusd``; a path without one fails the query."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    v = F.regexp_extract(c, r"symbol=([^/]+)", 1)
    absent = F.raise_error(F.concat(F.lit("No symbol in path: "), F.coalesce(c, F.lit("NULL"))))
    return F.when(v != "", F.lower(normalize_symbol(v))).otherwise(absent.cast("string"))
