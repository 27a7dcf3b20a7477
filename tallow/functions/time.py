"""Time helpers: buckets, hour keys and partition names (UTC session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partition key and partition name formats.
PARTITION_KEY_FORMAT = "yyyy-MM-dd-HH:mm"      # e.g. 2025-12-01-05:00
PARTITION_NAME_FORMAT = "yyyy_MM_dd_HH"        # e.g. 2025_12_01_05
HOUR_DIR_FORMAT = "yyyy-MM-dd-HH"              # storage partition value


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(c) -> Column:
    """``date_trunc('hour', c)``."""
    return F.date_trunc("hour", _c(c))


def minute_aligned(c) -> Column:
    """True where ``c`` sits exactly on a minute boundary."""
    return _c(c) == F.date_trunc("minute", _c(c))


def partition_key(c) -> Column:
    """Hour partition key string, ``yyyy-MM-dd-HH:00``."""
    return F.date_format(hour_of(c), PARTITION_KEY_FORMAT)


def partition_key_to_ts(c) -> Column:
    return F.to_timestamp(_c(c), PARTITION_KEY_FORMAT)


def partition_name(c) -> Column:
    """``yyyy_MM_dd_HH`` name of the hour partition holding ``c``."""
    return F.date_format(hour_of(c), PARTITION_NAME_FORMAT)


def hour_partition(c) -> Column:
    """Value of the ``hour`` storage partition column for ``c``."""
    return F.date_format(hour_of(c), HOUR_DIR_FORMAT)


def to_iso(c) -> Column:
    """ISO-8601 text with offset, microseconds kept."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def interval_label(minutes) -> Column:
    """``"{n}m"`` interval label."""
    return F.format_string("%dm", _c(minutes))


def minutes(n: int) -> Column:
    """Day-time interval literal of ``n`` minutes."""
    return F.expr(f"INTERVAL {int(n)} MINUTES")


def hours(n: int) -> Column:
    """Day-time interval literal of ``n`` hours."""
    return F.expr(f"INTERVAL {int(n)} HOURS")


def micros(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} MICROSECONDS")


def steps(start, stop, step: Column) -> Column:
    """``sequence(start, stop, step)``, or an empty array when ``start > stop``
    (an empty window yields no rows instead of failing the query)."""
    return F.when(start <= stop, F.sequence(start, stop, step)).otherwise(
        F.array().cast("array<timestamp>"))


def from_epoch_ms(c) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(c).cast("long"))


def from_epoch_ns(c) -> Column:
    """Epoch nanoseconds -> timestamp (microsecond precision, floor)."""
    ns = _c(c).cast("long")
    return F.timestamp_micros(((ns - F.pmod(ns, F.lit(1000))) / 1000).cast("long"))
