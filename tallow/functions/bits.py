"""Minutes of an hour as a 60-bit mask in one long (bit ``m`` = minute ``m``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES = 60


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _low(n: Column) -> Column:
    """The mask of the first ``n`` minutes, ``n`` from 0 to 60."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int")) - F.lit(1)


def minute_bit(c) -> Column:
    """The bit of the minute of timestamp ``c``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.minute(_c(c)))


def minutes_seen(c) -> Column:
    """Aggregate: the mask of all minutes of ``c`` (nulls are passed over), 0 for none."""
    return F.coalesce(F.bit_or(minute_bit(c)), F.lit(0).cast("long"))


def window_mask(hour, start, end) -> Column:
    """The minutes of ``hour`` that lie wholly in ``[start, end)``."""
    at = F.unix_micros(_c(hour))
    clip = lambda m: F.least(F.lit(MINUTES), F.greatest(F.lit(0), m))
    first = clip(F.ceil((F.unix_micros(_c(start)) - at) / F.lit(60_000_000)))
    last = clip(F.floor((F.unix_micros(_c(end)) - at) / F.lit(60_000_000)))
    return F.when(last > first, _low(last).bitwiseAND(F.bitwise_not(_low(first)))).otherwise(F.lit(0).cast("long"))


def without(mask, other) -> Column:
    """The minutes of ``mask`` that ``other`` lacks."""
    return _c(mask).bitwiseAND(F.bitwise_not(_c(other)))


def starts(hour, mask) -> Column:
    """The start of every minute in ``mask``, ascending, as an array of timestamps."""
    held = F.filter(F.sequence(F.lit(0), F.lit(MINUTES - 1)),
                    lambda m: F.call_function("shiftright", _c(mask), m).bitwiseAND(F.lit(1)) == 1)
    return F.transform(held, lambda m: F.timestamp_seconds(F.unix_seconds(_c(hour)) + m * 60))


def runs(hour, mask) -> Column:
    """The runs of consecutive minutes in ``mask`` as an array of ``(start, end)``, end excluded."""
    m = _c(mask)
    first = starts(hour, m.bitwiseAND(F.bitwise_not(F.shiftleft(m, 1))))
    last = starts(hour, m.bitwiseAND(F.bitwise_not(F.shiftright(m, 1))))
    return F.zip_with(first, last, lambda a, z: F.struct(a.alias("start"), (z + F.expr("INTERVAL 1 MINUTE")).alias("end")))
