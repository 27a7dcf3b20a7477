"""Column-level helpers (pure ``Column -> Column`` built-ins)."""

from .symbols import normalize_symbol, symbol_from_path
from .time import (from_epoch_ms, from_epoch_ns, hour_of, hour_partition,
                   hours, interval_label, micros, minute_aligned, minutes, partition_key,
                   partition_key_to_ts, partition_name, steps, to_iso)

__all__ = [
    "from_epoch_ms", "from_epoch_ns", "hour_of", "hour_partition", "hours",
    "interval_label", "micros", "minute_aligned", "minutes", "partition_key",
    "partition_key_to_ts", "partition_name", "steps", "to_iso",
    "normalize_symbol", "symbol_from_path",
]
