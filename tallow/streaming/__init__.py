"""Structured Streaming versions of the pipeline stages."""

from .streams import (final_candles, run_available_now, stream_bronze, stream_landing,
                      stream_rollup, stream_silver, stream_silver_merge)

__all__ = ["final_candles", "run_available_now", "stream_bronze", "stream_landing",
           "stream_rollup", "stream_silver", "stream_silver_merge"]
