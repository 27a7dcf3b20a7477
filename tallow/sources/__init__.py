"""Scans: supplied tables, landing JSON, REST payloads, candle messages."""
