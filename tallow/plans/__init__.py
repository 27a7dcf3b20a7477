"""End-to-end plans: the hourly run, backfill, and the registered queries."""
