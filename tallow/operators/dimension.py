"""Lookups against the pair dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def with_canonical_symbol(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add ``canonical_symbol`` (``BTC-USD``) by (exchange, warehouse symbol).

    Rows with no dimension entry get NULL (left join). The join strategy is
    left to Spark, which broadcasts the 30 literal rows by their known size.
    """
    dim = pairs.select("exchange", F.col("warehouse_symbol").alias("symbol"), "canonical_symbol")
    return df.join(dim, ["exchange", "symbol"], "left")
