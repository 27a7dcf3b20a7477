"""The pair dimension: tokens x exchanges with their native symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The traded tokens, in the reference's order, and the two
# exchanges. Binance quotes in USDT, Kraken in USD; on Binance the REKT
# token trades as the 1000-unit contract 1000REKTUSDT.
TOKENS = ["eth", "sol", "btc", "link", "ape", "dot", "pepe", "trump", "pump",
          "jup", "pengu", "rekt", "fartcoin", "wif", "ksm"]
EXCHANGES = ["binance", "kraken"]
THOUSAND_UNIT_TOKENS = {("binance", "rekt")}

PAIR_SCHEMA = T.StructType([
    T.StructField("pair_id", T.IntegerType(), False),
    T.StructField("exchange", T.StringType(), False),
    T.StructField("canonical_symbol", T.StringType(), False),
    T.StructField("rest_pair", T.StringType(), False),
    T.StructField("ws_pair", T.StringType(), False),
    T.StructField("warehouse_symbol", T.StringType(), False),
])


def pair_rows() -> list[tuple]:
    """The 30 dimension rows; ``pair_id = 2 * token_index + exchange_index``."""
    rows = []
    for ti, tok in enumerate(TOKENS):
        for ei, ex in enumerate(EXCHANGES):
            up = tok.upper()
            lead = "1000" if (ex, tok) in THOUSAND_UNIT_TOKENS else ""
            if ex == "binance":
                rest, ws = f"{lead}{up}USDT", f"{lead}{tok}usdt"
            else:
                rest, ws = f"{up}/USD", f"{tok}/usd"
            rows.append((2 * ti + ei, ex, f"{up}-USD", rest, ws, rest.replace("/", "")))
    return rows


def pair_dimension(spark: SparkSession) -> DataFrame:
    """Small literal dimension (30 rows): safe to broadcast."""
    return spark.createDataFrame(pair_rows(), PAIR_SCHEMA)
