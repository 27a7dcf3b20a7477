"""Envelopes whose payload is a VARIANT -> bronze rows.

A message is parsed once, on arrival, into a VARIANT; the envelope's fields and
the loader's values are read from its binary form by path, so no JSON text is
parsed again. Rules and reject reasons are those of ``operators.load``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import normalize_symbol
from ..schemas import BRONZE_COLS
from .load import KRAKEN_REQUIRED, _int

PRICES = ("open", "high", "low", "close", "volume", "vwap", "trade_count")
# What is read of a message: each object by one cast. Kraken's fields stay
# variants, as a field that is there has one, if only that of a JSON null.
BINANCE_K = "struct<x: string, o: string, h: string, l: string, c: string, v: string, q: string, n: string>"
KRAKEN_DATA = f"array<struct<interval_begin: string, {', '.join(f'{f}: variant' for f in KRAKEN_REQUIRED)}>>"


def _number(c: Column) -> Column:
    return c.try_cast("double")


def _binance(k: Column, payload: Column):
    """Reject reason and values of a Binance message."""
    o, h, l, c, vol = (_number(k[f]) for f in "ohlcv")
    q, n = F.coalesce(_number(k["q"]), F.lit(0.0)), _int(k["n"], False)
    # only a message without a flag needs a look at whether ``k`` has any field at all
    empty = k["x"].isNull() & (F.coalesce(F.size(F.try_variant_get(payload, "$.k", "map<string,variant>")), F.lit(0)) <= 0)
    bad = o.isNull() | h.isNull() | l.isNull() | c.isNull() | vol.isNull() | n.isNull()
    reason = (F.when(empty, "no_k").when(~F.coalesce(k["x"].try_cast("boolean"), F.lit(False)), "not_final").when(bad, "bad_value"))
    return reason, (o, h, l, c, vol, F.when(vol > 0, q / vol), n)


def _kraken(data: Column, candle: Column, texts: Column):
    """The same of a Kraken message's candle, from its fields and their texts."""
    values = [_number(texts[f]) for f in KRAKEN_REQUIRED[:-1]] + [_int(texts[KRAKEN_REQUIRED[-1]], False)]
    absent, bad = F.lit(False), F.lit(False)
    for f, value in zip(KRAKEN_REQUIRED, values, strict=True):
        absent = absent | candle[f].isNull()
        bad = bad | (value.isNull() & texts[f].isNotNull()) | (texts[f].isNull() & ~F.is_variant_null(candle[f]))
    reason = (F.when(data.isNull() | (F.size(data) == 0), "no_data").when(candle.isNull(), "no_matching_candle")
              .when(absent, "missing_keys").when(bad, "bad_value"))
    return reason, values


def parse_variant(env: DataFrame, strict_first: bool = False) -> DataFrame:
    """Every envelope with its bronze columns and ``reject_reason`` (NULL = kept).

    Objects, the chosen candle and its texts each leave through a Generate, so
    that what follows reads them as columns and computes none of them twice.
    """
    ex, v = F.col("exchange"), F.col("payload")
    step = lambda df, **cols: df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
    read = step(env, _k=F.when(ex == "binance", F.try_variant_get(v, "$.k", BINANCE_K)),
                _data=F.when(ex == "kraken", F.try_variant_get(v, "$.data", KRAKEN_DATA)))
    first = F.get("_data", F.lit(0))
    if strict_first:
        chosen = first
    else:
        own = F.filter("_data", lambda d: d["interval_begin"].try_cast("timestamp") == F.col("interval_start"))
        chosen = F.when(F.col("interval_start").isNull(), first).otherwise(F.try_element_at(own, F.lit(-1)))
    read = step(read, _candle=chosen)
    text = lambda f: F.try_variant_get(F.col("_candle")[f], "$", "string").alias(f)
    read = step(read, _texts=F.when(F.col("_candle").isNotNull(), F.struct(*[text(f) for f in KRAKEN_REQUIRED])))
    b_reason, b = _binance(F.col("_k"), v)
    k_reason, k = _kraken(F.col("_data"), F.col("_candle"), F.col("_texts"))
    unknown = F.raise_error(F.concat(F.lit("Unsupported exchange: "), F.coalesce(ex, F.lit("NULL")))).cast("string")
    no_interval = F.col("interval_start").isNull() | F.col("interval_end").isNull()
    reason = F.coalesce(F.when(ex == "binance", b_reason).when(ex == "kraken", k_reason).otherwise(unknown),
                        F.when(no_interval, F.lit("no_interval")))
    values = {n: F.when(ex == "binance", x).otherwise(y) for n, x, y in zip(PRICES, b, k, strict=True)}
    out = step(read, reject_reason=reason, _symbol=normalize_symbol("symbol"),
               interval_seconds=(F.col("interval_minutes") * 60).cast("int"), **values, source=F.concat(ex, F.lit("_ws")))
    return out.drop("_k", "_data", "_candle", "_texts")


def variant_to_bronze(env: DataFrame, strict_first: bool = False) -> DataFrame:
    """Accepted envelopes as bronze rows."""
    return (parse_variant(env, strict_first).where("reject_reason IS NULL").withColumnRenamed("event_ts", "ingestion_ts")
            .drop("symbol").withColumnRenamed("_symbol", "symbol").select(*BRONZE_COLS))
