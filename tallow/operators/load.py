"""Landing envelopes -> bronze rows, with a reason for every rejected record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import normalize_symbol
from ..schemas import BRONZE_COLS

# Fixed value: keys a Kraken candle must carry (presence, not non-null).
KRAKEN_REQUIRED = ("open", "high", "low", "close", "volume", "vwap", "trades")


def _num(c: Column, strict: bool, to: str = "double") -> Column:
    return c.cast(to) if strict else c.try_cast(to)


# Fixed value: keys of a final Binance candle that ``strict`` insists on.
BINANCE_REQUIRED = ("o", "h", "l", "c", "v", "n")


def _int(c: Column, strict: bool) -> Column:
    """An integer, also where it is written as integral text such as ``4.0``."""
    whole = c.try_cast("double")
    as_int = F.coalesce(c.try_cast("int"), F.when(whole == F.floor(whole), whole.try_cast("int")))
    if not strict:
        return as_int
    return F.when(c.isNotNull() & as_int.isNull(), c.cast("int")).otherwise(as_int)


def _binance(k: Column, strict: bool):
    """Reject reason and values from the parsed ``k`` map."""
    has_k = k.isNotNull() & (F.size(k) > 0)
    final = F.coalesce(k["x"].try_cast("boolean"), F.lit(False))
    o, h, l, c, v = (_num(k[x], strict) for x in ("o", "h", "l", "c", "v"))
    q = F.coalesce(_num(k["q"], strict), F.lit(0.0))
    n = _int(k["n"], strict)
    if strict:
        lacking = F.filter(F.array(*[F.lit(x) for x in BINANCE_REQUIRED]), lambda x: ~F.map_contains_key(k, x))
        fail = F.raise_error(F.concat(F.lit("Binance candle without "), F.array_join(lacking, ", ")))
        n = F.when(has_k & final & (F.size(lacking) > 0), fail.cast("int")).otherwise(n)
    bad = o.isNull() | h.isNull() | l.isNull() | c.isNull() | v.isNull() | n.isNull()
    reason = (F.when(~has_k, "no_k").when(~final, "not_final").when(bad, "bad_value"))
    vwap = F.when(v > 0, q / v)
    return reason, (o, h, l, c, v, vwap, n)


def _kraken(data: Column, chosen: Column, strict: bool):
    """Reject reason and values from the parsed candle map ``chosen`` (NULL: none matches)."""
    has_keys = F.coalesce(F.forall(F.array(*[F.lit(x) for x in KRAKEN_REQUIRED]),
                                   lambda x: F.map_contains_key(chosen, x)), F.lit(False))
    has_data = data.isNotNull() & (F.size(data) > 0)
    names = ("open", "high", "low", "close", "volume", "vwap", "trades")
    vals = (*[_num(chosen[x], strict) for x in names[:-1]], _int(chosen["trades"], strict))
    bad = F.lit(False)
    for name, v in zip(names, vals):   # a present NULL is kept, other text must be a number
        bad = bad | (chosen[name].isNotNull() & v.isNull())
    reason = (F.when(~has_data, "no_data").when(chosen.isNull(), "no_matching_candle")
               .when(~has_keys, "missing_keys").when(bad, "bad_value"))
    return reason, vals


def parse_ws(env: DataFrame, strict_first: bool = False, strict: bool = False) -> DataFrame:
    """Every envelope with its bronze columns and ``reject_reason`` (NULL = kept).

    Binance: needs a non-empty ``k`` with ``x`` true; ``vwap = q / v`` when
    ``v > 0`` else NULL, a missing ``q`` counts as 0. Kraken: needs a
    non-empty ``data`` whose candle has all seven keys (a present NULL is
    kept) and whose other values are numbers (``bad_value``; integral text
    such as ``4.0`` counts as 4). The candle is the last element whose
    ``interval_begin`` equals the envelope's ``interval_start``, so a later
    update in the same message wins; with none the row is rejected
    (``no_matching_candle``). ``strict_first=True`` always uses the first
    element, as the reference does. An unknown exchange fails the query.
    ``strict=True`` makes unparsable numbers and missing Binance keys fail
    the query instead of rejecting the row.

    Each payload is parsed once (``from_json`` into a map, or an array of
    maps, which keeps "key present with NULL" apart from "key absent") in
    its own projection; Catalyst does not inline a non-trivial expression
    used many times, so later projections read the parsed columns.
    """
    ex = F.col("exchange")
    is_b, is_k = ex == "binance", ex == "kraken"
    msg = F.from_json("payload", "struct<k: map<string,string>, data: array<map<string,string>>>")
    parsed = env.select("*", msg.alias("_msg"))
    parsed = parsed.select(*env.columns, F.when(is_b, F.col("_msg.k")).alias("_k"),
                           F.when(is_k, F.col("_msg.data")).alias("_data"))
    first = F.get(F.col("_data"), 0)
    if strict_first:
        chosen = first
    else:
        own = F.filter("_data", lambda d: d["interval_begin"].try_cast("timestamp") == F.col("interval_start"))
        # status envelopes have no interval; their first element shows that keys are missing
        chosen = F.when(F.col("interval_start").isNull(), first).otherwise(F.try_element_at(own, F.lit(-1)))
    parsed = parsed.select("*", chosen.alias("_candle"))
    br, bv = _binance(F.col("_k"), strict)
    kr, kv = _kraken(F.col("_data"), F.col("_candle"), strict)
    unknown = F.raise_error(F.concat(F.lit("Unsupported exchange: "), F.coalesce(ex, F.lit("NULL"))))
    reason = (F.when(is_b, br).when(is_k, kr).otherwise(unknown.cast("string")))
    reason = F.coalesce(reason, F.when(F.col("interval_start").isNull()
                                       | F.col("interval_end").isNull(), F.lit("no_interval")))
    names = ("open", "high", "low", "close", "volume", "vwap", "trade_count")
    vals = [F.when(is_b, b).otherwise(k).alias(n) for n, b, k in zip(names, bv, kv)]
    out = F.struct(*[F.col(c) for c in env.columns], reason.alias("reject_reason"),
                   normalize_symbol("symbol").alias("_symbol"),
                   (F.col("interval_minutes") * 60).alias("interval_seconds"), *vals,
                   F.concat(ex, F.lit("_ws")).alias("source"))
    # Rows leave through a Generate: a later filter on reject_reason cannot be
    # pushed below it, so the payload is not parsed a second time inside the filter.
    return parsed.select(F.inline(F.array(out)))


def accepted(parsed: DataFrame) -> DataFrame:
    """The accepted rows of ``parse_ws`` as bronze rows (``ingestion_ts = event_ts``)."""
    return parsed.where(F.col("reject_reason").isNull()).select(
        "exchange", F.col("_symbol").alias("symbol"), F.col("interval_seconds").cast("int").alias("interval_seconds"),
        "interval_start", "interval_end", "open", "high", "low", "close", "volume", "vwap",
        "trade_count", "source", F.col("event_ts").alias("ingestion_ts")).select(*BRONZE_COLS)


def to_bronze(env: DataFrame, strict_first: bool = False, strict: bool = False) -> DataFrame:
    """Accepted envelopes as bronze rows (``source = exchange_ws``, ``ingestion_ts = event_ts``)."""
    return accepted(parse_ws(env, strict_first, strict))


def bronze_binance(env: DataFrame, strict: bool = False) -> DataFrame:
    return to_bronze(env.where(F.col("exchange") == "binance"), strict=strict)


def bronze_kraken(env: DataFrame, strict_first: bool = False, strict: bool = False) -> DataFrame:
    return to_bronze(env.where(F.col("exchange") == "kraken"), strict_first, strict)


def rejects(env: DataFrame, strict_first: bool = False) -> DataFrame:
    """Rejected envelopes with ``reject_reason``."""
    p = parse_ws(env, strict_first).where(F.col("reject_reason").isNotNull())
    return p.select(*env.columns, "reject_reason")
