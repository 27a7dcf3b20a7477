"""Compare a registered Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import collections
import datetime as dt
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> dict:
    """Row counts, column names and value multisets of Spark ``df`` vs DuckDB ``sql``."""
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    a, b = _bag(scols, srows), _bag(dcols, drows)
    return {"spark_rows": len(srows), "oracle_rows": len(drows),
            "columns_match": sorted(scols) == sorted(dcols), "values_match": a == b,
            "only_spark": list((a - b).items())[:3], "only_oracle": list((b - a).items())[:3],
            "spark_columns": sorted(scols), "oracle_columns": sorted(dcols)}
