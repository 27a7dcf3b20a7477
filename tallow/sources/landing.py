"""Hive-partitioned JSON landing zone (write and windowed scan).

Layout: ``exchange=/symbol=/interval_minutes=/year=/month=/day=/hour=``,
keyed on the hour of ``event_ts``; ``/`` in a symbol becomes ``-``.
Timestamps are written with microseconds so a round trip is lossless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ENVELOPE, LANDING_READ
from .tables import existing_paths
from .messages import ENVELOPE_COLS

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
PATH_COLS = ("exchange", "symbol", "interval_minutes", "year", "month", "day", "hour")


def landing_frame(env: DataFrame) -> DataFrame:
    """Envelopes plus the path columns (zero-padded text, UTC hour of ``event_ts``)."""
    t = F.col("event_ts")
    return env.select(
        *[c for c in ENVELOPE_COLS if c != "symbol"],
        F.regexp_replace("symbol", "/", "-").alias("symbol"),
        F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"),
        F.date_format(t, "dd").alias("day"), F.date_format(t, "HH").alias("hour"))


def write_landing(env: DataFrame, root: str, max_records_per_file: int = 500_000) -> None:
    """Append envelopes under ``root`` in the landing layout (unique part names).

    Rows are rebalanced by landing prefix: AQE gives small prefixes to few
    tasks and splits a hot one by size, whatever the number of rows or cores.
    """
    (landing_frame(env).hint("rebalance", *PATH_COLS)
        .write.mode("append").option("timestampFormat", TS_FORMAT)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PATH_COLS).json(root))


def read_landing(spark: SparkSession, root: str, hours=None, with_file: bool = False) -> DataFrame:
    """Envelopes landed under ``root``; ``hours`` (datetimes) limits the scan to those prefixes.

    With ``hours``, only the matching ``.../year=/month=/day=/hour=``
    directories are resolved (one glob per hour across exchanges and
    symbols) and read, so a run never lists the whole landing zone. The
    path values replace the body's exchange, symbol and interval_minutes,
    so a landed ``BTC/USD`` reads back as ``BTC-USD``. ``with_file`` adds
    ``_file`` (the source file, from the ``_metadata`` column) for counters.
    """
    cols = [*ENVELOPE_COLS, F.col("_metadata.file_path").alias("_file")] if with_file else ENVELOPE_COLS
    r = spark.read.schema(LANDING_READ).option("timestampFormat", TS_FORMAT).option("basePath", root)
    if hours is None:
        return r.json(root).select(*cols)
    dirs = hour_folders(spark, root, hours)
    if not dirs:
        empty = spark.createDataFrame([], ENVELOPE)
        return empty.withColumn("_file", F.lit(None).cast("string")) if with_file else empty
    return r.json(dirs).select(*cols)


def hour_folders(spark: SparkSession, root: str, hours) -> list[str]:
    """The prefixes of ``hours`` (datetimes) that exist, over all exchanges and symbols."""
    base = root.rstrip("/")
    return existing_paths(spark, [f"{base}/exchange=*/symbol=*/interval_minutes=*/"
                                  f"year={h:%Y}/month={h:%m}/day={h:%d}/hour={h:%H}" for h in sorted(set(hours))])
