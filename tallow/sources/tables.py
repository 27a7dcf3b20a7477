"""Partitioned Parquet tables: windowed reads and idempotent writes."""

from __future__ import annotations

import contextlib
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import HOUR_DIR_FORMAT, hour_partition, micros
from ..session import shared_dir

PARTITION_COL = "hour"
# Bronze is stored by the hour its rows were loaded for.
LOAD_COL = "load_hour"


def ts_lit(v) -> Column:
    """A timestamp literal from a datetime, ISO text or Column."""
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(v).cast("timestamp")


def read_window(df: DataFrame, window_start=None, window_end=None,
                time_col: str = "interval_start",
                partition_col: str | None = PARTITION_COL) -> DataFrame:
    """Rows with ``window_start <= time_col < window_end`` (either bound optional).

    When the frame carries the storage partition column the same bounds
    are also stated on it: Spark does not derive partition filters from
    ``interval_start``, so this is what prunes directories.
    """
    cond = F.lit(True)
    has_part = partition_col is not None and partition_col in df.columns
    if window_start is not None:
        ws = ts_lit(window_start)
        cond = cond & (F.col(time_col) >= ws)
        if has_part:
            cond = cond & (F.col(partition_col) >= F.date_format(F.date_trunc("hour", ws), HOUR_DIR_FORMAT))
    if window_end is not None:
        we = ts_lit(window_end)
        cond = cond & (F.col(time_col) < we)
        if has_part:
            last = we - micros(1)
            cond = cond & (F.col(partition_col) <= F.date_format(F.date_trunc("hour", last), HOUR_DIR_FORMAT))
    return df.where(cond)


def with_hour_partition(df: DataFrame, time_col: str = "interval_start") -> DataFrame:
    return df.withColumn(PARTITION_COL, hour_partition(time_col))


def write_hours(df: DataFrame, path: str, time_col: str = "interval_start",
                partition_col: str = PARTITION_COL,
                max_records_per_file: int = 5_000_000, rebalanced: bool = False) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic mode).

    Re-running a job rewrites the same partitions with the same rows, so
    a retried or repeated run is idempotent. A rebalance by the partition
    column lets AQE merge small hours into few files and split a hot hour
    over several tasks; ``maxRecordsPerFile`` bounds the file size.
    ``rebalanced`` says that ``df`` comes with that hint (below an
    ``observe``, whose counts a rebalance above it would lose when empty).
    """
    if partition_col not in df.columns:
        df = df.withColumn(partition_col, hour_partition(time_col))
    if not rebalanced:
        df = df.hint("rebalance", partition_col)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(partition_col)
       .parquet(path))


@contextlib.contextmanager
def staged(df: DataFrame, name: str):
    """``df`` written to the shared folder and read back; removed at the end.

    For a result that replaces partitions it was computed from: it survives
    lost executors, and nothing of it is left behind.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "stages", name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def existing_paths(spark: SparkSession, patterns) -> list[str]:
    """The directories matching any glob in ``patterns`` (Hadoop ``globStatus``).

    Lets a job open only the partitions it needs instead of having the
    file index list a whole table and prune afterwards; patterns that
    match nothing are skipped.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in patterns:
        path = jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(conf).globStatus(path)
        out.extend(st.getPath().toString() for st in (found or []))
    return sorted(set(out))


def read_hours(spark: SparkSession, path: str, hour_values, schema,
               partition_col: str = PARTITION_COL) -> DataFrame:
    """Read only the listed partitions ``partition_col=<value>`` of a table.

    Only those directories are listed; ``basePath`` keeps the partition
    column. Missing partitions are skipped; none at all gives an empty
    frame with ``schema``.
    """
    base = path.rstrip("/")
    dirs = existing_paths(spark, [f"{base}/{partition_col}={v}" for v in sorted(set(hour_values))])
    if not dirs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*dirs)
