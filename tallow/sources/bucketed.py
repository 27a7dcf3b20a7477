"""Silver as a bucketed table: a merge shuffles only what arrives.

The table is hashed by the silver key into a fixed number of buckets when it is
written. A join on that key reads the buckets as they are, so the stored side, by
far the larger one, is never dealt out again; only the arriving rows are, to as
many partitions as there are buckets, whatever the session's shuffle partitions.
(Spark still sorts each bucket for the join; the files are sorted already.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.silver import merge_silver
from ..schemas import SILVER_COLS, SILVER_KEY


def write_bucketed(silver: DataFrame, table: str, buckets: int, path: str) -> None:
    """Create or replace ``table``, stored at ``path``, in ``buckets`` buckets of the silver key.

    Rows are dealt to the buckets first, so that each bucket is one file.
    """
    (silver.select(*SILVER_COLS).repartition(buckets, *SILVER_KEY).write.mode("overwrite").format("parquet")
     .option("path", path).bucketBy(buckets, *SILVER_KEY).sortBy(*SILVER_KEY).saveAsTable(table))


def buckets_of(spark: SparkSession, table: str) -> int:
    """The number of buckets a table was written in."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    if found is None:
        raise ValueError(f"{table} is not bucketed")
    return int(found["data_type"])


def merge_bucketed(spark: SparkSession, table: str, source: DataFrame, update_cols=None) -> DataFrame:
    """``merge_silver`` of deduped ``source`` into a bucketed table, without a shuffle of the table."""
    arriving = source.repartition(buckets_of(spark, table), *SILVER_KEY)
    return merge_silver(spark.table(table), arriving, update_cols)
