"""Ledger of landed objects: every object is loaded once, whoever loads it.

The ledger is a table of (path, length, modified, load_id), one row per object
that a committed load has read. A load lists the objects of its hours, takes
those the ledger lacks, writes their rows under a folder of its own
(``load_id=``) and appends the objects to the ledger; that append is its commit.
Rows are read through the ledger, so what a load left behind that stopped before
its commit is never read, and its objects are still new for the next one. An
object that was replaced (another length or time) is a new object.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRONZE, LANDING_READ
from .landing import TS_FORMAT, hour_folders
from .messages import ENVELOPE_COLS
from .tables import existing_paths

OBJECT = ["path", "length", "modified"]
LEDGER = "path string, length bigint, modified timestamp, load_id string"
LOAD_ID = "load_id"
LOADED = T.StructType([*BRONZE.fields, T.StructField(LOAD_ID, T.StringType())])


def landed_objects(spark: SparkSession, root: str, hours=None) -> DataFrame:
    """(path, length, modified) of the objects below ``root``, or of the prefixes of ``hours``.

    Listed by the file index; no object is opened.
    """
    folders = [root] if hours is None else hour_folders(spark, root, hours)
    if not folders:
        return spark.createDataFrame([], LEDGER).select(*OBJECT)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folders)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if not existing_paths(spark, [ledger]):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def new_objects(objects: DataFrame, ledger: DataFrame) -> DataFrame:
    """The objects that no committed load has read."""
    return objects.join(ledger.select(*OBJECT), OBJECT, "left_anti")


def read_objects(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The envelopes of the given landed objects."""
    return (spark.read.schema(LANDING_READ).option("timestampFormat", TS_FORMAT).option("basePath", root)
            .json(paths).select(*ENVELOPE_COLS))


def load_new(spark: SparkSession, root: str, ledger: str, out: str, load, hours=None) -> dict:
    """Load the new objects of ``hours`` (all, if not given) and record them.

    ``load`` turns envelopes into rows (``operators.load.to_bronze``), written
    to ``out/load_id=<id>``. Returns the load's id and counts; with nothing
    new, nothing is written. The paths of one load go through the driver, as
    they do for every scan.
    """
    found = new_objects(landed_objects(spark, root, hours), read_ledger(spark, ledger)).collect()
    if not found:
        return {"load_id": None, "objects": 0}
    load_id = uuid.uuid4().hex
    load(read_objects(spark, root, [r["path"] for r in found])).write.parquet(f"{out.rstrip('/')}/{LOAD_ID}={load_id}")
    commit(spark, ledger, found, load_id)
    return {"load_id": load_id, "objects": len(found)}


def commit(spark: SparkSession, ledger: str, objects: list, load_id: str) -> None:
    """Append the objects of a finished load to the ledger, in one file."""
    rows = [(r["path"], r["length"], r["modified"], load_id) for r in objects]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(ledger)


def read_loaded(spark: SparkSession, ledger: str, out: str) -> DataFrame:
    """The rows of all committed loads."""
    loads = [r[LOAD_ID] for r in read_ledger(spark, ledger).select(LOAD_ID).distinct().collect()]
    folders = existing_paths(spark, [f"{out.rstrip('/')}/{LOAD_ID}={i}" for i in loads])
    if not folders:
        return spark.createDataFrame([], BRONZE)
    return spark.read.schema(LOADED).option("basePath", out).parquet(*folders).drop(LOAD_ID)
