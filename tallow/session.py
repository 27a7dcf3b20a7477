"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings every tallow job relies on. UTC is required: bucket and
# hour arithmetic is defined on UTC wall-clock time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tallow",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the tallow defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to
    the data (about 128-256 MB per partition); AQE coalesces the rest.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the SQL settings tallow needs on an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def let_workers_import(spark: SparkSession) -> None:
    """Add this package's folder to the Python path of Spark's Python workers.

    Tasks import the package by name. Where it is installed, or on the path
    already, this changes nothing; in a checkout it saves setting PYTHONPATH.
    """
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder, registered for ``DataFrame.checkpoint()``.

    Read from the session (``spark.checkpoint.dir``). Only where it is unset
    in a one-process session (tests) is a folder inside the session's
    warehouse used; on any cluster, a local one included, that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder every "
                               "executor can reach (e.g. on HDFS or an object store)")
        root = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark).rstrip("/"), *parts, uuid.uuid4().hex])
