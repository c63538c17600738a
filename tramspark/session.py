"""Session construction and the shared scratch folder.

Library functions never build a session; callers (tests, bench, the entry
module) do.  ``shared_dir`` is the only place that decides where derived
files go: the cluster's ``spark.checkpoint.dir`` when set, otherwise (local
mode only) a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size checks for every dimension join (no join is forced to broadcast
    # except 1-row aggregates): the planner broadcasts a side whose
    # estimated size (file and operator statistics) is under the static
    # threshold; AQE converts a sort-merge join to a broadcast join once it
    # has measured the shuffled side at runtime.  Larger sides are shuffled.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "tramspark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TRAMSPARK_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        spark.conf.set(k, conf[k])
    return spark


# For steps that write tables one after the other: the shuffle files of a step go when it is done, not when the driver
# next collects its garbage, which may be after all of them.
ONE_BY_ONE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; those of before come back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    *and* the master is local (tests, bench) is a temporary folder created and
    registered as the checkpoint folder.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tramspark-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the cluster's Hadoop file system."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder the library itself has staged, through the Hadoop file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
