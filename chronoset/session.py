"""Session helpers and the shared scratch location.

All intermediate writes (lineage cuts, staged files, dimension versions made
by the example queries) go below the cluster's ``spark.checkpoint.dir`` so that
they survive the loss of an executor. A machine-local folder is used only when
no checkpoint directory is configured at all, as in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def create_session(app_name: str = "chronoset", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and dynamic partition overwrite on.

    No extra packages are pulled: every source and sink used by the library is
    built into Spark.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _size_listing_jobs(spark, conf or {})
    return spark


LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _size_listing_jobs(spark: SparkSession, conf: dict) -> None:
    """Size the distributed listing of many folders to the cluster.

    Listing more than a few folders (a day per folder) runs as a Spark job with
    one task per folder up to a fixed 10,000. Four tasks per core keeps every
    core busy on a large cluster and avoids thousands of tiny tasks on a small
    one. A value set by the caller wins.
    """
    if LISTING_PARALLELISM in conf or spark.sparkContext.getConf().contains(LISTING_PARALLELISM):
        return
    spark.conf.set(LISTING_PARALLELISM, str(max(32, 4 * spark.sparkContext.defaultParallelism)))


#: Scratch paths handed out by this process.
_scratch: list[str] = []


def close_session(spark: SparkSession) -> None:
    """Remove this process's scratch tables and stop the session (CLI use only; never inside a query)."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _scratch:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        p.getFileSystem(conf).delete(p, True)
    spark.stop()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context). Only when nothing is configured and the master is local, as in
    tests, a folder is made and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a driver-local folder is invisible to executors and lost with the driver
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="chronoset-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    _scratch.append(f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}")
    return _scratch[-1]
