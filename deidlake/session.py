"""Session helpers: a local session for tests/bench and the shared
workspace directory that jobs write to.

On a cluster the workspace lives under ``spark.checkpoint.dir`` (a shared
folder every executor can reach).  A private directory is only created
when that setting is unset, which happens in local tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

WORKSPACE_CONF = "spark.deidlake.root"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "deidlake") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Only when it is
    unset, and only on a local master, a private folder is created and set."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if conf:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(conf)
        return conf.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # set programmatically earlier in this application: Spark appended
        # an application folder; the folder it was set to is its parent
        return current.rstrip("/").rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="deidlake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def workspace_root(spark: SparkSession) -> str:
    """Root of the zone layout and of query scratch output:
    ``spark.deidlake.root`` if set, else ``<spark.checkpoint.dir>/deidlake``."""
    root = spark.conf.get(WORKSPACE_CONF, None)
    if root:
        return root.rstrip("/")
    return checkpoint_dir(spark) + "/deidlake"
