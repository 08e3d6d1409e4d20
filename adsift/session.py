"""Session helpers: build a session for tests/bench, and locate the shared folder.

Written tables and checkpoints go under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent and the master is
local (tests) is a private folder created and registered as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "adsift", driver_memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    """One JVM on this machine (``local-cluster`` starts separate executors)."""
    return master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir``.

    Without that setting, a ``local`` session gets a private folder; any other
    master is an error, since executors would write to their own disks.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not _is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="adsift-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
        folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder.

    What is written there outlives the query, since results may be read from it
    lazily; whoever owns the shared folder clears ``<folder>/adsift`` once the
    application has ended."""
    return f"{shared_dir(spark)}/adsift/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
