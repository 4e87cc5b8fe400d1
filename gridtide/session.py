"""Session helpers: a local session for tests/bench and reliable checkpoints.

The checkpoint folder is the shared one named by ``spark.checkpoint.dir``; it is
only set here when the session has none (tests, benchmarks).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def _default_driver_memory() -> str:
    """60% of physical memory, between 1 and 16 GiB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PHYS_PAGES") * os.sysconf("SC_PAGE_SIZE")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gib = int(total * 0.6 / 2**30)
    return f"{max(1, min(16, gib))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gridtide") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GRIDTIDE_DRIVER_MEMORY") or _default_driver_memory())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir`` (shared storage on a cluster).

    A local session without one (tests, benchmarks) gets a folder beside its
    tables, under ``spark.sql.warehouse.dir``. On a cluster that folder may be
    the driver's own disk, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable (shared-storage) checkpoint, never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class StageStore:
    """Tables written once for several readers, in a folder of their own that goes when the store is closed.

    The folder lies under the session's checkpoint folder (shared storage), so
    a lost executor reads the files again and recomputes nothing. Use it as a
    context manager, or call :meth:`close`; frames read from it end with it.
    """

    def __init__(self, spark: SparkSession, name: str = "stages"):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str = "stage") -> DataFrame:
        """``df`` written once as parquet and read back: later passes prune columns and push filters into it."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete all tables of the store."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def __enter__(self) -> StageStore:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def checkpoint_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written once under the checkpoint folder and read back, kept until the folder is cleared.

    For results that outlive the call; :class:`StageStore` deletes its tables.
    """
    return StageStore(df.sparkSession, name).table(df)
