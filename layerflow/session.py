"""Session construction and the shared scratch folder.

Everything that must be written between steps (CSV inputs for the CSV
source, published layer versions, checkpoints that cut lineage) goes under
the folder the cluster names in ``spark.checkpoint.dir``. A private folder
under the system temp dir is created only when the session has none and runs
in local mode, as in tests; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "layerflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for this session (``spark.checkpoint.dir``).

    Read from the session; set to a fresh private folder only when unset in
    local mode, where driver and executors are one process.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="layerflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub folder of the shared folder for one run of ``name``."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/layerflow/{name}-{uuid.uuid4().hex[:12]}"
    if _is_local_path(path):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COMPRESSION = "zstd"   # of what is written here: hex texts take half the bytes, which snappy does not give


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here drop their shuffle files when they end; else those stay
    until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


class Aside:
    """Tables that one run sets aside and reads again, as compressed columns in
    the shared folder. Unlike checkpoints, which are plain rows and stay until
    nothing refers to them, they go when they are dropped, the rest at the end of
    the ``with``. Neither the order nor the partitions of the rows are kept."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, shared_dir(spark, f"aside-{name}")
        self._paths: list[tuple[DataFrame, str]] = []

    def keep(self, *parts: DataFrame) -> DataFrame:
        """The rows of all parts, which are computed one after another."""
        path = f"{self.root}/{uuid.uuid4().hex[:12]}"
        with dropping_shuffles(self.spark):
            for part in parts:
                part.write.mode("append").option("compression", COMPRESSION).parquet(path)
        out = self.spark.read.schema(parts[0].schema).parquet(path)
        self._paths.append((out, path))
        return out

    def drop(self, table: DataFrame) -> None:
        for kept, path in self._paths:
            if kept is table:
                self._delete(path)

    def _delete(self, path: str) -> None:
        own = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)

    def __enter__(self) -> Aside:
        return self

    def __exit__(self, *failure) -> None:
        self._delete(self.root)
