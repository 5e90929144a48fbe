"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster every staged file, checkpoint and ledger must live in the shared
folder the cluster names in ``spark.checkpoint.dir``; a machine-local
temporary folder is only used when the setting is absent and Spark runs in
local mode (tests, bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and bench.py (never by library code)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewater")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged data.

    Read from the session (``spark.checkpoint.dir``); only when it is unset
    *and* Spark runs locally do we pick a folder of our own and register it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: staged files and checkpoints need a "
            "folder shared by all executors"
        )
    root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(root)
    # setCheckpointDir creates a uuid subfolder; use what Spark reports.
    return (sc.getCheckpointDir() or root).rstrip("/")


class Store:
    """The file system of a path, for the driver's few steps on folders and names. Looks the JVM's classes up once, as
    each look-up is a round trip."""

    def __init__(self, spark: SparkSession, path: str):
        sc = spark.sparkContext
        self._path = sc._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(path).getFileSystem(sc._jsc.hadoopConfiguration())

    def path(self, text: str):
        return self._path(text)

    def exists(self, text: str) -> bool:
        return self.fs.exists(self._path(text))

    def full(self, text: str) -> str:
        """The path with its scheme, as Spark spells it."""
        return self.fs.makeQualified(self._path(text)).toString()

    def move(self, source: str, to: str) -> bool:
        """Rename into an existing folder."""
        return self.fs.rename(self._path(source), self._path(to))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/tidewater/{name}-{uuid.uuid4().hex}"
