"""Session settings the operators are designed around."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed shuffle partitions of joins and coalesces small ones, so the
# shuffle partition count is an upper bound and not a tuning knob per query.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Splits of a few MB where an input is small, so that costly projections use all cores.
    "spark.sql.files.openCostInBytes": "1m",
}


def build_session(app_name: str = "reviewloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; a cluster submit sets the master, tests pass ``local[n]``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application: functions that run there are found by import."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    _SHIPPED.add(application)
    here = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp()  # the driver serves the archive from here for as long as it runs
    atexit.register(shutil.rmtree, folder, True)
    archive = Path(folder) / f"{here.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for f in sorted(here.rglob("*.py")):
            out.write(f, f.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Where it is unset in a single-process session (``local[n]``, a test) a fresh
    local folder stands in; with executors in other processes it must be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set; name a folder all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"reviewloom-{spark.sparkContext.applicationId}")
    os.makedirs(folder, exist_ok=True)
    return folder


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Rows dealt over all cores by a key, for steps that cost much a row and little a byte.

    The number of parts is given, since adaptive execution joins small parts again, and
    a small file is a single split.
    """
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *key)


# Shuffle files of a job are removed when it ends, by Spark itself (4.1 and later).
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame used by several jobs once and read it back.

    The written table survives lost executors, cuts the lineage and keeps column
    pruning, which a cached or checkpointed frame does not.
    """
    return Workspace(df.sparkSession, name).write(df)


class Workspace:
    """Tables of one run under a folder of its own in the shared folder.

    The owner drops a table as soon as nothing reads it any more, or all of them
    with ``close``; what a returned lazy frame still reads has to stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write a table and read it back. The shuffle files of the job go with its end: nothing reads them again, and a collection may come late."""
        before = self.spark.conf.get(_REMOVE_SHUFFLES, "false")
        self.spark.conf.set(_REMOVE_SHUFFLES, "true")
        try:
            df.write.mode("overwrite").parquet(self.path(name))
        finally:
            self.spark.conf.set(_REMOVE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables, and let Spark remove the shuffle files of jobs that were not written here, which it does when their objects are collected."""
        for name in names:
            self._delete(self.path(name))
        self.spark.sparkContext._jvm.System.gc()

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, where: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
