"""Session helpers: configuration for local runs and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "textoverlap", driver_memory: str | None = None) -> SparkSession:
    """Session with AQE on and the UI off. On a cluster pass master=None."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # the driver serves this file to executors for as long as the application runs
    path = os.path.join(tempfile.mkdtemp(prefix="textoverlap-"), "textoverlap.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    f = os.path.join(at, n)
                    z.write(f, os.path.relpath(f, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The setting is used as given; on a cluster it names storage that every
    executor sees. A private scratch folder stands in only when it is unset
    and driver and executors are one process (local mode, as in tests).
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            named = tempfile.mkdtemp(prefix="textoverlap-ckpt-")
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


def tables_dir(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables."""
    return os.path.join(checkpoint_dir(spark), "tables-" + spark.sparkContext.applicationId)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of re-running
    the upstream joins) and lets several downstream joins share one scan. Each
    call has a path of its own, which nothing writes again. The shuffle files
    of the write go once the table stands, as nothing reads them any more:
    executors hold those of one step, not of all steps before it.
    """
    return _written(df, name)[0]


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = os.path.join(tables_dir(spark), f"{name}-{uuid.uuid4().hex}")
    free_shuffles(spark)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def temporary(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for the jobs that run inside the ``with`` block: the table goes behind it."""
    table, path = _written(df, name)
    try:
        yield table
    finally:
        _delete(df.sparkSession, path)


def free_shuffles(spark: SparkSession) -> None:
    """From now on the shuffle files of a query of this session go when it has ended (a DataFrame that is used again is
    planned anew and does not read them). Set once; queries of other threads see the same value."""
    if spark.conf.get(_CLEANUP, "false") != "true":
        spark.conf.set(_CLEANUP, "true")


def drop_tables(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no frame over them is used any more."""
    _delete(spark, tables_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
