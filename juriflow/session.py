"""Session helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session with the settings this engine relies on."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("juriflow")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only where none is set (local runs and tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="juriflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a compressed table in the shared folder; a later read takes only the columns it needs."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` written to the shared folder and, if it has at most ``rows`` rows, marked for broadcast; a larger one is joined by shuffle."""
    kept = stored(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def release(spark: SparkSession) -> None:
    """Free what queries have kept so far: cached data and the tables in the shared folder.  Their results can no longer be read."""
    spark.catalog.clearCache()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "table-*")) or []:
        files.delete(found.getPath(), True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
