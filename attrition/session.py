"""Spark session helpers.

The checkpoint folder is read from the session (``spark.checkpoint.dir``, or a
directory already set on the SparkContext).  Only when neither is set – local
runs and tests – a scratch folder is created under /tmp.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "attrition") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no broadcast from static size estimates: AQE switches a join to a
        # broadcast from the measured size of a finished shuffle stage
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ATTRITION_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the
    session.  A folder of this machine is made only where the setting is absent
    and the master is ``local``; on a cluster an absent setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="attrition-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared folder and read it
    back (survives executor loss; later plans prune columns and push filters)."""
    return write_table(df, "cut")


_collecting: list[list[str]] = []


@contextlib.contextmanager
def collect_tables():
    """The paths of all tables that ``write_table`` makes inside the block."""
    _collecting.append([])
    try:
        yield _collecting[-1]
    finally:
        _collecting.pop()


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh Parquet table in the shared folder, read back
    with ``df``'s schema."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    for paths in _collecting:
        paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._attrition_path = path
    return out


def drop_table(table: DataFrame) -> None:
    """Remove the files behind a table that ``write_table`` returned, once no later
    plan reads it."""
    drop_path(table.sparkSession, table._attrition_path)


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate or output table inside the shared
    folder (never a machine-local temp folder on a cluster)."""
    return os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor,
    whatever folder the driver was started from.  Once per SparkContext.  Rows that
    go to those workers are whole documents or chunks, so a batch is bounded by
    rows and bytes where the session has Spark's defaults."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    if getattr(sc, "_attrition_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="attrition-code-"), "attrition.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._attrition_shipped = True
