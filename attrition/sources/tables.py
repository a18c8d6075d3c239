"""Readers for the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

import os
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; selecting ``columns`` here lets the scan prune the rest."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def input_version(spark: SparkSession, sf_dir: str) -> int:
    """A number that changes with an input folder (bytes, number of files, its tables'
    times), so that tables made from it once a session are made anew when it changes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = fs.getContentSummary(path)
    tables = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    return hash((whole.getLength(), whole.getFileCount(), *tables))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the left side's keys are kept.
    Spark picks the join by measured bytes (broadcast below its threshold, else a
    shuffle that AQE splits where it is skewed)."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__right_{k}" for k in keys])
