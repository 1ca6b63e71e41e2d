"""Parquet table loaders for the driver tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from zonefare.session import pin_utc


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one table; selecting columns here keeps ReadSchema narrow."""
    pin_utc(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a table is a folder of part files, on any file system Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()
