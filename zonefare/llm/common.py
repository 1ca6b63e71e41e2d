"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.session import checkpoint_dir

#: Java / Python pattern of the gaps between words (words are [^\x20\x09-\x0D]+).
GAP = r"[\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/zonefare-llm/{name}-{uuid.uuid4().hex}"


#: Folders that `stored_table` wrote and nobody freed yet, by application.
_TABLES: dict[str, list[str]] = {}


def stored_table(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder; the table read back, and its folder.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation) and
    gives the optimiser the true size, so that a later join is broadcast only
    if the table is under the session's threshold.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    return stored_table(df, name)[0]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a superseded table of this package from the shared folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    mine = _TABLES.get(spark.sparkContext.applicationId, [])
    if path in mine:
        mine.remove(path)


def stored_tables(spark: SparkSession) -> list[str]:
    """Folders of this application's inner tables that are still there."""
    return list(_TABLES.get(spark.sparkContext.applicationId, []))


def free_tables(spark: SparkSession, paths: list[str], *still_read: DataFrame) -> None:
    """Delete those of the folders that none of the given tables reads."""
    files = [f for df in still_read for f in df.inputFiles()]
    for path in paths:
        name = path.rsplit("/", 1)[-1]
        if not any(f"/{name}/" in f for f in files):
            delete_path(spark, path)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def unit_hash(*parts: Column | str) -> Column:
    """Uniform value in (0, 1) from md5 of the parts: 52 bits, the same in any SQL engine."""
    return (md5_int(13, *parts).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def md5_int(hex_digits: int, *parts: Column | str) -> Column:
    """The first hex digits (15 at most) of md5 over ':'-joined parts, as bigint; null parts are empty."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


@contextmanager
def rows_per_batch(spark: SparkSession, n: int):
    """Actions inside hand Python tasks at most `n` rows at a time: for rows of several megabytes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unsliced(array):
    """A copy of an Arrow array that starts at its own buffers: some string kernels misread slices."""
    import numpy as np
    import pyarrow as pa
    return array.take(pa.array(np.arange(len(array))))
