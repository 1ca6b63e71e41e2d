"""Latest row per key and newest-N per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """One row per key: the one with the greatest (order_cols...) tuple.

    A `max_by` aggregate over a struct of the remaining columns: one hash
    aggregate with partial (map-side) combine and one shuffle of at most one
    row per key per task, no sort, so a hot key costs nothing extra.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def newest_n_per_key(df: DataFrame, keys, ts_col: str, n: int,
                     rank_col: str = "rank") -> DataFrame:
    """Newest `n` rows per key (row_number <= n plans as WindowGroupLimit,
    which trims each partition to n rows per key before the window sort)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(ts_col).desc())
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
