"""Exact order statistics by narrowing value ranges.

A median over a table needs neither a sort nor a map of all values: a pass counts the
values of the range that still holds the wanted rank in equal bins, and the range
shrinks to the least and greatest value of the bin with the rank, a thousand times
smaller each pass, until both are the same value.  A pass is one map-side combined
count; at most (wanted ranks x bins) rows reach the driver, whatever the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024


def exact_medians(df: DataFrame, columns: list[str], bins: int = BINS) -> dict[str, float | None]:
    """Median of every column over its non-null, non-NaN values (mean of the middle two for an even count);
    None for a column without values."""
    if bins < 2:
        raise ValueError("at least two bins")
    x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    ends = df.agg(*[f(x[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    # per wanted rank: (column, rank among the values of the range, least, greatest value of the range)
    wanted = {}
    for i, c in enumerate(columns):
        for rank in {(ends[f"n{i}"] - 1) // 2, ends[f"n{i}"] // 2} if ends[f"n{i}"] else ():
            wanted[(c, rank)] = (rank, ends[f"lo{i}"], ends[f"hi{i}"])
    while open_ := {k: v for k, v in wanted.items() if v[1] < v[2]}:
        keys = list(open_)
        parts = []
        for k, key in enumerate(keys):
            _, lo, hi = open_[key]
            v = x[key[0]]
            at = F.least(F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * bins), F.lit(bins - 1)).cast("int")
            parts.append(F.when(v.between(lo, hi), F.struct(F.lit(k).alias("k"), at.alias("bin"), v.alias("v"))))
        counts = (df.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).select("p.*")
                  .groupBy("k", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                  .orderBy("k", "bin").collect())
        for k, key in enumerate(keys):
            rank = open_[key][0]
            for r in (r for r in counts if r["k"] == k):
                if rank < r["n"]:
                    wanted[key] = (rank, r["lo"], r["hi"])
                    break
                rank -= r["n"]
    out = {}
    for i, c in enumerate(columns):
        found = [v[1] for key, v in wanted.items() if key[0] == c]
        out[c] = sum(found) / len(found) if found else None
    return out


def impute(df: DataFrame, fill: dict[str, float | None]) -> DataFrame:
    """Missing values (null or NaN) of the columns replaced; columns with None stay as they are."""
    cols = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(v))
            for c, v in fill.items() if v is not None}
    return df.withColumns(cols) if cols else df
