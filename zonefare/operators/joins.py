"""Joins the pricing pipeline needs beyond plain equi-joins.

* as-of join (latest right row at or before each left row, within a TTL)
* interval join against a per-zone event calendar
* look-up with a default row

Range predicates alone plan as a nested-loop join; every join here keeps an
equality on a key plus a time bucket so Spark can hash- or sort-merge join and
spread a hot key over many buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonefare.operators.scan import blocks_for, checkpointed, in_blocks, last_known


def asof_join(left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str,
              value_cols: list[str], tolerance_ms: int, bucket_ms: int = 3_600_000,
              tie: str | None = None) -> DataFrame:
    """For each left row, the right row with the greatest right_ts <= left_ts
    and left_ts - right_ts < tolerance_ms (same `by` value); nulls if none.

    Both sides go into one sorted stream per (by, time bucket) and a running
    `last(ignorenulls)` carries the newest right row forward; right rows
    younger than the tolerance at a bucket's end are copied into the next
    bucket so nothing is missed.  Cost is a sort of left + right rows, no
    pair enumeration, whatever the density of right rows.  Timestamps are
    epoch milliseconds; `tie` orders right rows with equal timestamps.
    """
    if tolerance_ms > bucket_ms:
        raise ValueError("tolerance must not exceed the bucket width")
    tie_col = F.col(tie) if tie else F.lit(0)
    r = right.select(F.col(by), F.col(right_ts).alias("_t"),
                     F.struct(F.col(right_ts).alias("_rt"), *[F.col(c) for c in value_cols]).alias("_r"),
                     tie_col.cast("string").alias("_tie"))
    r = r.withColumn("_bucket", F.floor(F.col("_t") / bucket_ms))
    r_next = (r.filter(F.col("_t") > (F.col("_bucket") + 1) * bucket_ms - tolerance_ms)
              .withColumn("_bucket", F.col("_bucket") + 1))
    right_all = r.unionByName(r_next).withColumn("_kind", F.lit(0))
    lcols = left.columns
    l_ = (left.withColumn("_t", F.col(left_ts))
          .withColumn("_bucket", F.floor(F.col(left_ts) / bucket_ms))
          .withColumn("_kind", F.lit(1)).withColumn("_tie", F.lit(None).cast("string"))
          .withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType)))
    # right rows: only the join columns; left rows carry their own columns
    right_all = right_all.select(
        *[F.lit(None).cast(left.schema[c].dataType).alias(c) if c != by else F.col(by)
          for c in lcols], "_t", "_bucket", "_kind", "_tie", "_r")
    l_ = l_.select(*lcols, "_t", "_bucket", "_kind", "_tie", "_r")
    w = (Window.partitionBy(by, "_bucket").orderBy("_t", "_kind", "_tie")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (l_.unionByName(right_all)
           .withColumn("_m", F.last("_r", ignorenulls=True).over(w))
           .filter(F.col("_kind") == 1))
    fresh = (F.col("_t") - F.col("_m._rt")) < tolerance_ms
    m = F.when(fresh, F.col("_m"))
    return out.select(*lcols, *[m[c].alias(c) for c in value_cols],
                      m["_rt"].alias(f"{right_ts}_matched"))


def asof_scan(left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str, value_cols: list[str],
              tolerance_ms: int, tie: str, rows_per_block: int = 100_000) -> DataFrame:
    """`asof_join` for any skew: a blocked scan instead of a window per (by, bucket).

    Left and right rows are range-partitioned together by (by, time), so a key or an
    hour that holds most rows is spread over many tasks, and the newest right row is
    carried from block to block: any tolerance, no copies.
    """
    value = F.struct(F.col(right_ts).alias("t"), *[F.col(c) for c in value_cols])
    r = right.select(F.col(by), F.col(right_ts).alias("__t"), F.lit(0).alias("__kind"),
                     F.col(tie).cast("string").alias("__tie"), value.alias("__r"))
    l_ = left.withColumns({"__t": F.col(left_ts), "__kind": F.lit(1), "__tie": F.lit(None).cast("string"),
                           "__r": F.lit(None).cast(r.schema["__r"].dataType)})
    both = l_.unionByName(r, allowMissingColumns=True)
    stored = checkpointed(in_blocks(both, [by, "__t", "__kind", "__tie"], blocks_for(both, rows_per_block)))
    out = last_known(stored, {"__m": F.col("__r")}, [by]).filter(F.col("__kind") == 1)
    m = F.when((F.col("__t") - F.col("__m.t")) < tolerance_ms, F.col("__m"))
    return out.select(*left.columns, *[m[c].alias(c) for c in value_cols], m["t"].alias(f"{right_ts}_matched"))


def winner_segments(calendar: DataFrame, key: str = "zone_id", start: str = "start_ms",
                    end: str = "end_ms", bucket_ms: int = 86_400_000, tie: str = "event_id") -> DataFrame:
    """Resolve overlapping intervals per key: at any instant the active
    interval with the earliest start wins.

    Interval i wins on [max(start_i, M_i), end_i) where M_i is the latest end
    among intervals starting before i.  Only intervals that still cover start_i
    can raise the maximum, so each interval is copied into every bucket it
    covers (any length) and the running max is taken per (key, bucket); the
    row of the interval's first bucket gives the result.  The result is
    disjoint segments per key; equal starts are ordered by `tie`.
    """
    first = F.floor(F.col(start) / bucket_ms)
    last = F.greatest(first, F.floor((F.col(end) - 1) / bucket_ms))
    spread = calendar.withColumn("_first", first).withColumn("_b", F.explode(F.sequence(first, last)))
    w = (Window.partitionBy(key, "_b").orderBy(start, tie)
         .rowsBetween(Window.unboundedPreceding, -1))
    return (spread.withColumn("_m", F.max(end).over(w))
            .filter(F.col("_b") == F.col("_first"))
            .withColumn("seg_start", F.greatest(F.col(start), F.coalesce(F.col("_m"), F.col(start))))
            .filter(F.col("seg_start") < F.col(end))
            .drop("_b", "_first", "_m"))


def interval_lookup(facts: DataFrame, segments: DataFrame, key: str, ts: str,
                    value_cols: list[str], seg_start: str = "seg_start", seg_end: str = "end_ms",
                    bucket_ms: int = 60_000) -> DataFrame:
    """Attach the segment covering each fact (disjoint segments per key).

    Segments are exploded into the minute buckets they cover (disjoint, so at
    most one bucket-minute of overlap per boundary), then equi-joined on
    (key, bucket) with the range as a residual condition: each fact meets one
    or two candidates, and a hot key spreads over all its minutes.
    """
    s = segments.select(F.col(key).alias("_k"), F.col(seg_start).alias("_s"),
                        F.col(seg_end).alias("_e"), *value_cols)
    s = s.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_s") / bucket_ms),
                                                     F.floor((F.col("_e") - 1) / bucket_ms))))
    f = facts.withColumn("_bucket", F.floor(F.col(ts) / bucket_ms))
    cond = ((f[key] == s["_k"]) & (f["_bucket"] == s["_bucket"])
            & (f[ts] >= s["_s"]) & (f[ts] < s["_e"]))
    return f.join(s, cond, "left").drop("_k", "_s", "_e", "_bucket")


def lookup_with_default(ids: DataFrame, current: DataFrame, key: str,
                        defaults: dict[str, Column]) -> DataFrame:
    """Left join that fills a default row for ids without a current value."""
    j = ids.join(current, key, "left")
    for c, d in defaults.items():
        j = j.withColumn(c, F.coalesce(F.col(c), d))
    return j
