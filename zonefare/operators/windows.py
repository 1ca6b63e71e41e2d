"""Demand over sliding event-time windows and trailing per-event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonefare.operators.scan import AT, BLOCK, blocks_for, checkpointed, in_blocks, last_known, running_sums


def sliding_demand(rides: DataFrame, duration_s: int, slide_s: int = 10,
                   keys=("zone_id", "city"), span_s: int = 86_400) -> DataFrame:
    """Requests per (window of `duration_s` sliding by `slide_s`, zone), for
    every window holding at least one request.

    Without fanning events out to all the windows that contain them:

    1. events are counted per slide-sized bucket (map-side partial
       aggregation collapses dense zones before the shuffle);
    2. buckets are sorted per (zone, span of one day); the last and first
       n-1 buckets of the neighbouring spans are copied in as context, so a
       hot zone is split by day and nothing near a span edge is missed;
    3. each bucket owns the window starts that no earlier bucket reaches,
       (previous bucket, this bucket], and sums the counts in its look-ahead
       array (the buckets in [start, start + n - 1], at most n = duration /
       slide entries) for each of them.

    Output rows = windows, each produced once, so there is no second
    aggregation; work per bucket is bounded by n.
    """
    b = (rides.groupBy(*keys, F.floor(F.col("timestamp_ms") / (slide_s * 1000)).alias("bucket"))
         .agg(F.count("event_id").alias("n")))
    return windows_of_buckets(b, duration_s, slide_s, keys, span_s)


def windows_of_buckets(b: DataFrame, duration_s: int, slide_s: int = 10, keys=("zone_id", "city"),
                       span_s: int = 86_400) -> DataFrame:
    """Steps 2 and 3 of `sliding_demand` over counted buckets (keys, bucket number, n)."""
    if duration_s % slide_s:
        raise ValueError("duration must be a multiple of the slide")
    n = duration_s // slide_s
    slide_ms = slide_s * 1000
    per_span = max(n, span_s // slide_s)
    home = F.floor(F.col("bucket") / per_span)
    pos = F.col("bucket") - home * per_span
    # one pass: a bucket goes to its span, and as context to a neighbouring one that its edge reaches
    spans = F.array_compact(F.array(home, F.when(pos >= per_span - (n - 1), home + 1), F.when(pos < n - 1, home - 1)))
    u = b.withColumn("_span", F.explode(spans)).withColumn("_own", F.col("_span") == home)
    w = Window.partitionBy(*keys, "_span").orderBy("bucket")
    u = (u.withColumn("_prev", F.lag("bucket").over(w))
         .withColumn("_ahead", F.collect_list(F.struct("bucket", "n")).over(w.rangeBetween(0, n - 1)))
         .filter(F.col("_own")))
    lo = F.greatest(F.coalesce(F.col("_prev") + 1, F.col("bucket") - (n - 1)), F.col("bucket") - (n - 1))
    u = u.withColumn("_start", F.explode(F.sequence(lo, F.col("bucket"))))
    demand = F.aggregate(F.filter("_ahead", lambda x: x["bucket"] <= F.col("_start") + (n - 1)),
                         F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    start_ms = F.col("_start") * slide_ms
    return u.select(F.timestamp_millis(start_ms).alias("window_start"),
                    F.timestamp_millis(start_ms + duration_s * 1000).alias("window_end"),
                    *keys, demand.alias("demand"))


def trailing_counts(rides: DataFrame, windows_s=(60, 300, 900), key: str = "zone_id",
                    bucket_s: int = 3600) -> DataFrame:
    """Per event: events of the same key in the trailing w seconds (inclusive
    of equal timestamps), for each w in `windows_s`.

    Partitioning only by key would sort a whole zone in one task, so the
    window is partitioned by (key, time bucket).  Every event is also copied,
    as context, into each later bucket that its timestamp can still reach
    within the largest window, so each bucket sees everything its own events
    count; copies are dropped after the window.  With buckets longer than
    the largest window that is at most one copy per event.
    """
    wmax_ms = max(windows_s) * 1000
    b_ms = bucket_s * 1000
    base = rides.withColumn("_bucket", F.floor(F.col("timestamp_ms") / b_ms))
    own = base.withColumn("_ctx", F.lit(False))
    last = F.floor((F.col("timestamp_ms") + (wmax_ms - 1)) / b_ms)
    ctx = (base.filter(last > F.col("_bucket"))
           .withColumn("_bucket", F.explode(F.sequence(F.col("_bucket") + 1, last)))
           .withColumn("_ctx", F.lit(True)))
    both = own.unionByName(ctx)
    w = Window.partitionBy(key, "_bucket").orderBy("timestamp_ms")
    for s in windows_s:
        both = both.withColumn(f"demand_{s}",
                               F.count("event_id").over(w.rangeBetween(-s * 1000 + 1, 0)))
    return both.filter(~F.col("_ctx")).drop("_bucket", "_ctx")


def trailing_counts_scan(rides: DataFrame, windows_s=(60, 300, 900), key: str = "zone_id",
                         rows_per_block: int = 100_000) -> DataFrame:
    """`trailing_counts` for any skew, from prefix sums instead of a window per (key, hour).

    Events are counted per (key, millisecond) and summed up along the time of a key
    by a blocked scan.  The events in (t - w, t] are the sum at t less the sum at the
    newest millisecond at or before t - w, found by a second blocked scan over the
    sums and the points t - w.  No event is copied into a window.
    """
    per_ms = rides.groupBy(key, "timestamp_ms").agg(F.count("event_id").alias("__n"))
    sums = checkpointed(in_blocks(per_ms, [key, "timestamp_ms"], blocks_for(per_ms, rows_per_block)))
    upto = checkpointed(running_sums(sums, {"__upto": "__n"}, [key], inclusive=True).drop(BLOCK, AT, "__n"))
    null_long = F.lit(None).cast("long")
    known = upto.select(key, F.col("timestamp_ms").alias("__t"), F.lit(0).alias("__w"), null_long.alias("__for"), "__upto")
    asked = upto.select(key, F.explode(F.array(*[F.lit(w) for w in windows_s])).alias("__w"), "timestamp_ms").select(
        key, (F.col("timestamp_ms") - F.col("__w") * 1000).alias("__t"), "__w", F.col("timestamp_ms").alias("__for"),
        null_long.alias("__upto"))
    both = known.unionByName(asked)
    points = checkpointed(in_blocks(both, [key, "__t", "__w"], blocks_for(both, rows_per_block)))
    before = last_known(points, {"__before": F.col("__upto")}, [key]).filter(F.col("__w") > 0)
    wide = before.groupBy(key, F.col("__for").alias("timestamp_ms")).agg(
        *[F.max(F.when(F.col("__w") == w, F.coalesce("__before", F.lit(0)))).alias(f"__b{w}") for w in windows_s])
    counts = upto.join(wide, [key, "timestamp_ms"]).select(
        key, "timestamp_ms", *[(F.col("__upto") - F.col(f"__b{w}")).alias(f"demand_{w}") for w in windows_s])
    return rides.join(counts, [key, "timestamp_ms"])
