"""One active interval per key at a time, chosen greedily in start order,
computed as Spark joins (the batch form of the keyed event state).

Greedy rule: take intervals in (start, tie) order; an interval is accepted
when it starts at or after the end of the last accepted one.  The accepted
intervals of a key are therefore the chain f, next(f), next(next(f)), ...
where f is the key's first interval and next(i) is the first interval
starting at or after end(i).

1. next(i) by a forward as-of per (key, day of the end) with the next day's
   starts as context; the few intervals with no start in that reach are answered per
   (key, day) from the per-day first starts, so no task holds a whole key.
2. The chain by pointer doubling: after round k the accepted set holds the
   first 2^k chain members and the jump table maps i to next^(2^k)(i).
   Rounds are about log2 of the longest chain (at most the span divided by
   the shortest interval); each round's tables are checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonefare.session import checkpoint_dir


def next_interval(cal: DataFrame, key: str, start: str, end: str, tie: str,
                  bucket_ms: int = 86_400_000) -> DataFrame:
    """(key, tie, next_tie): the first interval (start, tie order) whose start
    (an unknown one never) is at or after this interval's end; null when there is none.  The search
    starts in the bucket of the end, so intervals may have any length."""
    c = cal.select(F.col(key).alias("_k"), F.col(start).alias("_s"), F.col(end).alias("_e"),
                   F.col(tie).alias("_id")).withColumn("_b", F.floor(F.col("_s") / bucket_ms))
    cand = F.struct(F.col("_s").alias("s"), F.col("_id").alias("id"))
    own = c.filter("_s IS NOT NULL").select("_k", "_b", F.col("_s").alias("_t"), F.lit(1).alias("_kind"), cand.alias("_c"),
                   F.lit(None).cast("string").alias("_q"))
    ctx = own.withColumn("_b", F.col("_b") - 1)
    qry = c.filter("_e IS NOT NULL").select("_k", F.floor(F.col("_e") / bucket_ms).alias("_b"), F.col("_e").alias("_t"), F.lit(0).alias("_kind"),
                   F.lit(None).cast(own.schema["_c"].dataType).alias("_c"),
                   F.col("_id").cast("string").alias("_q"))
    # backwards in time: a frame that starts at the partition's first row is carried on from row to row, one that
    # ends at its last row would be read anew for every row
    w = (Window.partitionBy("_k", "_b").orderBy(F.desc("_t"), F.desc("_kind"), F.desc("_c.id"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    a = (qry.unionByName(own).unionByName(ctx)
         .withColumn("_n", F.last("_c", ignorenulls=True).over(w))
         .filter(F.col("_kind") == 0)
         .select("_k", "_b", F.col("_q").alias("_id"), F.col("_n.id").alias("_nid")))
    # not found in the end's bucket and the next one: the first start from two buckets on
    firsts = c.filter("_s IS NOT NULL").groupBy("_k", "_b").agg(F.min(cand).alias("_f"))
    need = a.filter(F.col("_nid").isNull()).select("_k", (F.col("_b") + 2).alias("_pos")).distinct()
    wf = (Window.partitionBy("_k").orderBy(F.desc("_pos"), F.desc("_kind"))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    far = (need.select("_k", "_pos", F.lit(0).alias("_kind"), F.lit(None).cast(firsts.schema["_f"].dataType).alias("_f"))
           .unionByName(firsts.select("_k", F.col("_b").alias("_pos"), F.lit(1).alias("_kind"), "_f"))
           .withColumn("_n", F.last("_f", ignorenulls=True).over(wf))
           .filter(F.col("_kind") == 0)
           .select("_k", (F.col("_pos") - 2).alias("_b"), F.col("_n.id").alias("_far")))
    out = a.join(far, ["_k", "_b"], "left").select(
        F.col("_k").alias(key), F.col("_id").alias(tie),
        F.coalesce(F.col("_nid"), F.col("_far")).alias("next_" + tie))
    return out


def greedy_chain(cal: DataFrame, key: str = "zone_id", start: str = "start_ms", end: str = "end_ms",
                 tie: str = "event_id", bucket_ms: int = 86_400_000, max_rounds: int = 64) -> DataFrame:
    """The accepted intervals (all columns of `cal`), one active per key."""
    spark = cal.sparkSession
    checkpoint_dir(spark)
    cal = cal.withColumn(tie, F.col(tie).cast("string"))
    jump = (next_interval(cal, key, start, end, tie, bucket_ms)
            .select(F.col(tie).alias("_id"), F.col("next_" + tie).alias("_to"))
            .filter(F.col("_to").isNotNull()).distinct().checkpoint())  # a row that comes twice would square in each round
    roots = cal.groupBy(key).agg(F.min(F.struct(F.col(start).isNull().alias("_no"), F.col(start), F.col(tie))).alias("_f"))
    accepted = roots.select(F.col("_f." + tie).alias("_id")).checkpoint()
    for _ in range(max_rounds):
        # accepted = first 2^k chain members, jump = next^(2^k): the next
        # 2^k members are the jumps from the ones found so far
        new = accepted.join(jump, "_id").select(F.col("_to").alias("_id")).checkpoint()
        if new.isEmpty():
            break
        accepted = accepted.unionByName(new).checkpoint()
        jump = (jump.alias("a").join(jump.alias("b"), F.col("a._to") == F.col("b._id"))
                .select(F.col("a._id").alias("_id"), F.col("b._to").alias("_to")).checkpoint())
    else:
        raise RuntimeError("chain longer than 2^max_rounds")
    return cal.join(accepted.withColumnRenamed("_id", tie), tie, "left_semi")
