"""Prefix scans over tables of any size and any skew.

A window over one key puts all rows of that key into one task.  Here rows are
range-partitioned by (keys, order) into blocks of bounded size, so a key that
holds most rows is spread over many blocks.  A block is scanned on its own; what
a row needs from earlier blocks is folded into one row per (block, key), and those
summaries - at most one per block and key - are scanned instead of the rows.

`in_blocks` is nondeterministic in its block numbers, so its result must be
written before it is used (`store` below): a lost executor then re-reads blocks
instead of numbering them anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, AT = "__block", "__at"


def checkpointed(df: DataFrame) -> DataFrame:
    """Default store: a reliable checkpoint in the session's shared folder."""
    from zonefare.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def blocks_for(df: DataFrame, rows_per_block: int) -> int:
    """Blocks of about `rows_per_block` rows: one counting pass."""
    return max(1, -(-df.count() // rows_per_block))


def in_blocks(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Rows sorted by `order` over range partitions, with block number and position (`__block`, `__at`)."""
    ranged = df.repartitionByRange(blocks, *order) if blocks else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias(BLOCK), F.monotonically_increasing_id().alias(AT))


def running_sums(stored: DataFrame, sums: dict[str, str], keys: Sequence[str] = (), inclusive: bool = False) -> DataFrame:
    """Running sums over a stored `in_blocks` table: {new column: summed column}, per key, in block order.

    Exclusive sums count the rows before a row only.  Keys must not be null.
    """
    local = (Window.partitionBy(BLOCK, *keys).orderBy(AT)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    per_block = stored.groupBy(BLOCK, *keys).agg(*[F.sum(c).alias(f"__s_{o}") for o, c in sums.items()])
    # one row per block and key: the window below never sees rows of the table itself
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    earlier = earlier.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.select(BLOCK, *keys, *[F.coalesce(F.sum(f"__s_{o}").over(earlier), F.lit(0)).alias(f"__c_{o}")
                                             for o in sums])
    inside = stored.withColumns({o: F.coalesce(F.sum(c).over(local), F.lit(0)) for o, c in sums.items()})
    if not keys:  # as many rows as blocks
        carry = F.broadcast(carry)
    joined = inside.join(carry, [BLOCK, *keys])
    return joined.withColumns({o: F.col(o) + F.col(f"__c_{o}") for o in sums}).drop(*[f"__c_{o}" for o in sums])


def last_known(stored: DataFrame, values: dict[str, Column], keys: Sequence[str], inclusive: bool = True) -> DataFrame:
    """For every row the newest non-null value at or before it (per key, in block order): {new column: value}."""
    local = (Window.partitionBy(BLOCK, *keys).orderBy(AT)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    named = stored.withColumns({f"__v_{o}": v for o, v in values.items()})
    newest = [F.max_by(f"__v_{o}", F.when(F.col(f"__v_{o}").isNotNull(), F.col(AT))).alias(f"__s_{o}") for o in values]
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = named.groupBy(BLOCK, *keys).agg(*newest).select(
        BLOCK, *keys, *[F.last(f"__s_{o}", ignorenulls=True).over(earlier).alias(f"__c_{o}") for o in values])
    inside = named.withColumns({o: F.last(f"__v_{o}", ignorenulls=True).over(local) for o in values})
    return (inside.join(carry, [BLOCK, *keys])
            .withColumns({o: F.coalesce(F.col(o), F.col(f"__c_{o}")) for o in values})
            .drop(*[f"__v_{o}" for o in values], *[f"__c_{o}" for o in values]))


def with_rank(df: DataFrame, order: Sequence[str], name: str = "rank",
              store: Callable[[DataFrame], DataFrame] = checkpointed) -> DataFrame:
    """Global row numbers from 0 in `order`, without a window over the whole table."""
    stored = store(in_blocks(df, order).withColumn("__one", F.lit(1).cast("long")))
    return running_sums(stored, {name: "__one"}).drop(BLOCK, AT, "__one")
