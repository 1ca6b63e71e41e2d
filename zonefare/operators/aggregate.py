"""Zone aggregates: demand/supply per batch, fleet summaries, baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, TIERS, PricingConfig
from zonefare.functions.pricing import (clamp_drivers, demand_supply_ratio,
                                        rule_multiplier, surge_tier)


def zone_demand_supply(rides: DataFrame, *batch_keys: Column | str) -> DataFrame:
    """Per (batch keys, zone_id, city): request count and truncated means.

    count(event_id) skips null ids; the means are cast to int, which
    truncates.  Partial aggregation collapses each task's rows to one row per
    key before the shuffle, so a zone holding a third of the events costs no
    more shuffle than any other.
    """
    return (rides.groupBy(*batch_keys, "zone_id", "city")
            .agg(F.count("event_id").alias("demand_1min"),
                 F.avg("available_drivers").cast("int").alias("available_drivers"),
                 F.avg("weather_severity").cast("int").alias("weather_severity")))


def surge_rows(agg: DataFrame, cfg: PricingConfig = DEFAULT,
               extrapolate: bool = True) -> DataFrame:
    """Price aggregated zones: the per-batch surge row (rule price only).

    With `extrapolate` the 5- and 15-minute demands are the batch count times
    5 and 15, the stateless approximation; true windows are in
    operators.windows.  One projection, so the plan gains a single Project.
    """
    demand = F.coalesce(F.col("demand_1min"), F.lit(0)).cast("long")
    drivers = clamp_drivers(F.col("available_drivers"))
    rule = rule_multiplier(demand, drivers, cfg)
    keep = [c for c in agg.columns if c not in ("demand_1min", "available_drivers", "weather_severity")]
    cols = [*keep, demand.alias("demand_1min")]
    if extrapolate:
        cols += [(demand * 5).alias("demand_5min"), (demand * 15).alias("demand_15min")]
    cols += [drivers.cast("int").alias("available_drivers"),
             F.coalesce(F.col("weather_severity"), F.lit(0)).cast("int").alias("weather_severity"),
             demand_supply_ratio(demand, drivers).alias("supply_ratio"),
             rule.alias("rule_multiplier"), rule.alias("ml_multiplier"), rule.alias("final_multiplier"),
             F.lit(0.0).alias("ml_confidence"), F.lit(False).alias("is_special_event"),
             surge_tier(rule, cfg).alias("surge_tier")]
    return agg.select(*cols)


def fleet_summary(current: DataFrame, *by: str) -> DataFrame:
    """Zone count, surging count, mean and max final multiplier.

    With no grouping an empty input still yields one row (0, 0, 1.0, 1.0).
    """
    m = F.col("final_multiplier")
    aggs = [F.count(F.lit(1)).alias("total_zones"),
            F.count_if(F.round(m, 2) > 1.0).alias("surging_zones"),
            F.round(F.coalesce(F.avg(m), F.lit(1.0)), 6).alias("avg_multiplier"),
            F.coalesce(F.max(m), F.lit(1.0)).alias("max_multiplier")]
    return current.groupBy(*by).agg(*aggs)


def tier_distribution(current: DataFrame, spark, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Zones per tier over the five fixed tiers, zero-filled.

    Counts are aggregated first (at most one row per tier), then broadcast
    into the five-row tier dimension, which is the preserved side.
    """
    from zonefare.config import TIER_COLOURS
    tiers = spark.createDataFrame(
        [(i, t, TIER_COLOURS[t]) for i, t in enumerate(TIERS)],
        "tier_rank int, surge_tier string, colour string")
    counts = (current.select(surge_tier(F.col("final_multiplier"), cfg).alias("surge_tier"))
              .groupBy("surge_tier").agg(F.count(F.lit(1)).alias("zone_count")))
    return (tiers.join(F.broadcast(counts), "surge_tier", "left")
            .select("tier_rank", "surge_tier", "colour",
                    F.coalesce(F.col("zone_count"), F.lit(0)).alias("zone_count")))


def nonzero_mean(x: Column, default: float) -> Column:
    """Mean over non-null, non-zero values, `default` when there is none."""
    return F.coalesce(F.avg(F.when(x != 0, x)), F.lit(default))
