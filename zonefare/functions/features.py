"""Model features, confidence, prediction clipping and the training label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig


def spike_factor(demand_1min: Column, hist_avg: Column) -> Column:
    return F.round(F.when(hist_avg > 0, demand_1min.cast("double") / hist_avg)
                   .otherwise(1.0), 3)


def supply_ratio_feature(drivers: Column, demand_1min: Column) -> Column:
    """drivers per request (the inverse of the surge row's demand/supply)."""
    return F.round(F.when(demand_1min > 0, drivers.cast("double") / demand_1min.cast("double"))
                   .otherwise(drivers.cast("double")), 3)


def event_multiplier_default(is_event: Column) -> Column:
    return F.when(is_event, 1.5).otherwise(1.0)


def clip_prediction(pred: Column, cfg: PricingConfig = DEFAULT) -> Column:
    return F.round(F.least(F.greatest(pred, F.lit(1.0)), F.lit(cfg.multiplier_max)), 2)


def confidence(demand_1min: Column, hist_avg: Column, pred: Column) -> Column:
    """1.0 scaled down for no demand (x0.5), default history (x0.8) and an
    extreme prediction (x0.7); rounded to 3 digits."""
    c = (F.lit(1.0)
         * F.when(F.coalesce(demand_1min, F.lit(0)) == 0, 0.5).otherwise(1.0)
         * F.when(F.coalesce(hist_avg, F.lit(20.0)) == 20.0, 0.8).otherwise(1.0)
         * F.when((pred > 2.5) | (pred < 1.0), 0.7).otherwise(1.0))
    return F.round(F.least(c, F.lit(1.0)), 3)


def label_multiplier(demand_1min: Column, drivers: Column, severity: Column,
                     rush: Column, event_mult: Column, holiday: Column,
                     cfg: PricingConfig = DEFAULT) -> Column:
    """Noise-free training label: strict thresholds on demand/(drivers+1)
    plus weather, rush, event and holiday boosts, clipped to [1, max]."""
    r = demand_1min.cast("double") / (drivers.cast("double") + 1.0)
    base = (F.when(r > 3, 2.0).when(r > 2, 1.5).when(r > 1.5, 1.2).otherwise(1.0))
    y = (base + (severity.cast("double") - 1.0) * 0.15
         + rush.cast("double") * 0.2
         + (event_mult - 1.0) * 0.3
         + holiday.cast("double") * 0.3)
    return F.least(F.greatest(y, F.lit(1.0)), F.lit(cfg.multiplier_max))
