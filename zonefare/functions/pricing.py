"""Pricing rules as Column expressions.

Conditions are tested before any division, so ANSI mode never sees a zero
divisor, and the config values enter as literals Catalyst can fold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def rule_multiplier(demand, supply, cfg: PricingConfig = DEFAULT) -> Column:
    """Rule price: no supply -> max; else by demand/supply against thresholds."""
    d, s = _c(demand).cast("double"), _c(supply).cast("double")
    ratio = F.when(s > 0, d / s)
    m = (F.when(s <= 0, F.lit(cfg.multiplier_max))
         .when(ratio >= cfg.threshold_high, F.lit(cfg.multiplier_high))
         .when(ratio >= cfg.threshold_medium, F.lit(cfg.multiplier_medium))
         .when(ratio >= cfg.threshold_low, F.lit(cfg.multiplier_low))
         .otherwise(F.lit(1.0)))
    return F.least(m, F.lit(cfg.multiplier_max))


def final_multiplier(rule, ml, confidence, cfg: PricingConfig = DEFAULT) -> Column:
    """ML is trusted (as a floor-raising max) only at confidence >= threshold."""
    r, m, c = _c(rule), _c(ml), _c(confidence)
    blended = F.when(c >= cfg.confidence_threshold, F.greatest(r, m)).otherwise(r)
    return F.least(blended, F.lit(cfg.multiplier_max))


def surge_tier(multiplier, cfg: PricingConfig = DEFAULT) -> Column:
    m = _c(multiplier)
    return (F.when(m >= cfg.multiplier_max, "maximum")
            .when(m >= cfg.multiplier_high, "high")
            .when(m >= cfg.multiplier_medium, "medium")
            .when(m > 1.0, "low")
            .otherwise("normal"))


def clamp_drivers(drivers) -> Column:
    """Null, zero and negative driver counts all become 1."""
    return F.greatest(F.coalesce(_c(drivers), F.lit(1)), F.lit(1))


def demand_supply_ratio(demand, drivers) -> Column:
    """demand / drivers for an already clamped (>= 1) driver count."""
    return _c(demand).cast("double") / _c(drivers).cast("double")
