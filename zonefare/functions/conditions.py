"""Weather, supply and holiday multipliers and the expected demand/supply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonefare.config import (DEFAULT, SUPPLY_NIGHT_HOURS, SUPPLY_RUSH_HOURS,
                             SUPPLY_WEEKEND_NIGHT_HOURS, WEATHER_DEMAND, WMO_SEVERITY,
                             PricingConfig)


def wmo_severity(code: Column) -> Column:
    """WMO weather code -> severity 1 (clear) .. 5 (storm); unknown codes 1."""
    out = None
    for sev, codes in WMO_SEVERITY.items():
        out = F.when(code.isin(*codes), sev) if out is None else out.when(code.isin(*codes), sev)
    return out.otherwise(1)


def weather_demand_multiplier(severity: Column) -> Column:
    out = None
    for sev, m in WEATHER_DEMAND.items():
        out = F.when(severity == sev, m) if out is None else out.when(severity == sev, m)
    return out.otherwise(1.0)


def supply_factor(severity: Column, hour: Column, dow: Column,
                  cfg: PricingConfig = DEFAULT) -> Column:
    weather = (F.when(severity == 3, cfg.rain_factor)
               .when(severity == 4, cfg.heavy_rain_factor)
               .when(severity == 5, cfg.snow_factor).otherwise(1.0))
    tod = (F.when(hour.isin(*SUPPLY_NIGHT_HOURS), cfg.late_night_factor)
           .when(hour.isin(*SUPPLY_RUSH_HOURS) & (dow < 5), cfg.rush_hour_factor)
           .otherwise(1.0))
    weekend_night = F.when((dow >= 5) & hour.isin(*SUPPLY_WEEKEND_NIGHT_HOURS),
                           cfg.weekend_night_factor).otherwise(1.0)
    return F.greatest(F.lit(1.0) * weather * tod * weekend_night, F.lit(0.1))


def holiday_multiplier(is_holiday: Column, is_eve: Column,
                       cfg: PricingConfig = DEFAULT) -> Column:
    return (F.when(is_holiday, cfg.holiday_multiplier)
            .when(is_eve, cfg.holiday_eve_multiplier).otherwise(1.0))


def expected_demand(base_demand: Column, num_zones: Column, time_m: Column,
                    weather_m: Column, event_m: Column, holiday_m: Column) -> Column:
    """Noise-free zone demand: max(1, int(base/zones * all multipliers))."""
    raw = (base_demand.cast("double") / num_zones.cast("double")
           * time_m * weather_m * event_m * holiday_m)
    return F.greatest(F.lit(1), raw.cast("int"))


def expected_supply(factor: Column, cfg: PricingConfig = DEFAULT) -> Column:
    return F.greatest(F.lit(1), (F.lit(float(cfg.base_drivers_per_zone)) * factor).cast("int"))


def hourly_value(arr: Column, hour: Column, default: float = 0.0) -> Column:
    """arr[hour] (0-based) when in bounds, else `default`."""
    return F.coalesce(F.get(arr, hour), F.lit(default))


def map_get(m: Column, key, default) -> Column:
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))
