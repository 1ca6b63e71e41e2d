"""The pricing rules as temporary SQL functions, for `spark.sql` users.

They are SQL-bodied functions (CREATE TEMPORARY FUNCTION ... RETURN expr):
Catalyst inlines them, so they run in generated code like the Column
functions they mirror.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from zonefare.config import DEFAULT, WEATHER_DEMAND, WMO_SEVERITY, PricingConfig


def register_sql_functions(spark: SparkSession, cfg: PricingConfig = DEFAULT) -> list[str]:
    c = cfg
    wmo = " ".join(f"WHEN code IN ({', '.join(map(str, v))}) THEN {k}" for k, v in WMO_SEVERITY.items())
    wd = " ".join(f"WHEN severity = {k} THEN {float(v)}D" for k, v in WEATHER_DEMAND.items())
    defs = {
        "surge_rule_multiplier": (
            "demand DOUBLE, supply DOUBLE", "DOUBLE",
            f"least(CASE WHEN supply <= 0 THEN {c.multiplier_max}D "
            f"WHEN demand / supply >= {c.threshold_high}D THEN {c.multiplier_high}D "
            f"WHEN demand / supply >= {c.threshold_medium}D THEN {c.multiplier_medium}D "
            f"WHEN demand / supply >= {c.threshold_low}D THEN {c.multiplier_low}D ELSE 1.0D END, "
            f"{c.multiplier_max}D)"),
        "surge_final_multiplier": (
            "rule DOUBLE, ml DOUBLE, confidence DOUBLE", "DOUBLE",
            f"least(CASE WHEN confidence >= {c.confidence_threshold}D THEN greatest(rule, ml) "
            f"ELSE rule END, {c.multiplier_max}D)"),
        "surge_tier": (
            "m DOUBLE", "STRING",
            f"CASE WHEN m >= {c.multiplier_max}D THEN 'maximum' WHEN m >= {c.multiplier_high}D THEN 'high' "
            f"WHEN m >= {c.multiplier_medium}D THEN 'medium' WHEN m > 1.0D THEN 'low' ELSE 'normal' END"),
        "wmo_severity": ("code INT", "INT", f"CASE {wmo} ELSE 1 END"),
        "weather_demand_multiplier": ("severity INT", "DOUBLE", f"CASE {wd} ELSE 1.0D END"),
    }
    for name, (args, ret, body) in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(defs)
