"""Event validation, the dead-letter split and response-range checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonefare.schemas import EVENT_SCHEMA, REQUIRED_EVENT_KEYS


def missing_key_reason(raw: Column, required=REQUIRED_EVENT_KEYS) -> Column:
    """Key-presence validation on raw JSON text (a key with a null value
    passes, as in the producer): 'unparsable', 'missing_<key>' for the first
    absent key, or null when all keys are present."""
    keys = F.json_object_keys(raw)
    reason = F.when(keys.isNull(), F.lit("unparsable"))
    for k in required:
        reason = reason.when(~F.array_contains(keys, k), F.lit(f"missing_{k}"))
    return reason


def value_reason(ev: Column) -> Column:
    """Strict checks on the decoded struct (null key, coordinates)."""
    return (F.when(ev["zone_id"].isNull(), F.lit("null_zone_id"))
            .when(~ev["latitude"].between(-90.0, 90.0)
                  | ~ev["longitude"].between(-180.0, 180.0), F.lit("coordinates_out_of_range")))


def validate_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode JSON payloads (PERMISSIVE: bad text gives a null struct) and
    tag each row with `failure_reason` (null = valid)."""
    v = F.col(value_col).cast("string")
    ev = F.from_json(v, EVENT_SCHEMA)
    return (raw.withColumn("event", ev)
            .withColumn("failure_reason", F.coalesce(missing_key_reason(v), value_reason(F.col("event")))))


def dead_letters(validated: DataFrame, failed_at_ms: Column, value_col: str = "value") -> DataFrame:
    """Invalid rows wrapped as {original_event, failure_reason, failed_at_ms}."""
    bad = validated.filter(F.col("failure_reason").isNotNull())
    return bad.select(
        "*", failed_at_ms.alias("failed_at_ms"),
        F.to_json(F.struct(F.col(value_col).alias("original_event"),
                           F.col("failure_reason"), failed_at_ms.alias("failed_at_ms"))
                  ).alias("dlq_value"))


def range_violations(prices: DataFrame) -> DataFrame:
    """Counts of rows breaking the response constraints (multipliers >= 1,
    0 <= confidence <= 1)."""
    checks = {
        "final_below_1": F.col("final_multiplier") < 1.0,
        "rule_below_1": F.col("rule_multiplier") < 1.0,
        "ml_below_1": F.col("ml_multiplier") < 1.0,
        "confidence_out_of_range": ~F.col("ml_confidence").between(0.0, 1.0),
    }
    return prices.agg(F.count(F.lit(1)).alias("rows_checked"),
                      *[F.count_if(c).alias(n) for n, c in checks.items()])
