"""Declared schemas (no inference anywhere)."""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("available_drivers", T.IntegerType()),
    T.StructField("weather_severity", T.IntegerType()),
    T.StructField("demand_count", T.IntegerType()),
])

REQUIRED_EVENT_KEYS = ("event_id", "zone_id", "city", "latitude", "longitude",
                       "timestamp_ms", "available_drivers")

DLQ_SCHEMA = T.StructType([
    T.StructField("original_event", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("failed_at_ms", T.LongType()),
])

WEATHER_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("current_weather", T.StructType([
        T.StructField("temperature", T.DoubleType()),
        T.StructField("windspeed", T.DoubleType()),
        T.StructField("weathercode", T.IntegerType()),
    ])),
    T.StructField("hourly", T.StructType([
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
    ])),
])

SURGE_HISTORY_SCHEMA = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("demand_1min", T.LongType()),
    T.StructField("demand_5min", T.LongType()),
    T.StructField("demand_15min", T.LongType()),
    T.StructField("available_drivers", T.IntegerType()),
    T.StructField("supply_ratio", T.DoubleType()),
    T.StructField("rule_multiplier", T.DoubleType()),
    T.StructField("ml_multiplier", T.DoubleType()),
    T.StructField("final_multiplier", T.DoubleType()),
    T.StructField("ml_confidence", T.DoubleType()),
    T.StructField("is_special_event", T.BooleanType()),
    T.StructField("weather_severity", T.IntegerType()),
])
