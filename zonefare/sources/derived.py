"""Further inputs of the pricing pipeline, derived from the driver tables.

The driver ships no raw ride payloads, weather feed, event calendar or
look-up requests, so each is a deterministic projection of `events`:

  ride_payloads   JSON text per ride; `error` events are corrupted by k mod 4
                  (zone_id key dropped / timestamp_ms dropped / latitude out
                  of range / not JSON) and `purchase` events with k mod 10 = 0
                  carry an explicit null zone_id
  weather_obs     one observation per `error` event, city of its zone:
                  WMO code k, temperature value/10 - 5 (absent when
                  k mod 7 = 0), wind k/4, hourly precipitation
                  ((k + h) mod 10)/10 for h < 12 + k mod 13
  event_calendar  one special event per `signup` event in its zone: starts at
                  the event, lasts 60 + (180 k) div 99 minutes, multiplier
                  2 + k/50
  price_requests  one look-up per `view` event: its zone when k is even, else
                  the cell 0.05 degree north of it (mostly unknown zones)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig
from zonefare.functions.geo import with_geohash
from zonefare.schemas import EVENT_SCHEMA
from zonefare.sources.rides import rides


def payload_text(r: DataFrame) -> DataFrame:
    """JSON payload per ride row (needs columns k and event_type too)."""
    k, et = F.col("k"), F.col("event_type")
    err = et == "error"
    fields = []
    for f in EVENT_SCHEMA.fields:
        c = F.col(f.name)
        if f.name == "zone_id":
            c = F.when(err & (k % 4 == 0), F.lit(None)).when((et == "purchase") & (k % 10 == 0),
                                                             F.lit(None)).otherwise(c)
        elif f.name == "timestamp_ms":
            c = F.when(err & (k % 4 == 1), F.lit(None)).otherwise(c)
        elif f.name == "latitude":
            c = F.when(err & (k % 4 == 2), c + 100.0).otherwise(c)
        fields.append(c.cast(f.dataType).alias(f.name))
    body = F.struct(*fields)
    text = (F.when((et == "purchase") & (k % 10 == 0),
                   F.to_json(body, {"ignoreNullFields": "false"}))
            .otherwise(F.to_json(body)))
    text = F.when(err & (k % 4 == 3), F.concat(F.lit("#"), text)).otherwise(text)
    return r.select("event_id", "timestamp_ms", "zone_id", text.alias("value"))


def ride_payloads(spark: SparkSession, sf_dir: str, cfg: PricingConfig = DEFAULT) -> DataFrame:
    return payload_text(rides(spark, sf_dir, cfg, extra=("k", "event_type")))


def weather_obs(spark: SparkSession, sf_dir: str, cfg: PricingConfig = DEFAULT) -> DataFrame:
    return weather_columns(rides(spark, sf_dir, cfg, extra=("k", "event_type", "value")))


def weather_columns(r: DataFrame) -> DataFrame:
    """The observations that ride rows (with k, event_type and value) stand for."""
    r = r.filter(F.col("event_type") == "error")
    k = F.col("k")
    hours = F.sequence(F.lit(0), F.lit(11) + k % 13)
    precip = F.transform(hours, lambda h: ((k + h) % 10).cast("double") / 10.0)
    return r.select(
        F.col("event_id").alias("obs_id"), "city", F.col("timestamp_ms").alias("updated_at_ms"),
        F.col("event_time").alias("updated_at"),
        F.when(k % 7 != 0, F.col("value") / 10.0 - 5.0).alias("temperature"),
        (k.cast("double") / 4.0).alias("windspeed"), k.alias("weathercode"),
        precip.alias("precipitation"))


def event_calendar(spark: SparkSession, sf_dir: str, cfg: PricingConfig = DEFAULT) -> DataFrame:
    r = rides(spark, sf_dir, cfg, extra=("k", "event_type")).filter(F.col("event_type") == "signup")
    k = F.col("k")
    minutes = F.lit(60) + F.floor(k * 180 / 99).cast("int")
    return r.select("event_id", "zone_id", "city", F.col("timestamp_ms").alias("start_ms"),
                    (F.col("timestamp_ms") + minutes.cast("long") * 60_000).alias("end_ms"),
                    (F.lit(2.0) + k.cast("double") / 50.0).alias("multiplier"))


def price_requests(spark: SparkSession, sf_dir: str, cfg: PricingConfig = DEFAULT) -> DataFrame:
    r = rides(spark, sf_dir, cfg, extra=("k", "event_type")).filter(F.col("event_type") == "view")
    r = with_geohash(r.withColumn("_north", F.col("latitude") + 0.05), "_north", "longitude", "_shifted")
    return r.select(F.col("event_id").alias("request_id"),
                    F.when(F.col("k") % 2 == 0, F.col("zone_id")).otherwise(F.col("_shifted")).alias("zone_id"))
