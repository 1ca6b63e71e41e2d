"""The ride-request event view over the driver's `events` table.

The pricing pipeline consumes ride requests (zone, city, position, time,
drivers on hand, weather severity).  The driver ships a generic `events`
table instead, so one deterministic projection turns each event into a ride
request; every query, Spark and SQL oracle alike, starts from this view.

  k                 integer field "k" of the JSON `props`   (0..99)
  zone_idx          (user_id + k) mod num_zones              (0..49)
  zone_id, city,    the zone dimension row of zone_idx
  latitude, longitude
  timestamp_ms      epoch milliseconds of ts
  available_drivers k mod 8
  weather_severity  1 + (k div 8) mod 5
  demand_count      floor(value)

The zone dimension has one row per configured zone (50 by default), a size
fixed by the configuration and independent of the data, so it is always
broadcast: the join never shuffles the fact side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig
from zonefare.functions.geo import with_geohash, zone_grid_columns
from zonefare.sources.tables import read_table

RIDE_COLUMNS = (
    "event_id", "zone_idx", "zone_id", "city", "latitude", "longitude",
    "timestamp_ms", "event_time", "available_drivers", "weather_severity",
    "demand_count",
)


def props_k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


_ZONE_DIMS: dict = {}


def zone_dim(spark: SparkSession, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """All configured zones: zone_idx, zone_id (geohash-6), city, grid, centre.

    One row per configured zone, a size fixed by the configuration.  It is
    computed by Spark once per session and kept as a local relation: every
    query broadcasts it, and its geohash expressions stay out of each query's
    analysis and code generation.
    """
    key = (spark.sparkContext.applicationId, cfg.cities)
    if key not in _ZONE_DIMS:
        z = spark.range(cfg.num_zones).select(F.col("id").cast("int").alias("zone_idx"))
        cols = zone_grid_columns(F.col("zone_idx"), cfg)
        z = z.select("zone_idx", *[c.alias(n) for n, c in cols.items()])
        z = with_geohash(z, "latitude", "longitude", "zone_id")
        _ZONE_DIMS[key] = spark.createDataFrame(z.orderBy("zone_idx").collect(), z.schema)
    return _ZONE_DIMS[key]


def ride_columns(events: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Project raw event columns to ride-request columns (no dimension yet)."""
    k = props_k(F.col("props"))
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.pmod(F.col("user_id") + k, F.lit(cfg.num_zones)).cast("int").alias("zone_idx"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.pmod(k, F.lit(8)).cast("int").alias("available_drivers"),
        (F.lit(1) + F.pmod(F.floor(k / 8), F.lit(5))).cast("int").alias("weather_severity"),
        F.floor(F.col("value")).cast("int").alias("demand_count"),
        k.alias("k"),
        F.col("event_type"),
        F.col("value"),
    )


def rides(spark: SparkSession, sf_dir: str, cfg: PricingConfig = DEFAULT,
          extra: tuple = ()) -> DataFrame:
    """Ride-request events: RIDE_COLUMNS (+ `extra` of k, event_type)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id",
                    "event_type", "value", "props")
    r = ride_columns(ev, cfg)
    dim = zone_dim(spark, cfg).select("zone_idx", "zone_id", "city", "latitude", "longitude")
    r = r.join(F.broadcast(dim), "zone_idx")
    return r.select(*RIDE_COLUMNS, *extra)
