"""Stream sources: Kafka (production) and a file-source twin (tests, replay).

Both end in the same ride-request columns, so every downstream transform is
shared with the batch queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig
from zonefare.schemas import EVENT_SCHEMA
from zonefare.session import pin_utc
from zonefare.sources.rides import RIDE_COLUMNS, ride_columns, zone_dim


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 cfg: PricingConfig = DEFAULT, starting_offsets: str = "latest") -> DataFrame:
    """Raw Kafka records (key, value, timestamp...) of one topic, rate-capped.

    Needs the spark-sql-kafka package on the classpath.
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
            .option("failOnDataLoss", "false")
            .load())


def decode_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON value -> event columns; rows without a zone are dropped.

    PERMISSIVE parsing: unparsable text gives an all-null row (then dropped
    by the zone filter), a badly typed field gives a null in that field.
    """
    d = raw.select(F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA).alias("d"))
    return (d.select("d.*").filter(F.col("zone_id").isNotNull())
            .withColumn("event_time", F.timestamp_millis(F.col("timestamp_ms"))))


def event_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1,
                      glob: str | None = None) -> DataFrame:
    """The driver's `events` Parquet files as a stream (schema declared from
    the files once, never inferred per batch).  Without a cap on the files per
    trigger an availableNow run takes all files as one batch."""
    pin_utc(spark)
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    schema = reader.parquet(path).schema
    s = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        s = s.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        s = s.option("pathGlobFilter", glob)
    return s.parquet(path)


def ride_stream(spark: SparkSession, path: str, cfg: PricingConfig = DEFAULT,
                max_files_per_trigger: int | None = 1, glob: str | None = None,
                extra: tuple = ()) -> DataFrame:
    """Ride requests from an event file stream: projection + stream-static
    broadcast join with the (fixed-size) zone dimension."""
    ev = event_file_stream(spark, path, max_files_per_trigger, glob)
    dim = zone_dim(spark, cfg).select("zone_idx", "zone_id", "city", "latitude", "longitude")
    r = ride_columns(ev, cfg).join(F.broadcast(dim), "zone_idx")
    return r.select(*RIDE_COLUMNS, *extra)


def to_kafka_records(df: DataFrame, key_col: str = "zone_id") -> DataFrame:
    """Keyed JSON records (key = zone id bytes, value = the row as JSON)."""
    return df.select(F.col(key_col).cast("binary").alias("key"),
                     F.to_json(F.struct(*df.columns)).alias("value"))
