"""Run the pricing stream: `python -m zonefare.streaming.run --help`.

Sources: a Kafka topic of JSON ride events (needs the spark-sql-kafka
package) or a folder of Parquet `events` files (replay).  Output: the
Parquet store under --root (history, current snapshot, dead letters).
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from zonefare.config import DEFAULT
from zonefare.session import build_session
from zonefare.sources.derived import payload_text
from zonefare.streaming.jobs import surge_stream_job
from zonefare.streaming.sources import kafka_stream, ride_stream


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="zone pricing stream")
    ap.add_argument("--source", choices=("kafka", "files"), default="files")
    ap.add_argument("--servers", help="Kafka bootstrap servers")
    ap.add_argument("--topic", default="ride-requests")
    ap.add_argument("--path", help="folder of events Parquet files (files source)")
    ap.add_argument("--glob", default="*.parquet")
    ap.add_argument("--root", required=True, help="output store folder (shared storage)")
    ap.add_argument("--checkpoint", help="defaults to <root>/_checkpoint: one stream per store")
    ap.add_argument("--once", action="store_true", help="process what is available, then stop")
    args = ap.parse_args(argv)

    spark = build_session(app="zonefare-stream")
    ckpt = args.checkpoint or f"{args.root.rstrip('/')}/_checkpoint"
    if args.source == "kafka":
        raw = kafka_stream(spark, args.servers, args.topic, DEFAULT)
        # the record time stands in for the failure time of dead letters
        value = F.col("value").cast("string")
        payloads = raw.select(F.get_json_object(value, "$.event_id").alias("event_id"),
                              F.unix_millis(F.col("timestamp")).alias("timestamp_ms"),
                              F.get_json_object(value, "$.zone_id").alias("zone_id"),
                              value.alias("value"))
    else:
        payloads = payload_text(ride_stream(spark, args.path, glob=args.glob, extra=("k", "event_type")))
    q = surge_stream_job(payloads, args.root, ckpt, DEFAULT, available_now=args.once)
    q.awaitTermination()


if __name__ == "__main__":
    main()
