"""Required-field validation, JSON decode, keyed JSON records, dead letters."""

import json

from pyspark.sql import functions as F

from zonefare.operators.quality import dead_letters, validate_events
from zonefare.streaming.sources import decode_events, to_kafka_records

EVENT = {"event_id": "test-123", "zone_id": "dr5ru6", "city": "new_york", "latitude": 40.7128,
         "longitude": -74.0060, "timestamp_ms": 1716048000000, "available_drivers": 15,
         "weather_severity": 1, "demand_count": 45}


def _payloads(spark, docs):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)],
                                 "id int, value string")


def _without(k):
    return {x: v for x, v in EVENT.items() if x != k}


def test_required_fields(spark):
    docs = [EVENT, _without("zone_id"), _without("timestamp_ms"), {**EVENT, "zone_id": None},
            {**EVENT, "latitude": 123.0}, "not json", {**EVENT, "available_drivers": "many"}]
    got = [r.failure_reason for r in validate_events(_payloads(spark, docs)).orderBy("id").collect()]
    assert got == [None, "missing_zone_id", "missing_timestamp_ms", "null_zone_id",
                   "coordinates_out_of_range", "unparsable", None]


def test_decode_is_permissive(spark):
    docs = [EVENT, "not json", {**EVENT, "available_drivers": "many"}, _without("zone_id")]
    rows = decode_events(_payloads(spark, docs)).collect()
    # bad text and the missing zone are dropped; a badly typed field becomes null
    assert len(rows) == 2
    assert sorted(str(r.available_drivers) for r in rows) == ["15", "None"]
    assert all(r.event_time is not None for r in rows)


def test_kafka_records(spark):
    df = spark.createDataFrame([EVENT])
    rec = to_kafka_records(df).first()
    assert isinstance(rec.key, (bytes, bytearray)) and bytes(rec.key) == b"dr5ru6"
    assert "dr5ru6" in rec.value and json.loads(rec.value)["event_id"] == "test-123"


def test_dead_letter_shape(spark):
    v = validate_events(_payloads(spark, [EVENT, _without("zone_id")]))
    d = dead_letters(v, F.lit(1716048000123).cast("long")).collect()
    assert len(d) == 1
    body = json.loads(d[0].dlq_value)
    assert set(body) == {"original_event", "failure_reason", "failed_at_ms"}
    assert body["failure_reason"] == "missing_zone_id" and body["failed_at_ms"] == 1716048000123
    assert json.loads(body["original_event"]) == _without("zone_id")
