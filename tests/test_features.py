"""Time, calendar, weather and demand features (reference cases + ours)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonefare.config import FEATURE_COLUMNS
from zonefare.functions import conditions as C
from zonefare.functions.features import (clip_prediction, confidence, label_multiplier,
                                         spike_factor, supply_ratio_feature)
from zonefare.functions.timefeat import is_us_holiday, local_time, time_features


def _tf(spark, utc_ts, tz):
    df = spark.createDataFrame([(utc_ts, tz)], "ts timestamp, tz string")
    lt = local_time(F.col("ts"), F.col("tz"))
    return df.select(*[c.alias(n) for n, c in time_features(lt).items()]).first()


def test_weekday_morning_rush(spark):
    # 2026-05-18 08:00 New York = 12:00 UTC (Monday)
    r = _tf(spark, dt.datetime(2026, 5, 18, 12, 0), "America/New_York")
    assert r.hour_of_day == 8 and r.day_of_week == 0 and r.is_rush_hour and not r.is_weekend


def test_saturday_noon(spark):
    r = _tf(spark, dt.datetime(2026, 5, 23, 16, 0), "America/New_York")
    assert r.is_weekend and not r.is_rush_hour and r.is_lunch_hour and r.day_of_week == 5


def test_late_night(spark):
    r = _tf(spark, dt.datetime(2026, 5, 19, 3, 0), "America/New_York")  # 23:00 local
    assert r.hour_of_day == 23 and r.is_late_night


def test_spike_factor(spark):
    df = spark.createDataFrame([(120, 65.0), (50, 0.0)], "d int, h double")
    got = [r.s for r in df.select(spike_factor(F.col("d"), F.col("h")).alias("s")).collect()]
    assert round(got[0], 2) == 1.85 and got[1] == 1.0


def test_supply_ratio_feature(spark):
    df = spark.createDataFrame([(15, 120), (15, 0)], "drv int, d int")
    got = [r.s for r in df.select(supply_ratio_feature(F.col("drv"), F.col("d")).alias("s")).collect()]
    assert got == [0.125, 15.0]


def test_feature_columns():
    assert len(FEATURE_COLUMNS) == 21 and len(set(FEATURE_COLUMNS)) == 21


def test_weather_map_and_multipliers(spark):
    df = spark.createDataFrame([(0,), (2,), (48,), (61,), (73,), (95,), (42,), (None,)], "c int")
    sev = [r.s for r in df.select(C.wmo_severity(F.col("c")).alias("s")).collect()]
    assert sev == [1, 2, 2, 3, 4, 5, 1, 1]
    m = spark.range(1, 7).select(C.weather_demand_multiplier(F.col("id")).alias("m")).collect()
    assert [r.m for r in m] == [1.0, 1.1, 1.5, 1.9, 2.3, 1.0]


def test_supply_factor(spark):
    # heavy rain at 23:00 on a Saturday: 0.5 * 0.5 * 0.65
    v = spark.range(1).select(C.supply_factor(F.lit(4), F.lit(23), F.lit(5)).alias("f")).first().f
    assert v == pytest.approx(0.5 * 0.5 * 0.65)
    v = spark.range(1).select(C.supply_factor(F.lit(1), F.lit(8), F.lit(1)).alias("f")).first().f
    assert v == pytest.approx(1.3)


def test_hourly_lookup_out_of_bounds(spark):
    df = spark.createDataFrame([([0.1, 0.2], 1), ([0.1, 0.2], 5)], "a array<double>, h int")
    assert [r.v for r in df.select(C.hourly_value(F.col("a"), F.col("h")).alias("v")).collect()] == [0.2, 0.0]


def test_confidence_and_clip(spark):
    df = spark.createDataFrame([(0, 20.0, 2.9), (10, 30.0, 1.5), (5, 20.0, 1.2)], "d int, h double, p double")
    out = df.select(clip_prediction(F.col("p")).alias("m"),
                    confidence(F.col("d"), F.col("h"), clip_prediction(F.col("p"))).alias("c")).collect()
    assert [(r.m, r.c) for r in out] == [(2.9, 0.28), (1.5, 1.0), (1.2, 0.8)]


def test_label_formula(spark):
    df = spark.createDataFrame([(100, 9, 3, True, 1.0, False)],
                               "d int, drv int, sev int, rush boolean, ev double, hol boolean")
    v = df.select(label_multiplier(F.col("d"), F.col("drv"), F.col("sev"), F.col("rush"),
                                   F.col("ev"), F.col("hol")).alias("y")).first().y
    assert v == pytest.approx(min(2.0 + 0.3 + 0.2, 3.0))


HOLIDAYS_2024 = ["2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04",
                 "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25"]


def test_us_holidays_2024(spark):
    days = spark.range(366).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    got = [str(r.d) for r in days.filter(is_us_holiday(F.col("d"))).orderBy("d").collect()]
    assert got == HOLIDAYS_2024


def test_observed_holidays(spark):
    df = spark.createDataFrame([(dt.date(2021, 12, 31),), (dt.date(2022, 12, 26),), (dt.date(2022, 12, 27),)], "d date")
    assert [r.h for r in df.select(is_us_holiday(F.col("d")).alias("h")).collect()] == [True, True, False]


def test_iso_parse_and_format(spark):
    from zonefare.functions.timefeat import iso_format, parse_iso
    df = spark.createDataFrame([("2024-05-18T16:00:00",), ("2024-05-18T16:00:00.250000",), ("bad",)], "t string")
    out = df.select(parse_iso(F.col("t")).alias("ts")).collect()
    assert out[0].ts == dt.datetime(2024, 5, 18, 16, 0) and out[1].ts.microsecond == 250000 and out[2].ts is None
    back = df.limit(1).select(iso_format(parse_iso(F.col("t"))).alias("s")).first().s
    assert back == "2024-05-18T16:00:00"


def test_map_get_with_default(spark):
    df = spark.createDataFrame([({"temperature": 8.0},), ({},)], "m map<string,double>")
    got = [r.v for r in df.select(C.map_get(F.col("m"), "temperature", 15.0).alias("v")).collect()]
    assert got == [8.0, 15.0]
