"""Registered queries: name -> builder(spark, sf_dir) -> DataFrame.

Every builder reads the driver tables (through the ride view) so its work
grows with the data; none collects to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, FEATURE_COLUMNS
from zonefare.functions import conditions as C
from zonefare.functions.features import event_multiplier_default
from zonefare.functions.timefeat import city_timezone, local_time, time_demand_multiplier, time_features
from zonefare.model import training as M
from zonefare.model.compile import default_ensemble, with_prediction
from zonefare.operators import aggregate as A
from zonefare.operators.aggregate import surge_rows, zone_demand_supply
from zonefare.operators.calendar import with_calendar
from zonefare.operators.joins import asof_scan, interval_lookup, winner_segments
from zonefare.operators.quality import dead_letters, range_violations, validate_events
from zonefare.operators.selection import exact_medians, impute
from zonefare.operators.windows import sliding_demand, trailing_counts_scan
from zonefare.plans import serving as S
from zonefare.schemas import DLQ_SCHEMA, EVENT_SCHEMA, WEATHER_PAYLOAD_SCHEMA
from zonefare.session import checkpoint_dir
from zonefare.sources import derived as DV
from zonefare.sources.rides import ride_columns, rides, zone_dim
from zonefare.sources.tables import is_folder, read_table, table_path
from zonefare.streaming import jobs as J
from zonefare.streaming import store as ST
from zonefare.streaming.commitlog import CommitLog
from zonefare.streaming.sources import ride_stream

SURGE_COLUMNS = ("zone_id", "city", "demand_1min", "demand_5min", "demand_15min",
                 "available_drivers", "weather_severity", "supply_ratio",
                 "rule_multiplier", "ml_multiplier", "final_multiplier",
                 "ml_confidence", "is_special_event", "surge_tier")

REGISTRY: dict = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def surge_by_batch(spark: SparkSession, sf_dir: str, batch: str = "day",
                   cfg=DEFAULT) -> DataFrame:
    """Per-batch zone prices, a batch being a UTC calendar day or hour."""
    r = rides(spark, sf_dir, cfg)
    unit = F.to_date("event_time") if batch == "day" else F.date_trunc("hour", "event_time")
    agg = zone_demand_supply(r, unit.alias("batch"))
    return surge_rows(agg, cfg).select("batch", *SURGE_COLUMNS)


@register("surge_by_zone_day")
def q_surge_by_zone_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = surge_by_batch(spark, sf_dir, "day")
    return out.select(F.date_format("batch", "yyyy-MM-dd").alias("batch_date"), *SURGE_COLUMNS)


# ---------------------------------------------------------------------------
# zones
# ---------------------------------------------------------------------------
AS_OF_FRESHNESS = "2024-01-16 00:00:00"
AS_OF_RETENTION = "2024-01-20 00:00:00"


@register("zone_grid")
def q_zone_grid(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    counts = ride_columns(ev).groupBy("zone_idx").agg(F.count(F.lit(1)).alias("n_events"))
    dim = zone_dim(spark)
    return counts.join(F.broadcast(dim), "zone_idx").select(
        "zone_idx", "zone_id", "city", "grid_i", "grid_j", "latitude", "longitude", "n_events")


@register("zone_collisions")
def q_zone_collisions(spark, sf_dir):
    per_point = rides(spark, sf_dir).groupBy("zone_id", "city", "zone_idx").agg(F.count(F.lit(1)).alias("n"))
    return per_point.groupBy("zone_id", "city").agg(
        F.count(F.lit(1)).alias("grid_points"), F.sum("n").alias("n_events"))


@register("zones_per_city")
def q_zones_per_city(spark, sf_dir):
    pts = rides(spark, sf_dir).groupBy("city", "zone_idx", "zone_id").agg(F.count(F.lit(1)).alias("n"))
    return pts.groupBy("city").agg(F.count(F.lit(1)).alias("grid_zones"),
                                   F.countDistinct("zone_id").alias("distinct_zone_ids"))


# ---------------------------------------------------------------------------
# validation, dead letters, JSON
# ---------------------------------------------------------------------------
@register("event_validation_split")
def q_event_validation_split(spark, sf_dir):
    v = validate_events(DV.ride_payloads(spark, sf_dir))
    return (v.groupBy(F.coalesce(F.col("failure_reason"), F.lit("valid")).alias("failure_reason"))
            .agg(F.count(F.lit(1)).alias("n_events")))


@register("dlq_records")
def q_dlq_records(spark, sf_dir):
    v = validate_events(DV.ride_payloads(spark, sf_dir))
    d = dead_letters(v, F.col("timestamp_ms"))
    back = F.from_json("dlq_value", DLQ_SCHEMA)
    ok = ((back["original_event"] == F.col("value")) & (back["failure_reason"] == F.col("failure_reason"))
          & (back["failed_at_ms"] == F.col("failed_at_ms")))
    return d.select("event_id", "failure_reason", "failed_at_ms", F.coalesce(ok, F.lit(False)).alias("dlq_ok"))


@register("event_json_roundtrip")
def q_event_json_roundtrip(spark, sf_dir):
    r = rides(spark, sf_dir)
    orig = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])
    msg = r.select("zone_id", F.col("zone_id").cast("binary").alias("key"), F.to_json(orig).alias("value"),
                   orig.alias("orig"))
    back = F.from_json("value", EVENT_SCHEMA)
    ok = back.eqNullSafe(F.col("orig")) & (F.col("key").cast("string") == back["zone_id"])
    return msg.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n_events"),
                                      F.count_if(ok).alias("n_roundtrip_ok"))


# ---------------------------------------------------------------------------
# windows
# ---------------------------------------------------------------------------
def _sliding(seconds):
    def q(spark, sf_dir):
        return sliding_demand(rides(spark, sf_dir), seconds, 10)
    return q


for _s in (60, 300, 900):
    register(f"demand_sliding_{_s}")(_sliding(_s))


@register("rolling_demand")
def q_rolling_demand(spark, sf_dir):
    t = trailing_counts_scan(rides(spark, sf_dir), (60, 300, 900))
    return t.select("event_id", "zone_id", "timestamp_ms", "demand_60", "demand_300", "demand_900")


# ---------------------------------------------------------------------------
# history, current view, freshness, retention, baselines
# ---------------------------------------------------------------------------
@register("latest_surge_per_zone")
def q_latest_surge_per_zone(spark, sf_dir):
    cur = S.current_view(S.surge_history(spark, sf_dir, "hour"))
    return cur.select("zone_id", "city", "timestamp", "demand_1min", "available_drivers",
                      "rule_multiplier", "final_multiplier",
                      A.surge_tier(F.col("final_multiplier")).alias("surge_tier"))


@register("surge_freshness")
def q_surge_freshness(spark, sf_dir):
    h = S.surge_history(spark, sf_dir, "minute")
    cur = S.current_as_of(h, AS_OF_FRESHNESS, 120, 60)
    return cur.select("zone_id", "city", "updated_at", "final_multiplier", "age_seconds", "is_fresh")


@register("zone_history_topn")
def q_zone_history_topn(spark, sf_dir):
    return S.zone_history(S.surge_history(spark, sf_dir, "hour"), 100)


def _history_store(spark, sf_dir) -> str:
    """The hour history in a store of its own: a commit a day, then compacted, so a date's files are clustered by zone."""
    key = (spark.sparkContext.applicationId, sf_dir, "history")
    if key not in _STREAM_RUNS:
        root = _run_dir(spark, "history")
        h = S.surge_history(spark, sf_dir, "hour")
        ST.commit_prices(spark, root, "load", 0, h)
        CommitLog(spark, root).compact(ST.HISTORY, "timestamp", "zone_id", min_files=2, target_bytes=16 << 10)
        _STREAM_RUNS[key] = root
    return _STREAM_RUNS[key]


@register("zone_history_lookup")
def q_zone_history_lookup(spark, sf_dir):
    """Newest 100 history rows of one zone (the least requested id that has any), from the files that may hold it."""
    root = _history_store(spark, sf_dir)
    known = ST.read_current(spark, root).select("zone_id")
    zone = DV.price_requests(spark, sf_dir).join(known, "zone_id", "left_semi").agg(F.min("zone_id")).first()[0]
    return S.zone_history(ST.read_history(spark, root, zone=zone or ""), 100).drop("timestamp_iso")


@register("retention_window")
def q_retention_window(spark, sf_dir):
    h = S.surge_history(spark, sf_dir, "hour")
    as_of = F.lit(AS_OF_RETENTION).cast("timestamp")
    keep = (F.col("timestamp") > as_of - F.expr("INTERVAL 604800 SECONDS")) & (F.col("timestamp") <= as_of)
    return h.filter(keep).select("zone_id", "city", "timestamp", "final_multiplier")


@register("historical_avg_coded")
def q_historical_avg_coded(spark, sf_dir):
    b = S.historical_baseline(S.surge_history(spark, sf_dir, "hour"), 1000)
    return b.select("zone_id", F.round("avg_demand", 6).alias("avg_demand"),
                    F.round("avg_surge", 6).alias("avg_surge"))


@register("historical_avg_by_hour")
def q_historical_avg_by_hour(spark, sf_dir):
    h = S.with_local_time(S.surge_history(spark, sf_dir, "hour"), "timestamp")
    return (h.groupBy("zone_id", F.hour("local_time").alias("hour_of_day"),
                      F.weekday("local_time").alias("day_of_week"))
            .agg(F.round(A.nonzero_mean(F.col("demand_1min"), 20.0), 6).alias("avg_demand"),
                 F.round(A.nonzero_mean(F.col("final_multiplier"), 1.0), 6).alias("avg_surge")))


# ---------------------------------------------------------------------------
# time, calendar, weather, demand/supply models
# ---------------------------------------------------------------------------
def _rides_local(spark, sf_dir, extra=()):
    r = rides(spark, sf_dir, extra=extra)
    return r.withColumn("local_time", local_time(F.col("event_time"), city_timezone(F.col("city"))))


@register("time_features")
def q_time_features(spark, sf_dir):
    r = _rides_local(spark, sf_dir)
    tf = time_features(F.col("local_time"))
    return r.select("event_id", "city", "local_time", *[c.alias(n) for n, c in tf.items()])


def _city_dates(spark, sf_dir):
    r = _rides_local(spark, sf_dir)
    return r.groupBy("city", F.to_date("local_time").alias("local_date")).agg(
        F.count(F.lit(1)).alias("n_events"))


@register("calendar_features")
def q_calendar_features(spark, sf_dir):
    return with_calendar(_city_dates(spark, sf_dir), "local_date").select(
        "city", F.date_format("local_date", "yyyy-MM-dd").alias("local_date"), "n_events", "is_holiday",
        "days_to_next_holiday")


@register("holiday_multiplier")
def q_holiday_multiplier(spark, sf_dir):
    return with_calendar(_city_dates(spark, sf_dir), "local_date").select("city", F.date_format("local_date", "yyyy-MM-dd").alias("local_date"),
                    "is_holiday", "is_holiday_eve",
                    C.holiday_multiplier(F.col("is_holiday"), F.col("is_holiday_eve")).alias("holiday_multiplier"))


@register("wmo_severity")
def q_wmo_severity(spark, sf_dir):
    w = DV.weather_obs(spark, sf_dir)
    return w.select("obs_id", "city", "weathercode", C.wmo_severity(F.col("weathercode")).alias("severity"))


@register("hourly_precip_lookup")
def q_hourly_precip_lookup(spark, sf_dir):
    w = DV.weather_obs(spark, sf_dir)
    payload = F.to_json(F.struct(
        "city",
        F.struct("temperature", "windspeed", "weathercode").alias("current_weather"),
        F.struct("precipitation").alias("hourly")))
    p = w.select("obs_id", "city", "updated_at", F.from_json(payload, WEATHER_PAYLOAD_SCHEMA).alias("w"))
    cw = F.col("w.current_weather")
    hour = F.hour(local_time(F.col("updated_at"), city_timezone(F.col("city"))))
    return p.select(
        "obs_id", "city", "updated_at", hour.alias("local_hour"),
        F.coalesce(cw["temperature"], F.lit(15.0)).alias("temperature"),
        F.coalesce(cw["windspeed"], F.lit(0.0)).alias("windspeed"),
        F.coalesce(cw["weathercode"], F.lit(0)).alias("weathercode"),
        C.wmo_severity(F.coalesce(cw["weathercode"], F.lit(0))).alias("severity"),
        C.hourly_value(F.col("w.hourly.precipitation"), hour).alias("precipitation"))


@register("demand_multipliers")
def q_demand_multipliers(spark, sf_dir):
    r = _rides_local(spark, sf_dir)
    g = r.groupBy("city", F.hour("local_time").alias("hour_of_day"),
                  F.weekday("local_time").alias("day_of_week"), "weather_severity").agg(
        F.count(F.lit(1)).alias("n_events"))
    return g.select("*", time_demand_multiplier(F.col("hour_of_day"), F.col("day_of_week")).alias("time_multiplier"),
                    C.weather_demand_multiplier(F.col("weather_severity")).alias("weather_multiplier"))


def city_dim(spark):
    from zonefare.config import DEFAULT as cfg
    return spark.createDataFrame([(c.name, c.base_demand, c.num_zones, c.timezone) for c in cfg.cities],
                                 "city string, base_demand int, num_zones int, timezone string")


def expected_demand_columns(r):
    """Supply factor and noise-free expected demand/supply per ride; `r`
    has the city dimension columns, local_time and holiday flags."""
    h, dow = F.hour("local_time"), F.weekday("local_time")
    hol = C.holiday_multiplier(F.col("is_holiday"), F.col("is_holiday_eve"))
    sf = C.supply_factor(F.col("weather_severity"), h, dow)
    dem = C.expected_demand(F.col("base_demand"), F.col("num_zones"), time_demand_multiplier(h, dow),
                            C.weather_demand_multiplier(F.col("weather_severity")), F.lit(1.0), hol)
    return r.select("event_id", "zone_id", "city", sf.alias("supply_factor"),
                    dem.alias("expected_demand"), C.expected_supply(sf).alias("expected_supply"))


@register("expected_demand_supply")
def q_expected_demand_supply(spark, sf_dir):
    r = rides(spark, sf_dir).join(F.broadcast(city_dim(spark)), "city")  # 3-row dimension
    r = r.withColumn("local_time", local_time(F.col("event_time"), F.col("timezone")))
    return expected_demand_columns(with_calendar(r.withColumn("local_date", F.to_date("local_time")), "local_date"))


# ---------------------------------------------------------------------------
# joins: special events, weather as-of
# ---------------------------------------------------------------------------
@register("event_interval_join")
def q_event_interval_join(spark, sf_dir):
    segs = winner_segments(DV.event_calendar(spark, sf_dir))
    facts = rides(spark, sf_dir).select("event_id", "zone_id", "timestamp_ms")
    j = interval_lookup(facts, segs.withColumnRenamed("event_id", "special_event_id"), "zone_id",
                        "timestamp_ms", ["special_event_id", "multiplier"], bucket_ms=3_600_000)
    is_ev = F.col("special_event_id").isNotNull()
    return j.select("event_id", "zone_id", "special_event_id", is_ev.alias("is_special_event"),
                    F.coalesce(F.col("multiplier"), F.lit(1.0)).alias("event_demand_multiplier"),
                    event_multiplier_default(is_ev).alias("default_event_multiplier"))


@register("weather_asof")
def q_weather_asof(spark, sf_dir):
    w = DV.weather_obs(spark, sf_dir)
    r = rides(spark, sf_dir).select("event_id", "city", "timestamp_ms")
    j = asof_scan(r, w, "city", "timestamp_ms", "updated_at_ms", ["obs_id", "weathercode", "temperature"],
                  DEFAULT.weather_ttl_seconds * 1000, tie="obs_id")
    return j.select("event_id", "city", "obs_id",
                    F.coalesce(C.wmo_severity(F.col("weathercode")), F.lit(1)).alias("weather_severity"),
                    F.when(F.col("obs_id").isNull(), 15.0)
                    .otherwise(F.coalesce(F.col("temperature"), F.lit(15.0))).alias("temperature"))


# ---------------------------------------------------------------------------
# features, label, confidence, blend
# ---------------------------------------------------------------------------
def _features(spark, sf_dir):
    h = S.surge_history(spark, sf_dir, "hour")
    return S.feature_rows(h, S.historical_baseline(h, 1000))


FEATURE_OUT = ("zone_id", "city", "timestamp") + FEATURE_COLUMNS


@register("feature_vector")
def q_feature_vector(spark, sf_dir):
    return _features(spark, sf_dir).select(*FEATURE_OUT)


def with_conditions(h: DataFrame, weather: DataFrame, calendar: DataFrame, batch_seconds: int = 3600, cfg=DEFAULT) -> DataFrame:
    """History rows with the conditions at the end of their batch: newest weather of the
    city within the weather time-to-live, and the special event running in the zone."""
    end = F.unix_millis("timestamp") + batch_seconds * 1000
    h = h.withColumns({"__row": F.concat_ws("|", "zone_id", "city", F.unix_millis("timestamp")), "__end": end}).drop("is_special_event")
    w = asof_scan(h, weather, "city", "__end", "updated_at_ms", ["obs_id", "temperature", "precipitation"],
                  cfg.weather_ttl_seconds * 1000, tie="obs_id")
    hour = F.hour(local_time(F.timestamp_millis("__end"), city_timezone(F.col("city"))))
    w = w.withColumn("precipitation", C.hourly_value(F.col("precipitation"), hour))
    segs = winner_segments(calendar).withColumnRenamed("event_id", "special_event_id")
    e = interval_lookup(w, segs, "zone_id", "__end", ["special_event_id", "multiplier"], bucket_ms=3_600_000)
    return (e.withColumn("is_special_event", F.col("special_event_id").isNotNull())
            .withColumn("event_demand_multiplier", F.coalesce("multiplier", F.lit(1.0)))
            .drop("__row", "__end", "obs_id", "updated_at_ms_matched", "special_event_id", "multiplier"))


@register("feature_vector_conditions")
def q_feature_vector_conditions(spark, sf_dir):
    """The feature vector with observed weather and special events instead of defaults."""
    h = S.surge_history(spark, sf_dir, "hour")
    rich = with_conditions(h, DV.weather_obs(spark, sf_dir), DV.event_calendar(spark, sf_dir))
    return S.feature_rows(rich, S.historical_baseline(h, 1000)).select(*FEATURE_OUT)


@register("label_formula")
def q_label_formula(spark, sf_dir):
    return _features(spark, sf_dir).select("zone_id", "city", "timestamp",
                                           S.label_column().alias("actual_multiplier"))


@register("confidence_score")
def q_confidence_score(spark, sf_dir):
    p = S.hybrid_prices(_features(spark, sf_dir), S.label_column())
    return p.select("zone_id", "city", "timestamp", "ml_multiplier", "ml_confidence")


@register("hybrid_price")
def q_hybrid_price(spark, sf_dir):
    return S.hybrid_prices(_features(spark, sf_dir), S.label_column())


# ---------------------------------------------------------------------------
# fleet / dashboard / look-ups
# ---------------------------------------------------------------------------
def _current(spark, sf_dir):
    return S.current_view(S.surge_history(spark, sf_dir, "hour"))


@register("fleet_summary")
def q_fleet_summary(spark, sf_dir):
    return A.fleet_summary(_current(spark, sf_dir))


@register("fleet_summary_city")
def q_fleet_summary_city(spark, sf_dir):
    return A.fleet_summary(_current(spark, sf_dir), "city")


@register("tier_distribution")
def q_tier_distribution(spark, sf_dir):
    return A.tier_distribution(_current(spark, sf_dir), spark)


@register("active_zones")
def q_active_zones(spark, sf_dir):
    """Active zones, one row per (city, zone) with the city's zone count; the
    per-city counts (one row per city) are broadcast back, so no city's zone
    list is gathered into a single row or task."""
    cur = _current(spark, sf_dir).select("city", "zone_id")
    counts = cur.groupBy("city").agg(F.count(F.lit(1)).alias("zone_count"))
    return cur.join(F.broadcast(counts), "city").orderBy("city", "zone_id")


@register("price_batch_lookup")
def q_price_batch_lookup(spark, sf_dir):
    # distinct ids first: map-side aggregation collapses repeated (hot) ids
    ids = DV.price_requests(spark, sf_dir).select("zone_id").distinct()
    cur = _current(spark, sf_dir)
    return cur.join(ids, "zone_id", "left_semi").select("zone_id", "city", "final_multiplier",
                                                          A.surge_tier(F.col("final_multiplier")).alias("surge_tier"))


@register("price_lookup_default")
def q_price_lookup_default(spark, sf_dir):
    from zonefare.operators.joins import lookup_with_default
    req = DV.price_requests(spark, sf_dir)
    cur = _current(spark, sf_dir).select(
        "zone_id", "city", "final_multiplier", "rule_multiplier", "ml_multiplier", "ml_confidence",
        A.surge_tier(F.col("final_multiplier")).alias("surge_tier"))
    return lookup_with_default(req, cur, "zone_id", S.default_price()).select(
        "request_id", "zone_id", "city", "final_multiplier", "rule_multiplier", "ml_multiplier",
        "ml_confidence", "surge_tier")


def _newest_batch_end(h: DataFrame, batch_seconds: int = 3600) -> str:
    """A minute after the end of the newest batch: the instant that the look-ups are asked at."""
    newest = h.agg(F.max("timestamp") + F.expr(f"INTERVAL {batch_seconds + 60} SECONDS")).first()[0]
    return str(newest) if newest is not None else "1970-01-01 00:00:00"


def _live(spark, sf_dir, ids=None) -> DataFrame:
    h = S.surge_history(spark, sf_dir, "hour")
    return S.price_all(h, _newest_batch_end(h), default_ensemble(), ids=ids).select(*S.PRICE_COLUMNS)


@register("price_all")
def q_price_all(spark, sf_dir):
    """Hybrid price of every zone with a current row."""
    return _live(spark, sf_dir)


@register("price_all_totals")
def q_price_all_totals(spark, sf_dir):
    return A.fleet_summary(_live(spark, sf_dir))


@register("price_list")
def q_price_list(spark, sf_dir):
    """Hybrid price of the requested zones that have a current row."""
    return _live(spark, sf_dir, DV.price_requests(spark, sf_dir))


@register("price_one")
def q_price_one(spark, sf_dir):
    """Hybrid price per request, the default row where a zone has none."""
    return S.price_requested(DV.price_requests(spark, sf_dir), _live(spark, sf_dir)).select("request_id", *S.PRICE_COLUMNS)


@register("dashboard_table")
def q_dashboard_table(spark, sf_dir):
    return S.dashboard_table(_current(spark, sf_dir))


@register("quality_range_checks")
def q_quality_range_checks(spark, sf_dir):
    return range_violations(S.hybrid_prices(_features(spark, sf_dir), S.label_column()))


# ---------------------------------------------------------------------------
# imputation and standardisation
# ---------------------------------------------------------------------------
MEDIAN_FEATURES = ("demand_last_1min", "demand_spike_factor", "available_drivers", "supply_ratio",
                   "hour_of_day", "weather_severity", "historical_avg_demand")


@register("median_impute")
def q_median_impute(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.agg(*[F.median(F.col(c).cast("double")).alias(f"median_{c}") for c in MEDIAN_FEATURES])


@register("weather_imputed")
def q_weather_imputed(spark, sf_dir):
    """Weather readings with missing temperatures filled by the median of the known ones."""
    w = DV.weather_obs(spark, sf_dir).select("obs_id", "city", "temperature")
    filled = impute(w.withColumn("known", F.col("temperature")), exact_medians(w, ["temperature"]))
    return filled.select("obs_id", "city", F.col("known").isNull().alias("was_missing"), "temperature")


ZSCORE_FEATURES = ("demand_last_1min", "available_drivers", "supply_ratio", "demand_spike_factor")


@register("feature_zscore")
def q_feature_zscore(spark, sf_dir):
    f = _features(spark, sf_dir)
    # one-row aggregate: fetched once, then applied as literals
    st = f.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in ZSCORE_FEATURES],
               *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in ZSCORE_FEATURES]).first()
    cols = []
    for c in ZSCORE_FEATURES:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        z = (F.col(c).cast("double") - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
        cols.append(F.round(z, 6).alias(f"z_{c}"))
    return f.select("zone_id", "city", "timestamp", *cols)


@register("train_split_zscore")
def q_train_split_zscore(spark, sf_dir):
    """Every feature row's side of the 80/20 split, and its features standardised by the training side."""
    f = _features(spark, sf_dir).withColumn("is_train", M.portable_split(F.col("zone_id"), F.col("timestamp")))
    numbers = [F.col(c).cast("double").alias(c) for c in ZSCORE_FEATURES]
    st = f.filter("is_train").select(*numbers).agg(
        *[F.avg(c).alias(f"m_{c}") for c in ZSCORE_FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in ZSCORE_FEATURES]).first()
    z = lambda c: (F.col(c).cast("double") - F.lit(st[f"m_{c}"])) / F.lit(st[f"s_{c}"]) if st[f"s_{c}"] else F.lit(0.0)
    return f.select("zone_id", "city", "timestamp", "is_train", *[F.round(z(c), 6).alias(f"z_{c}") for c in ZSCORE_FEATURES])


@register("ensemble_metrics")
def q_ensemble_metrics(spark, sf_dir):
    """MAE and R2 of the shipped ensemble on the test side of the split."""
    f = _features(spark, sf_dir).filter(~M.portable_split(F.col("zone_id"), F.col("timestamp")))
    p = with_prediction(f.withColumn(M.LABEL, S.label_column()), default_ensemble())
    return M.error_metrics(p)


# ---------------------------------------------------------------------------
# streaming (file-source twin of the Kafka scan, availableNow trigger)
# ---------------------------------------------------------------------------
_STREAM_RUNS: dict = {}


def _run_dir(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/zonefare-runs/{name}-{uuid.uuid4().hex[:12]}"


def _events_stream(spark, sf_dir, extra=()):
    """The events table as a stream: one file, or a folder of part files.  A replay
    takes the table as one batch: part files are in no order of event time, and
    with a file per batch the watermark would drop the rows behind it."""
    table = table_path(sf_dir, "events")
    if is_folder(spark, table):
        return ride_stream(spark, table, max_files_per_trigger=None, extra=extra)
    return ride_stream(spark, sf_dir, max_files_per_trigger=None, glob="events.parquet", extra=extra)


#: A replay hands the table over in this many slices of equal time span; jobs with state of their own in fewer.
REPLAY_SLICES, STATE_SLICES = 4, 3


def _time_slice(events: DataFrame, n: int = REPLAY_SLICES):
    """The number of an event's slice: n equal spans between the first and the last event."""
    span = events.agg(F.unix_micros(F.min("ts").cast("timestamp")).alias("lo"), F.unix_micros(F.max("ts").cast("timestamp")).alias("hi")).first()
    lo, hi = (span.lo, span.hi) if span.lo is not None else (0, 0)
    return F.expr(f"int(coalesce((unix_micros(cast(ts as timestamp)) - {lo}) * {n} div {hi - lo + 1}, 0))")


def _replay(spark, sf_dir, name: str, start, order=tuple(range(REPLAY_SLICES)), flush=None) -> str:
    """Run a streaming job over the events table slice by slice.

    `start(path, root)` starts the job over the files that have arrived under `path`; it
    is started anew from its checkpoint for every slice, takes what is there as one
    batch and stops.  `order`: which slice comes when; `flush`: rows that follow the
    table, to move the watermark past its end.  Returns the run's folder.
    """
    root = _run_dir(spark, name)
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    staged = events.withColumn("__slice", _time_slice(events, len(order)))
    staged.write.partitionBy("__slice").parquet(f"{root}/staged")
    arrivals = [spark.read.schema(events.schema).parquet(f"{root}/staged/__slice={i}") for i in order
                if is_folder(spark, f"{root}/staged/__slice={i}")]
    for i, rows in enumerate(arrivals + ([flush(events)] if flush else [])):
        rows.write.parquet(f"{root}/src/{i}")
        start(f"{root}/src/*", root).awaitTermination()
    return root


def _replay_rides(spark, path, extra=()):
    return ride_stream(spark, path, max_files_per_trigger=None, extra=extra)


def _replay_sink(spark, sf_dir, name, build, flush=None, slices: int = STATE_SLICES) -> DataFrame:
    """Rows that a streaming DataFrame (`build(path)`) appends over a replay in time order."""
    late = []

    def start(path, root):
        q = (build(path).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{root}/_checkpoint").option("path", f"{root}/out").trigger(availableNow=True).start())
        q.awaitTermination()
        late.append(sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", [])))
        return q

    root = _replay(spark, sf_dir, name, start, tuple(range(slices)), flush)
    if sum(late):
        raise ValueError(f"{name}: {sum(late)} rows dropped as late")
    return spark.read.parquet(f"{root}/out")


def _surge_stream_root(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAM_RUNS:
        root = _run_dir(spark, "surge")
        payloads = DV.payload_text(_events_stream(spark, sf_dir, ("k", "event_type")))
        J.surge_stream_job(payloads, root, f"{root}/_checkpoint", available_now=True).awaitTermination()
        _STREAM_RUNS[key] = root
    return _STREAM_RUNS[key]


def _sink_and_read(spark, df, name, mode="append"):
    root = _run_dir(spark, name)
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", f"{root}/_checkpoint").option("path", f"{root}/out")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", []))
    if late:
        raise ValueError(f"{name}: {late} rows dropped as late")
    return spark.read.parquet(f"{root}/out")


@register("stream_surge_batches")
def q_stream_surge_batches(spark, sf_dir):
    return ST.read_history(spark, _surge_stream_root(spark, sf_dir)).select(*S.HISTORY_COLUMNS)


@register("stream_current_view")
def q_stream_current_view(spark, sf_dir):
    cur = ST.read_current(spark, _surge_stream_root(spark, sf_dir))
    return cur.select("zone_id", "city", "updated_at", "demand_1min", "rule_multiplier",
                      "final_multiplier", A.surge_tier(F.col("final_multiplier")).alias("surge_tier"))


@register("stream_dead_letters")
def q_stream_dead_letters(spark, sf_dir):
    root = _surge_stream_root(spark, sf_dir)
    return ST.read_dead_letters(spark, root).select("event_id", "failure_reason", "failed_at_ms")


@register("stream_sliding_demand")
def q_stream_sliding_demand(spark, sf_dir):
    return _replay_sink(spark, sf_dir, "sliding", lambda path: J.sliding_demand_stream(_replay_rides(spark, path), 60))


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    def twice(path):  # the same records delivered twice
        d = J.dedup_stream(_replay_rides(spark, path).unionByName(_replay_rides(spark, path)))
        return d.select("event_id", "zone_id", "event_time")
    return _replay_sink(spark, sf_dir, "dedup", twice)


def _calendar(signups: DataFrame) -> DataFrame:
    """The special events that `signup` rides stand for."""
    k = F.col("k")
    return signups.select(
        "zone_id", "event_id", F.col("timestamp_ms").alias("start_ms"),
        (F.col("timestamp_ms") + (F.lit(60) + F.floor(k * 180 / 99)).cast("long") * 60_000).alias("end_ms"),
        (F.lit(2.0) + k.cast("double") / 50.0).alias("multiplier"))


def _end_of_replay(events: DataFrame) -> DataFrame:
    """One row a week after the last event: it moves the watermark past every start and is itself still waiting at the end."""
    last = events.agg(F.max("ts").alias("ts")).filter("ts IS NOT NULL")
    return last.select(F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts"),
                       F.lit(0).cast("long").alias("user_id"), F.lit("signup").alias("event_type"), F.lit(0.0).alias("value"),
                       F.lit('{"k": 0}').alias("props"))


@register("stream_event_state")
def q_stream_event_state(spark, sf_dir):
    """One special event per zone at a time, decided by event-time timers over a replay in slices."""
    J.rocksdb_state(spark)

    def accepted(path):
        r = _replay_rides(spark, path, ("k", "event_type")).filter(F.col("event_type") == "signup")
        return J.event_state_stream(_calendar(r))
    return _replay_sink(spark, sf_dir, "event_state", accepted, flush=_end_of_replay, slices=2)


#: Order of arrival of the slices where late rows are wanted: the second one comes after the third.
LATE_ORDER = (0, 2, 1, 3)


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """Every ride of a replay with a late slice: its batch, and whether it was on time."""
    def start(path, root):
        return J.on_time_job(_replay_rides(spark, path), f"{root}/store", f"{root}/_checkpoint", available_now=True)
    log = CommitLog(spark, _replay(spark, sf_dir, "late", start, order=LATE_ORDER) + "/store")
    return (log.read("on_time").withColumn("is_late", F.lit(False))
            .unionByName(log.read("late").withColumn("is_late", F.lit(True)))
            .select("event_id", "zone_id", "event_time", "batch_id", "is_late"))


def _windows_root(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, "windows")
    if key not in _STREAM_RUNS:
        def start(path, root):
            return J.shared_windows_job(_replay_rides(spark, path), f"{root}/store", f"{root}/_checkpoint", available_now=True)
        _STREAM_RUNS[key] = _replay(spark, sf_dir, "windows", start, tuple(range(STATE_SLICES))) + "/store"
    return _STREAM_RUNS[key]


def _stream_windows(seconds):
    def q(spark, sf_dir):
        """Windows of one length, from the panes that the three lengths share, after a replay in batches."""
        return J.current_windows(spark, _windows_root(spark, sf_dir), seconds)
    return q


for _s in (60, 300, 900):
    register(f"stream_windows_{_s}")(_stream_windows(_s))


@register("stream_ride_events")
def q_stream_ride_events(spark, sf_dir):
    """Rides and the special events running in their zone, joined as two streams."""
    def joined(path):
        r = _replay_rides(spark, path, ("k", "event_type"))
        cal = _calendar(r.filter(F.col("event_type") == "signup"))
        both = J.ride_events_stream(_replay_rides(spark, path).select("event_id", "zone_id", "event_time"), cal)
        return both.select("event_id", "zone_id", "special_event_id", "multiplier")
    return _replay_sink(spark, sf_dir, "ride-events", joined)


@register("stream_weather_versions")
def q_stream_weather_versions(spark, sf_dir):
    """Every weather reading with the time it holds, after a replay in batches."""
    def start(path, root):
        r = _replay_rides(spark, path, ("k", "event_type", "value"))
        return J.weather_job(DV.weather_columns(r), f"{root}/store", f"{root}/_checkpoint", available_now=True)
    return J.weather_versions(spark, _replay(spark, sf_dir, "weather", start) + "/store").select(
        "obs_id", "city", "severity", "temperature", "valid_from", "valid_to")


def _surge_replay_root(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, "replay")
    if key not in _STREAM_RUNS:
        def start(path, root):
            payloads = DV.payload_text(_replay_rides(spark, path, ("k", "event_type")))
            return J.surge_stream_job(payloads, f"{root}/store", f"{root}/_checkpoint", available_now=True)
        _STREAM_RUNS[key] = _replay(spark, sf_dir, "surge-replay", start) + "/store"
    return _STREAM_RUNS[key]


@register("stream_surge_replay")
def q_stream_surge_replay(spark, sf_dir):
    """History rows of the pricing stream over several batches, each of them one commit of the store."""
    return ST.read_history(spark, _surge_replay_root(spark, sf_dir)).select("batch_id", *S.HISTORY_COLUMNS)


@register("stream_batch_ledger")
def q_stream_batch_ledger(spark, sf_dir):
    """Per batch: payloads read, valid, failed and late ones, and what the store holds of it."""
    root = _surge_replay_root(spark, sf_dir)
    zones = ST.read_history(spark, root).groupBy("batch_id").agg(F.count(F.lit(1)).alias("zones"))
    dead = ST.read_dead_letters(spark, root).groupBy("batch_id").agg(F.count(F.lit(1)).alias("dead_letters"))
    return (ST.read_ledger(spark, root).join(zones, "batch_id", "left").join(dead, "batch_id", "left")
            .select("batch_id", "payloads", "valid", "failed", "late", F.coalesce("zones", F.lit(0)).alias("zones"),
                    F.coalesce("dead_letters", F.lit(0)).alias("dead_letters")))


# ---------------------------------------------------------------------------
# Spark ML
# ---------------------------------------------------------------------------

_MODELS: dict = {}


def _trained(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        frame = M.to_training_frame(_features(spark, sf_dir), S.label_column())
        t = M.train(frame)  # the config's 200 trees and least number of rows
        path = _run_dir(spark, "model")
        M.save(t.model, path)
        _MODELS[key] = (t, path)
    return _MODELS[key]


@register("gbt_train_metrics")
def q_gbt_train_metrics(spark, sf_dir):
    t, _ = _trained(spark, sf_dir)
    return (M.metrics(t.model, t.test).withColumn("train_rows", F.lit(t.train_rows).cast("long"))
            .withColumn("meets_minimum", F.lit(t.train_rows >= DEFAULT.training_min_samples)))


@register("gbt_feature_top5")
def q_gbt_feature_top5(spark, sf_dir):
    t, _ = _trained(spark, sf_dir)
    return M.importances(spark, t.model, 5)


@register("gbt_score_zones")
def q_gbt_score_zones(spark, sf_dir):
    """Reload the saved model and price every zone's latest feature row."""
    _, path = _trained(spark, sf_dir)
    model = M.load(path)
    feats = _features(spark, sf_dir)
    latest = S.current_view(feats.select("zone_id", "city", "timestamp")).select("zone_id", "timestamp")
    f = feats.join(latest, ["zone_id", "timestamp"], "left_semi")
    scored = M.score(model, f).select("zone_id", "timestamp", "ml_prediction")
    return S.hybrid_prices(f.join(scored, ["zone_id", "timestamp"]), F.col("ml_prediction"))


@register("latest_features_per_zone")
def q_latest_features_per_zone(spark, sf_dir):
    """Feature store read: each zone's newest feature row at `as_of`, fresh
    while younger than twice the surge TTL (rows are stamped at batch end)."""
    f = _features(spark, sf_dir).select("zone_id", "city", "timestamp", *FEATURE_COLUMNS)
    cur = S.current_as_of(f, AS_OF_RETENTION, 2 * 120, 3600)  # stored at the end of the hour
    return cur.select("zone_id", "city", F.col("updated_at").alias("stored_at"), "demand_last_1min",
                      "demand_spike_factor", "available_drivers", "supply_ratio", "hour_of_day",
                      "is_holiday", "historical_avg_demand", "age_seconds", "is_fresh")


@register("zone_history_series")
def q_zone_history_series(spark, sf_dir):
    return S.history_series(S.surge_history(spark, sf_dir, "hour"))


@register("surge_by_zone_hour")
def q_surge_by_zone_hour(spark, sf_dir):
    """Hour batches: at larger scale every zone-day saturates at the top
    rule level, hour batches keep the price levels apart."""
    return surge_by_batch(spark, sf_dir, "hour").withColumnRenamed("batch", "batch_hour")


@register("stream_expected_demand")
def q_stream_expected_demand(spark, sf_dir):
    """The ride stream enriched by stream-static joins (zone and city
    dimensions, broadcast) and calendar expressions, priced per event."""
    r = _events_stream(spark, sf_dir).join(F.broadcast(city_dim(spark)), "city")
    r = r.withColumn("local_time", local_time(F.col("event_time"), F.col("timezone")))
    r = with_calendar(r.withColumn("local_date", F.to_date("local_time")), "local_date")
    return _sink_and_read(spark, expected_demand_columns(r), "expected")


@register("event_state_batch")
def q_event_state_batch(spark, sf_dir):
    """The keyed event state as a batch job over the whole calendar: one
    active special event per zone, taken greedily in start order."""
    from zonefare.operators.intervals import greedy_chain
    cal = DV.event_calendar(spark, sf_dir).select("zone_id", "event_id", "start_ms", "end_ms", "multiplier")
    return greedy_chain(cal, "zone_id", "start_ms", "end_ms", "event_id")
