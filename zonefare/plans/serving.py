"""History, current view and the serving / dashboard look-ups (C1-C6).

The history table is the per-hour surge rows; the current view is the
latest row per zone (what the cache holds).  All look-ups are joins or
filters over these DataFrames, vectorised over every requested zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig
from zonefare.functions.features import (clip_prediction, confidence, label_multiplier,
                                         spike_factor, supply_ratio_feature)
from zonefare.functions.pricing import final_multiplier, surge_tier
from zonefare.functions.timefeat import city_timezone, local_time, time_features
from zonefare.model.compile import Ensemble, with_prediction
from zonefare.operators.aggregate import nonzero_mean, surge_rows, zone_demand_supply
from zonefare.operators.latest import latest_per_key, newest_n_per_key
from zonefare.operators.scan import blocks_for, checkpointed, in_blocks, last_known, running_sums
from zonefare.sources.rides import rides

HISTORY_COLUMNS = ("zone_id", "city", "timestamp", "demand_1min", "demand_5min", "demand_15min",
                   "available_drivers", "weather_severity", "supply_ratio", "rule_multiplier",
                   "ml_multiplier", "final_multiplier", "ml_confidence", "is_special_event")


def surge_history(spark: SparkSession, sf_dir: str, unit: str = "hour",
                  cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Surge rows per `unit` batch (hour / minute / day) keyed by batch start."""
    r = rides(spark, sf_dir, cfg)
    batch = (F.to_date("event_time").cast("timestamp") if unit == "day"
             else F.date_trunc(unit, "event_time"))
    agg = zone_demand_supply(r, batch.alias("timestamp"))
    return surge_rows(agg, cfg).select(*HISTORY_COLUMNS)


def current_view(history: DataFrame) -> DataFrame:
    """Latest history row per zone (ties: greater city), the cache content."""
    return latest_per_key(history, "zone_id", ["timestamp", "city"])


def current_as_of(history: DataFrame, as_of: str, ttl_seconds: int, batch_seconds: int,
                  ts: str = "timestamp") -> DataFrame:
    """Current view at instant `as_of` with the time-to-live applied at read
    time: rows are stamped `updated_at` = ts + batch_seconds, and a zone is
    fresh while as_of - updated_at < ttl."""
    upd = F.col(ts) + F.expr(f"INTERVAL {batch_seconds} SECONDS")
    h = history.withColumn("updated_at", upd).filter(F.col("updated_at") <= F.lit(as_of).cast("timestamp"))
    cur = latest_per_key(h, "zone_id", ["updated_at", "city"])
    age = (F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("updated_at"))
    return (cur.withColumn("age_seconds", age)
            .withColumn("is_fresh", F.col("age_seconds") < ttl_seconds))


def zone_history(history: DataFrame, n: int = 100) -> DataFrame:
    """Newest n rows per zone with the ISO timestamp (history look-up)."""
    top = newest_n_per_key(history, "zone_id", "timestamp", n)
    return top.select("zone_id", "city", "timestamp",
                      F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp_iso"),
                      "final_multiplier", "rule_multiplier", "ml_multiplier", "demand_1min", "rank")


def historical_baseline(history: DataFrame, n: int = 1000) -> DataFrame:
    """Per zone, over its newest n rows: mean of non-zero demand and surge,
    defaults 20.0 and 1.0."""
    top = newest_n_per_key(history, "zone_id", "timestamp", n)
    return top.groupBy("zone_id").agg(
        nonzero_mean(F.col("demand_1min"), 20.0).alias("avg_demand"),
        nonzero_mean(F.col("final_multiplier"), 1.0).alias("avg_surge"))


def with_local_time(df: DataFrame, ts: str, cfg: PricingConfig = DEFAULT) -> DataFrame:
    return df.withColumn("local_time", local_time(F.col(ts), city_timezone(F.col("city"), cfg)))


def feature_rows(history: DataFrame, baseline: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """The 21-feature vector per history row (city-local time features).

    Calendar features are expressions; the baseline has one row per zone and
    carries no hint, so AQE broadcasts it only when it is small.  Temperature,
    precipitation and the event's multiplier are taken from the history rows
    where they have them.
    """
    from zonefare.operators.calendar import with_calendar
    h = with_local_time(history, "timestamp", cfg).withColumn("local_date", F.to_date("local_time"))
    h = with_calendar(h, "local_date", cfg).join(baseline, "zone_id", "left")
    hist_d = F.coalesce(F.col("avg_demand"), F.lit(20.0))
    hist_s = F.coalesce(F.col("avg_surge"), F.lit(1.0))
    tf = time_features(F.col("local_time"))

    def given(name: str, default: float) -> Column:
        """A condition that the history rows carry, else its default."""
        return F.col(name) if name in history.columns else F.lit(default).alias(name)

    return h.select(
        "zone_id", "city", "timestamp", "rule_multiplier",
        F.col("demand_1min").alias("demand_last_1min"),
        F.col("demand_5min").alias("demand_last_5min"),
        F.col("demand_15min").alias("demand_last_15min"),
        spike_factor(F.col("demand_1min"), hist_d).alias("demand_spike_factor"),
        "available_drivers",
        supply_ratio_feature(F.col("available_drivers"), F.col("demand_1min")).alias("supply_ratio"),
        *[c.alias(n) for n, c in tf.items()],
        F.coalesce(F.col("is_holiday"), F.lit(False)).alias("is_holiday"),
        F.coalesce(F.col("days_to_next_holiday"), F.lit(cfg.holiday_lookahead_days)).alias("days_to_next_holiday"),
        given("temperature", 15.0), given("precipitation", 0.0),
        "weather_severity",
        F.round(hist_d, 2).alias("historical_avg_demand"),
        F.round(hist_s, 2).alias("historical_avg_surge"),
        F.col("is_special_event"), given("event_demand_multiplier", 1.0)).transform(fill_feature_defaults)


def fill_feature_defaults(df: DataFrame) -> DataFrame:
    """Replace a missing feature value by its fallback (the safe default row)."""
    from zonefare.config import FEATURE_DEFAULTS
    defaults = dict(FEATURE_DEFAULTS)
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])


def filter_city(df: DataFrame, city: str | None) -> DataFrame:
    """Dashboard city filter: everything for None / "All Cities"."""
    if city is None or city == "All Cities":
        return df
    return df.filter(F.col("city") == city)


def label_column(cfg: PricingConfig = DEFAULT) -> Column:
    return label_multiplier(F.col("demand_last_1min"), F.col("available_drivers"),
                            F.col("weather_severity"), F.col("is_rush_hour"),
                            F.col("event_demand_multiplier"), F.col("is_holiday"), cfg)


def hybrid_prices(features: DataFrame, prediction: Column, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Blend the rule price with a model prediction per zone row: clip and
    round the prediction, score its confidence, take max(rule, ml) when
    confident, cap, tier from the unrounded value."""
    ml = clip_prediction(prediction, cfg)
    f = (features.withColumn("ml_multiplier", ml)
         .withColumn("ml_confidence", confidence(F.col("demand_last_1min"),
                                                 F.col("historical_avg_demand"), F.col("ml_multiplier"))))
    fin = final_multiplier(F.col("rule_multiplier"), F.col("ml_multiplier"), F.col("ml_confidence"), cfg)
    return f.select("zone_id", "city", "timestamp", "rule_multiplier", "ml_multiplier",
                    "ml_confidence", F.round(fin, 2).alias("final_multiplier"),
                    surge_tier(fin, cfg).alias("surge_tier"))


PRICE_COLUMNS = ("zone_id", "city", "timestamp", "rule_multiplier", "ml_multiplier", "ml_confidence", "ml_available",
                 "final_multiplier", "surge_tier")


def live_prices(features: DataFrame, ensemble: Ensemble | None, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Hybrid price of every feature row: the model raises the rule price where its
    confidence reaches the gate (`cfg.confidence_threshold`).  Without a model every
    row has the rule price, prediction 1.0, confidence 0.0 and `ml_available` false."""
    if ensemble is None:
        ml, conf, scored = F.lit(1.0), F.lit(0.0), features
    else:
        scored = with_prediction(features, ensemble, "__raw")
        ml = clip_prediction(F.col("__raw"), cfg)
        conf = confidence(F.col("demand_last_1min"), F.col("historical_avg_demand"), F.col("ml_multiplier"))
    p = scored.withColumn("ml_multiplier", ml).withColumn("ml_confidence", conf)
    fin = final_multiplier(F.col("rule_multiplier"), F.col("ml_multiplier"), F.col("ml_confidence"), cfg)
    return p.select("zone_id", "city", "timestamp", "rule_multiplier", "ml_multiplier", "ml_confidence",
                    F.lit(ensemble is not None).alias("ml_available"),
                    F.round(fin, 2).alias("final_multiplier"), surge_tier(fin, cfg).alias("surge_tier"))


def price_all(history: DataFrame, as_of, ensemble: Ensemble | None, batch_seconds: int = 3600,
              cfg: PricingConfig = DEFAULT, ids: DataFrame | None = None) -> DataFrame:
    """Live price of every zone whose current row is within the surge time-to-live at
    `as_of`; with `ids` (a table of zone ids) of those zones only, absent ones left out."""
    cur = current_as_of(history, as_of, cfg.surge_ttl_seconds, batch_seconds).filter("is_fresh")
    if ids is not None:  # repeated ids are made one before the join
        cur = cur.join(ids.select("zone_id").distinct(), "zone_id", "left_semi")
    base = historical_baseline(history, 1000)
    return live_prices(feature_rows(cur.select(*HISTORY_COLUMNS), base, cfg), ensemble, cfg)


def price_requested(requests: DataFrame, prices: DataFrame) -> DataFrame:
    """One row per request: the zone's live price, or the default row for a zone without one."""
    from zonefare.operators.joins import lookup_with_default
    return lookup_with_default(requests, prices, "zone_id", {**default_price(), "ml_available": F.lit(False)})


def default_price() -> dict[str, Column]:
    """The row served for a zone without a current value."""
    return {
        "city": F.lit("unknown"),
        "final_multiplier": F.lit(1.0),
        "rule_multiplier": F.lit(1.0),
        "ml_multiplier": F.lit(1.0),
        "ml_confidence": F.lit(0.0),
        "surge_tier": F.lit("normal"),
    }


def dashboard_table(current: DataFrame) -> DataFrame:
    """Display rows, highest surge first (ties by zone id)."""
    city_disp = F.initcap(F.regexp_replace("city", "_", " "))
    key = F.concat(F.lit("surge:"), F.col("zone_id"))
    tier = surge_tier(F.col("final_multiplier"))
    return (current.select(
        "zone_id", city_disp.alias("city_display"),
        F.format_string("%.2fx", F.col("final_multiplier")).alias("multiplier_text"),
        "final_multiplier", "demand_1min", "available_drivers",
        F.upper(tier).alias("tier_label"),
        F.substring(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"), 1, 19).alias("updated"),
        key.alias("cache_key"),
        F.regexp_replace(key, "^surge:", "").alias("key_zone"),
        F.format_string("%s — %s — %s (%.2fx)", F.col("zone_id"), city_disp, F.upper(tier),
                        F.col("final_multiplier")).alias("zone_label"))
        .orderBy(F.desc("final_multiplier"), "zone_id"))


def history_series(history: DataFrame, rows_per_block: int = 100_000) -> DataFrame:
    """Per-zone multiplier series in time order with the change from the previous
    point (chart data).  A blocked scan: a zone with most rows is spread over many
    blocks, its point numbers and previous values are carried from block to block."""
    rows = history.select("zone_id", "city", "timestamp", "final_multiplier", "rule_multiplier", "ml_multiplier",
                          F.lit(1).cast("long").alias("__one"))
    stored = checkpointed(in_blocks(rows, ["zone_id", "timestamp", "city"], blocks_for(rows, rows_per_block)))
    counted = running_sums(stored, {"point": "__one"}, ["zone_id"], inclusive=True)
    known = last_known(counted, {"__previous": F.col("final_multiplier")}, ["zone_id"], inclusive=False)
    return known.select(
        "zone_id", "city", "timestamp", "final_multiplier", "rule_multiplier", "ml_multiplier",
        F.col("point").cast("int").alias("point"),
        F.round(F.col("final_multiplier") - F.col("__previous"), 6).alias("delta"))


def price_zones(spark: SparkSession, current: DataFrame, zone_ids: list[str],
                cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Batch look-up of 1..max_batch_ids zones: only zones with a current
    value are returned (semi-join against the requested ids)."""
    if not 1 <= len(zone_ids) <= cfg.max_batch_ids:
        raise ValueError(f"between 1 and {cfg.max_batch_ids} zone ids per request")
    ids = spark.createDataFrame([(z,) for z in dict.fromkeys(zone_ids)], "zone_id string")
    return current.join(F.broadcast(ids), "zone_id", "left_semi")


def price_zone(spark: SparkSession, current: DataFrame, zone_id: str) -> DataFrame:
    """Single look-up: always one row, the default row when the zone has no
    current value."""
    from zonefare.operators.joins import lookup_with_default
    ids = spark.createDataFrame([(zone_id,)], "zone_id string")
    cur = current.select("zone_id", "city", "final_multiplier", "rule_multiplier", "ml_multiplier",
                         "ml_confidence", surge_tier(F.col("final_multiplier")).alias("surge_tier"))
    return lookup_with_default(ids, cur, "zone_id", default_price())
