"""Pricing configuration: one plain dataclass, passed to every builder.

Every number that decides a result lives here so callers can override it
(`PricingConfig(threshold_low=1.4)`), and so that Spark sees it as a literal
that Catalyst can constant-fold into the generated code.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class City:
    name: str
    latitude: float
    longitude: float
    timezone: str
    base_demand: int
    num_zones: int


# ---------------------------------------------------------------------------
# Fixed values. These must equal the published defaults of the pricing
# pipeline we match, otherwise prices and features differ.
# ---------------------------------------------------------------------------
DEFAULT_CITIES = (
    City("new_york", 40.7128, -74.0060, "America/New_York", 100, 20),
    City("san_francisco", 37.7749, -122.4194, "America/Los_Angeles", 70, 15),
    City("chicago", 41.8781, -87.6298, "America/Chicago", 80, 15),
)

# Surge rule table: demand/supply thresholds and the multiplier each unlocks.
RULE_THRESHOLDS = (1.5, 2.0, 3.0)
RULE_MULTIPLIERS = (1.2, 1.5, 2.0)
MULTIPLIER_MAX = 3.0
ML_CONFIDENCE_THRESHOLD = 0.7

# Surge tiers, lowest first, with their dashboard colours.
TIERS = ("normal", "low", "medium", "high", "maximum")
TIER_COLOURS = {
    "normal": "#2ecc71",
    "low": "#f1c40f",
    "medium": "#e67e22",
    "high": "#e74c3c",
    "maximum": "#8e44ad",
}

# WMO weather code -> severity 1..5 (codes not listed map to 1).
WMO_SEVERITY = {
    1: (0,),
    2: (1, 2, 3, 45, 48, 51, 52, 53),
    3: (55, 61, 62, 63, 80, 81),
    4: (64, 65, 71, 72, 73, 82),
    5: (74, 75, 95, 96, 99),
}

# Demand multiplier by weather severity (others 1.0).
WEATHER_DEMAND = {1: 1.0, 2: 1.1, 3: 1.5, 4: 1.9, 5: 2.3}

# Time-of-day demand multipliers, checked in this order.
LATE_NIGHT_HOURS = (22, 23, 0, 1, 2)
MORNING_RUSH_HOURS = (7, 8, 9)
EVENING_RUSH_HOURS = (17, 18, 19)
LUNCH_HOURS = (11, 12, 13)
DEAD_HOURS = (3, 4, 5)
TIME_DEMAND = {
    "late_night_weekend": 1.8,
    "late_night_weekday": 1.3,
    "morning_rush": 2.2,
    "evening_rush": 2.0,
    "lunch": 1.3,
    "dead": 0.3,
    "other": 1.0,
}

# Supply-side hour sets (they differ from the demand-side ones on purpose).
SUPPLY_NIGHT_HOURS = (22, 23, 0, 1, 2, 3)
SUPPLY_RUSH_HOURS = (7, 8, 9, 17, 18, 19)
SUPPLY_WEEKEND_NIGHT_HOURS = (21, 22, 23, 0, 1, 2)

# The 21 model features, in model order, with the fallback value of each.
FEATURE_DEFAULTS = (
    ("demand_last_1min", 0),
    ("demand_last_5min", 0),
    ("demand_last_15min", 0),
    ("demand_spike_factor", 1.0),
    ("available_drivers", 30),
    ("supply_ratio", 1.0),
    ("hour_of_day", 12),
    ("day_of_week", 0),
    ("is_weekend", False),
    ("is_rush_hour", False),
    ("is_late_night", False),
    ("is_lunch_hour", False),
    ("is_holiday", False),
    ("days_to_next_holiday", 7),
    ("temperature", 15.0),
    ("precipitation", 0.0),
    ("weather_severity", 1),
    ("historical_avg_demand", 20.0),
    ("historical_avg_surge", 1.0),
    ("is_special_event", False),
    ("event_demand_multiplier", 1.0),
)
FEATURE_COLUMNS = tuple(name for name, _ in FEATURE_DEFAULTS)

GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


@dataclass(frozen=True)
class PricingConfig:
    cities: tuple = DEFAULT_CITIES
    threshold_low: float = RULE_THRESHOLDS[0]
    threshold_medium: float = RULE_THRESHOLDS[1]
    threshold_high: float = RULE_THRESHOLDS[2]
    multiplier_low: float = RULE_MULTIPLIERS[0]
    multiplier_medium: float = RULE_MULTIPLIERS[1]
    multiplier_high: float = RULE_MULTIPLIERS[2]
    multiplier_max: float = MULTIPLIER_MAX
    confidence_threshold: float = ML_CONFIDENCE_THRESHOLD

    # supply model
    base_drivers_per_zone: int = 30
    rain_factor: float = 0.70
    heavy_rain_factor: float = 0.50
    snow_factor: float = 0.60
    late_night_factor: float = 0.50
    rush_hour_factor: float = 1.30
    weekend_night_factor: float = 0.65

    # holidays
    holiday_multiplier: float = 1.8
    holiday_eve_multiplier: float = 1.4
    holiday_lookahead_days: int = 7

    # windows (seconds) and watermark
    window_seconds: tuple = (60, 300, 900)
    slide_seconds: int = 10
    watermark_seconds: int = 120

    # time-to-live (seconds)
    surge_ttl_seconds: int = 120
    weather_ttl_seconds: int = 660
    history_retention_seconds: int = 604_800
    feature_retention_seconds: int = 2_592_000

    # stream source
    max_offsets_per_trigger: int = 5000
    trigger_seconds: int = 5

    # model
    training_min_samples: int = 1000
    gbt_max_iter: int = 200
    gbt_max_depth: int = 6
    gbt_step_size: float = 0.1
    gbt_subsampling_rate: float = 0.8
    gbt_feature_subset: str = "0.8"
    gbt_min_instances_per_node: int = 3
    seed: int = 42

    # batch lookups
    max_batch_ids: int = 100

    @property
    def num_zones(self) -> int:
        return sum(c.num_zones for c in self.cities)

    def validate(self) -> "PricingConfig":
        """Eager config checks: city bounds and rule-table monotonicity."""
        problems = []
        for c in self.cities:
            if not -90.0 <= c.latitude <= 90.0:
                problems.append(f"{c.name}: latitude out of range")
            if not -180.0 <= c.longitude <= 180.0:
                problems.append(f"{c.name}: longitude out of range")
            if c.base_demand < 1:
                problems.append(f"{c.name}: base_demand must be >= 1")
        th = (self.threshold_low, self.threshold_medium, self.threshold_high)
        mu = (self.multiplier_low, self.multiplier_medium, self.multiplier_high)
        if not all(a < b for a, b in zip(th, th[1:])):
            problems.append("thresholds must be strictly ascending")
        if not all(a < b for a, b in zip(mu, mu[1:])):
            problems.append("multipliers must be strictly ascending")
        if mu[-1] > self.multiplier_max:
            problems.append("multiplier_high must not exceed multiplier_max")
        if problems:
            raise ValueError("; ".join(problems))
        return self


DEFAULT = PricingConfig()
