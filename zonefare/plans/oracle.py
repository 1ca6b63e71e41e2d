"""DuckDB SQL twins of the registered queries (the correctness oracle).

These are written independently of the DataFrame code, in plain SQL over the
driver's tables; `WITH` blocks below rebuild the ride view and the zone
dimension from `events`.  Literals are cast to DOUBLE so both engines do the
same floating-point arithmetic, and float-to-int casts use trunc() because
DuckDB rounds where Spark truncates.
"""

from __future__ import annotations

from zonefare.config import DEFAULT, GEOHASH_ALPHABET, PricingConfig

D = "::DOUBLE"


def _city_case(cfg: PricingConfig, pick) -> str:
    parts, start = [], 0
    for c in cfg.cities:
        start += c.num_zones
        parts.append(f"WHEN zone_idx < {start} THEN {pick(c, start - c.num_zones)}")
    return "CASE " + " ".join(parts) + " END"


def _spread(x: str) -> str:
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = f"((({x}) << {shift}) | ({x})) & {mask}"
    return x


def geohash6_sql(lat: str, lon: str) -> str:
    latc = f"least(floor((({lat}) + 90.0{D}) / 180.0{D} * 32768.0{D})::BIGINT, 32767)"
    lonc = f"least(floor((({lon}) + 180.0{D}) / 360.0{D} * 32768.0{D})::BIGINT, 32767)"
    code = f"((({_spread(lonc)}) << 1) | ({_spread(latc)}))"
    chars = [f"substring('{GEOHASH_ALPHABET}', (({code} >> {25 - 5 * i}) & 31)::INT + 1, 1)"
             for i in range(6)]
    return " || ".join(chars)


def zones_cte(cfg: PricingConfig = DEFAULT) -> str:
    side = _city_case(cfg, lambda c, s0: str(int(c.num_zones ** 0.5) + 1))
    return f"""zones_raw AS (
  SELECT zone_idx,
         {_city_case(cfg, lambda c, s0: repr(c.name))} AS city,
         {_city_case(cfg, lambda c, s0: f'{c.latitude!r}{D}')} AS lat0,
         {_city_case(cfg, lambda c, s0: f'{c.longitude!r}{D}')} AS lon0,
         zone_idx - {_city_case(cfg, lambda c, s0: str(s0))} AS loc,
         {side} AS side
  FROM (SELECT range::INTEGER AS zone_idx FROM range({cfg.num_zones}))
), zones_grid AS (
  SELECT zone_idx, city,
         (loc // (2 * side) - side)::INTEGER AS grid_i,
         (loc % (2 * side) - side)::INTEGER AS grid_j,
         lat0 + (loc // (2 * side) - side)::DOUBLE * 0.01{D} AS latitude,
         lon0 + (loc % (2 * side) - side)::DOUBLE * 0.01{D} AS longitude
  FROM zones_raw
), zones AS (
  SELECT *, {geohash6_sql('latitude', 'longitude')} AS zone_id FROM zones_grid
)"""


def rides_cte(cfg: PricingConfig = DEFAULT) -> str:
    return zones_cte(cfg) + f""", ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), rides AS (
  SELECT CAST(ev.event_id AS VARCHAR) AS event_id, z.zone_idx, z.zone_id, z.city,
         z.latitude, z.longitude, epoch_us(ev.ts) // 1000 AS timestamp_ms, ev.ts AS event_time,
         (k % 8)::INTEGER AS available_drivers, (1 + (k // 8) % 5)::INTEGER AS weather_severity,
         floor(value)::INTEGER AS demand_count, k, event_type, value
  FROM ev JOIN zones z ON z.zone_idx = (ev.user_id + ev.k) % {cfg.num_zones}
)"""


def rule_sql(d: str, s: str, cfg: PricingConfig = DEFAULT) -> str:
    r = f"(({d})::DOUBLE / ({s})::DOUBLE)"
    return (f"least(CASE WHEN ({s}) <= 0 THEN {cfg.multiplier_max}{D} "
            f"WHEN {r} >= {cfg.threshold_high}{D} THEN {cfg.multiplier_high}{D} "
            f"WHEN {r} >= {cfg.threshold_medium}{D} THEN {cfg.multiplier_medium}{D} "
            f"WHEN {r} >= {cfg.threshold_low}{D} THEN {cfg.multiplier_low}{D} "
            f"ELSE 1.0{D} END, {cfg.multiplier_max}{D})")


def tier_sql(m: str, cfg: PricingConfig = DEFAULT) -> str:
    return (f"CASE WHEN ({m}) >= {cfg.multiplier_max}{D} THEN 'maximum' "
            f"WHEN ({m}) >= {cfg.multiplier_high}{D} THEN 'high' "
            f"WHEN ({m}) >= {cfg.multiplier_medium}{D} THEN 'medium' "
            f"WHEN ({m}) > 1.0{D} THEN 'low' ELSE 'normal' END")


def surge_cte(batch_expr: str, name: str = "surge", cfg: PricingConfig = DEFAULT) -> str:
    """Per-batch surge rows from `rides` (batch key column `batch`)."""
    return f""", {name}_agg AS (
  SELECT {batch_expr} AS batch, zone_id, city, count(event_id) AS demand_1min,
         trunc(avg(available_drivers))::INTEGER AS avg_drivers,
         trunc(avg(weather_severity))::INTEGER AS avg_severity
  FROM rides GROUP BY ALL
), {name} AS (
  SELECT batch, zone_id, city, demand_1min::BIGINT AS demand_1min,
         demand_1min::BIGINT * 5 AS demand_5min, demand_1min::BIGINT * 15 AS demand_15min,
         greatest(coalesce(avg_drivers, 1), 1)::INTEGER AS available_drivers,
         coalesce(avg_severity, 0)::INTEGER AS weather_severity,
         demand_1min::DOUBLE / greatest(coalesce(avg_drivers, 1), 1)::DOUBLE AS supply_ratio,
         {rule_sql('demand_1min', 'greatest(coalesce(avg_drivers, 1), 1)', cfg)} AS rule_multiplier
  FROM {name}_agg
)"""


def tz_sql(city: str, cfg: PricingConfig = DEFAULT) -> str:
    return "CASE " + " ".join(f"WHEN {city} = '{c.name}' THEN '{c.timezone}'" for c in cfg.cities) + " END"


def local_sql(ts: str, city: str, cfg: PricingConfig = DEFAULT) -> str:
    return f"((({ts}) AT TIME ZONE 'UTC') AT TIME ZONE ({tz_sql(city, cfg)}))"


def city_value_sql(city: str, attr: str, cfg: PricingConfig = DEFAULT) -> str:
    return "CASE " + " ".join(f"WHEN {city} = '{c.name}' THEN {getattr(c, attr)!r}"
                              for c in cfg.cities) + " END"


def _fixed_sql(d: str) -> str:
    from zonefare.functions.timefeat import FIXED_HOLIDAYS, JUNETEENTH_FROM
    parts = []
    for m, dd in FIXED_HOLIDAYS:
        c = f"(month({d}) = {m} AND day({d}) = {dd}"
        if (m, dd) == (6, 19):
            c += f" AND year({d}) >= {JUNETEENTH_FROM}"
        parts.append(c + ")")
    return "(" + " OR ".join(parts) + ")"


def holiday_sql(d: str) -> str:
    from zonefare.functions.timefeat import FLOATING_HOLIDAYS
    wd = f"(isodow({d}) - 1)"
    floating = " OR ".join(f"(month({d}) = {m} AND {wd} = {w} AND day({d}) BETWEEN {lo} AND {hi})"
                           for m, w, lo, hi in FLOATING_HOLIDAYS)
    observed = (f"({wd} = 4 AND {_fixed_sql(f'(({d}) + 1)')}) OR "
                f"({wd} = 0 AND {_fixed_sql(f'(({d}) - 1)')})")
    return f"({_fixed_sql(d)} OR {observed} OR {floating})"


def days_to_next_holiday_sql(d: str, lookahead: int = 7) -> str:
    return (f"coalesce((SELECT min(i) FROM range(1, {lookahead + 1}) t(i) "
            f"WHERE {holiday_sql(f'(({d}) + i::INTEGER)')}), {lookahead})::INTEGER")


def wmo_sql(code: str) -> str:
    from zonefare.config import WMO_SEVERITY
    return ("CASE " + " ".join(f"WHEN {code} IN ({', '.join(map(str, cs))}) THEN {s}"
                               for s, cs in WMO_SEVERITY.items()) + " ELSE 1 END")


def time_flags_sql(lt: str) -> dict[str, str]:
    h, d = f"hour({lt})", f"(isodow({lt}) - 1)"
    return {
        "hour_of_day": f"{h}::INTEGER",
        "day_of_week": f"{d}::INTEGER",
        "is_weekend": f"{d} >= 5",
        "is_rush_hour": f"(({h} BETWEEN 7 AND 9 OR {h} BETWEEN 17 AND 19) AND {d} < 5)",
        "is_late_night": f"{h} IN (22, 23, 0, 1, 2)",
        "is_lunch_hour": f"{h} BETWEEN 11 AND 13",
    }


def time_mult_sql(h: str, d: str) -> str:
    return (f"CASE WHEN {h} IN (22, 23, 0, 1, 2) THEN (CASE WHEN {d} >= 5 THEN 1.8 ELSE 1.3 END) "
            f"WHEN {h} IN (7, 8, 9) AND {d} < 5 THEN 2.2 "
            f"WHEN {h} IN (17, 18, 19) AND {d} < 5 THEN 2.0 "
            f"WHEN {h} IN (11, 12, 13) THEN 1.3 WHEN {h} IN (3, 4, 5) THEN 0.3 ELSE 1.0 END::DOUBLE")


def weather_mult_sql(s: str) -> str:
    from zonefare.config import WEATHER_DEMAND
    return ("CASE " + " ".join(f"WHEN {s} = {k} THEN {v}" for k, v in WEATHER_DEMAND.items())
            + " ELSE 1.0 END::DOUBLE")


def initcap_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")
