"""The oracle SQL per registered query (see plans.oracle for the shared CTEs)."""

from __future__ import annotations

from zonefare.model.compile import default_ensemble, sql_columns
from zonefare.plans.oracle import (city_value_sql, days_to_next_holiday_sql, geohash6_sql,
                                   holiday_sql, initcap_sql, local_sql, rides_cte, rule_sql,
                                   surge_cte, tier_sql, time_flags_sql, time_mult_sql,
                                   weather_mult_sql, wmo_sql)

D = "::DOUBLE"
ORACLE: dict[str, str] = {}

RIDES = f"WITH {rides_cte()}"
HOURLY = RIDES + surge_cte("date_trunc('hour', event_time)", "hourly")
CURRENT = HOURLY + """, cur AS (
  SELECT * FROM hourly
  QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY batch DESC, city DESC) = 1
)"""

ORACLE["surge_by_zone_day"] = f"""{RIDES}{surge_cte('CAST(event_time AS DATE)')}
SELECT strftime(batch, '%Y-%m-%d') AS batch_date, zone_id, city, demand_1min, demand_5min, demand_15min,
       available_drivers, weather_severity, supply_ratio, rule_multiplier,
       rule_multiplier AS ml_multiplier, rule_multiplier AS final_multiplier,
       0.0::DOUBLE AS ml_confidence, false AS is_special_event,
       {tier_sql('rule_multiplier')} AS surge_tier
FROM surge"""

# --- zones -------------------------------------------------------------------
ORACLE["zone_grid"] = f"""{RIDES}
SELECT z.zone_idx, z.zone_id, z.city, z.grid_i, z.grid_j, z.latitude, z.longitude, count(*) AS n_events
FROM rides r JOIN zones z ON r.zone_idx = z.zone_idx
GROUP BY z.zone_idx, z.zone_id, z.city, z.grid_i, z.grid_j, z.latitude, z.longitude"""

ORACLE["zone_collisions"] = f"""{RIDES}
SELECT zone_id, city, count(DISTINCT zone_idx) AS grid_points, count(*) AS n_events
FROM rides GROUP BY zone_id, city"""

ORACLE["zones_per_city"] = f"""{RIDES}
SELECT city, count(DISTINCT zone_idx) AS grid_zones, count(DISTINCT zone_id) AS distinct_zone_ids
FROM rides GROUP BY city"""

# --- validation --------------------------------------------------------------
REASON = """CASE WHEN event_type = 'error' AND k % 4 = 3 THEN 'unparsable'
     WHEN event_type = 'error' AND k % 4 = 0 THEN 'missing_zone_id'
     WHEN event_type = 'error' AND k % 4 = 1 THEN 'missing_timestamp_ms'
     WHEN event_type = 'purchase' AND k % 10 = 0 THEN 'null_zone_id'
     WHEN event_type = 'error' AND k % 4 = 2 THEN 'coordinates_out_of_range'
     ELSE 'valid' END"""

ORACLE["event_validation_split"] = f"""{RIDES}
SELECT reason AS failure_reason, count(*) AS n_events
FROM (SELECT {REASON} AS reason FROM rides) GROUP BY reason"""

ORACLE["dlq_records"] = f"""{RIDES}
SELECT event_id, reason AS failure_reason, timestamp_ms AS failed_at_ms, true AS dlq_ok
FROM (SELECT *, {REASON} AS reason FROM rides) WHERE reason <> 'valid'"""

ORACLE["event_json_roundtrip"] = f"""{RIDES}
SELECT zone_id, count(*) AS n_events, count(*) AS n_roundtrip_ok FROM rides GROUP BY zone_id"""

# --- windows -----------------------------------------------------------------
for _s in (60, 300, 900):
    ORACLE[f"demand_sliding_{_s}"] = f"""{RIDES}
SELECT epoch_ms((timestamp_ms // 10000 - g) * 10000) AS window_start,
       epoch_ms((timestamp_ms // 10000 - g) * 10000 + {_s * 1000}) AS window_end,
       zone_id, city, count(event_id) AS demand
FROM rides CROSS JOIN (SELECT range AS g FROM range({_s // 10})) t
GROUP BY ALL"""

ORACLE["rolling_demand"] = f"""{RIDES}
SELECT event_id, zone_id, timestamp_ms,
  count(event_id) OVER (PARTITION BY zone_id ORDER BY timestamp_ms RANGE BETWEEN 59999 PRECEDING AND CURRENT ROW) AS demand_60,
  count(event_id) OVER (PARTITION BY zone_id ORDER BY timestamp_ms RANGE BETWEEN 299999 PRECEDING AND CURRENT ROW) AS demand_300,
  count(event_id) OVER (PARTITION BY zone_id ORDER BY timestamp_ms RANGE BETWEEN 899999 PRECEDING AND CURRENT ROW) AS demand_900
FROM rides"""

# --- history / current -------------------------------------------------------
ORACLE["latest_surge_per_zone"] = f"""{CURRENT}
SELECT zone_id, city, batch AS timestamp, demand_1min, available_drivers, rule_multiplier,
       rule_multiplier AS final_multiplier, {tier_sql('rule_multiplier')} AS surge_tier
FROM cur"""

ORACLE["surge_freshness"] = f"""{RIDES}{surge_cte("date_trunc('minute', event_time)", 'minutely')}
, upd AS (
  SELECT *, batch + INTERVAL 60 SECOND AS updated_at FROM minutely
  WHERE batch + INTERVAL 60 SECOND <= TIMESTAMP '2024-01-16 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY batch + INTERVAL 60 SECOND DESC, city DESC) = 1
)
SELECT zone_id, city, updated_at, rule_multiplier AS final_multiplier,
       date_diff('second', updated_at, TIMESTAMP '2024-01-16 00:00:00') AS age_seconds,
       date_diff('second', updated_at, TIMESTAMP '2024-01-16 00:00:00') < 120 AS is_fresh
FROM upd"""

ORACLE["zone_history_topn"] = f"""{HOURLY}
SELECT zone_id, city, batch AS timestamp, strftime(batch, '%Y-%m-%dT%H:%M:%S') AS timestamp_iso,
       rule_multiplier AS final_multiplier, rule_multiplier, rule_multiplier AS ml_multiplier,
       demand_1min, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY batch DESC) AS rank FROM hourly)
WHERE rank <= 100"""

ORACLE["zone_history_lookup"] = f"""{HOURLY}, req AS (
  SELECT CASE WHEN k % 2 = 0 THEN zone_id ELSE {geohash6_sql('latitude + 0.05::DOUBLE', 'longitude')} END AS zone_id
  FROM rides WHERE event_type = 'view'
)
SELECT zone_id, city, batch AS timestamp, rule_multiplier AS final_multiplier, rule_multiplier, rule_multiplier AS ml_multiplier,
       demand_1min, row_number() OVER (ORDER BY batch DESC)::INTEGER AS rank
FROM hourly WHERE zone_id = (SELECT min(zone_id) FROM req WHERE zone_id IN (SELECT zone_id FROM hourly))
QUALIFY rank <= 100"""

ORACLE["retention_window"] = f"""{HOURLY}
SELECT zone_id, city, batch AS timestamp, rule_multiplier AS final_multiplier FROM hourly
WHERE batch > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 604800 SECOND
  AND batch <= TIMESTAMP '2024-01-20 00:00:00'"""

BASELINE = """, base AS (
  SELECT zone_id,
         coalesce(avg(CASE WHEN demand_1min <> 0 THEN demand_1min END), 20.0::DOUBLE) AS avg_demand,
         coalesce(avg(CASE WHEN rule_multiplier <> 0 THEN rule_multiplier END), 1.0::DOUBLE) AS avg_surge
  FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY batch DESC) AS rn FROM hourly)
  WHERE rn <= 1000 GROUP BY zone_id
)"""

ORACLE["historical_avg_coded"] = f"""{HOURLY}{BASELINE}
SELECT zone_id, round(avg_demand, 6) AS avg_demand, round(avg_surge, 6) AS avg_surge FROM base"""

ORACLE["historical_avg_by_hour"] = f"""{HOURLY}
SELECT zone_id, hour(lt)::INTEGER AS hour_of_day, (isodow(lt) - 1)::INTEGER AS day_of_week,
       round(coalesce(avg(CASE WHEN demand_1min <> 0 THEN demand_1min END), 20.0::DOUBLE), 6) AS avg_demand,
       round(coalesce(avg(CASE WHEN rule_multiplier <> 0 THEN rule_multiplier END), 1.0::DOUBLE), 6) AS avg_surge
FROM (SELECT *, {local_sql('batch', 'city')} AS lt FROM hourly)
GROUP BY ALL"""

# --- time / calendar / weather ---------------------------------------------
LOCAL_RIDES = RIDES + f""", lr AS (SELECT *, {local_sql('event_time', 'city')} AS lt FROM rides)"""
TF = time_flags_sql("lt")

ORACLE["time_features"] = f"""{LOCAL_RIDES}
SELECT event_id, city, lt AS local_time, {', '.join(f'{v} AS {k}' for k, v in TF.items())}
FROM lr"""

CITY_DATES = LOCAL_RIDES + """, cd AS (
  SELECT city, CAST(lt AS DATE) AS local_date, count(*) AS n_events FROM lr GROUP BY ALL
)"""

ORACLE["calendar_features"] = f"""{CITY_DATES}
SELECT city, strftime(local_date, '%Y-%m-%d') AS local_date, n_events, {holiday_sql('local_date')} AS is_holiday,
       {days_to_next_holiday_sql('local_date')} AS days_to_next_holiday
FROM cd"""

ORACLE["holiday_multiplier"] = f"""{CITY_DATES}
SELECT city, strftime(local_date, '%Y-%m-%d') AS local_date, h AS is_holiday, (NOT h AND e) AS is_holiday_eve,
       CASE WHEN h THEN 1.8 WHEN e THEN 1.4 ELSE 1.0 END::DOUBLE AS holiday_multiplier
FROM (SELECT *, {holiday_sql('local_date')} AS h, {holiday_sql('(local_date + 1)')} AS e FROM cd)"""

ORACLE["wmo_severity"] = f"""{RIDES}
SELECT event_id AS obs_id, city, k AS weathercode, {wmo_sql('k')} AS severity
FROM rides WHERE event_type = 'error'"""

ORACLE["hourly_precip_lookup"] = f"""{LOCAL_RIDES}
SELECT event_id AS obs_id, city, event_time AS updated_at, hour(lt)::INTEGER AS local_hour,
       CASE WHEN k % 7 <> 0 THEN value / 10.0{D} - 5.0{D} ELSE 15.0{D} END AS temperature,
       k{D} / 4.0{D} AS windspeed, k AS weathercode, {wmo_sql('k')} AS severity,
       CASE WHEN hour(lt) < 12 + k % 13 THEN ((k + hour(lt)) % 10){D} / 10.0{D} ELSE 0.0{D} END AS precipitation
FROM lr WHERE event_type = 'error'"""

ORACLE["demand_multipliers"] = f"""{LOCAL_RIDES}
SELECT city, hour_of_day, day_of_week, weather_severity, n_events,
       {time_mult_sql('hour_of_day', 'day_of_week')} AS time_multiplier,
       {weather_mult_sql('weather_severity')} AS weather_multiplier
FROM (SELECT city, hour(lt)::INTEGER AS hour_of_day, (isodow(lt) - 1)::INTEGER AS day_of_week,
             weather_severity, count(*) AS n_events FROM lr GROUP BY ALL)"""

_H, _W = "hour(lt)", "(isodow(lt) - 1)"
_SUPPLY = (f"greatest(1.0{D} * (CASE WHEN weather_severity = 3 THEN 0.7 WHEN weather_severity = 4 THEN 0.5 "
           f"WHEN weather_severity = 5 THEN 0.6 ELSE 1.0 END){D} "
           f"* (CASE WHEN {_H} IN (22, 23, 0, 1, 2, 3) THEN 0.5 "
           f"WHEN {_H} IN (7, 8, 9, 17, 18, 19) AND {_W} < 5 THEN 1.3 ELSE 1.0 END){D} "
           f"* (CASE WHEN {_W} >= 5 AND {_H} IN (21, 22, 23, 0, 1, 2) THEN 0.65 ELSE 1.0 END){D}, 0.1{D})")
_HOLM = (f"(CASE WHEN {holiday_sql('CAST(lt AS DATE)')} THEN 1.8 "
         f"WHEN {holiday_sql('(CAST(lt AS DATE) + 1)')} THEN 1.4 ELSE 1.0 END){D}")

ORACLE["expected_demand_supply"] = f"""{LOCAL_RIDES}
SELECT event_id, zone_id, city, sf AS supply_factor,
       greatest(1, trunc(({city_value_sql('city', 'base_demand')}){D} / ({city_value_sql('city', 'num_zones')}){D}
            * {time_mult_sql(_H, _W)} * {weather_mult_sql('weather_severity')} * 1.0{D} * {_HOLM})::INTEGER) AS expected_demand,
       greatest(1, trunc(30.0{D} * sf)::INTEGER) AS expected_supply
FROM (SELECT *, {_SUPPLY} AS sf FROM lr)"""

# --- joins -------------------------------------------------------------------
ORACLE["event_interval_join"] = f"""{RIDES}
, cal AS (
  SELECT event_id, zone_id, timestamp_ms AS start_ms,
         timestamp_ms + (60 + (k * 180) // 99)::BIGINT * 60000 AS end_ms,
         2.0{D} + k{D} / 50.0{D} AS multiplier
  FROM rides WHERE event_type = 'signup'
), seg AS (
  SELECT *, greatest(start_ms, coalesce(max(end_ms) OVER (PARTITION BY zone_id ORDER BY start_ms, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start_ms)) AS seg_start
  FROM cal
)
SELECT r.event_id, r.zone_id, s.event_id AS special_event_id, s.event_id IS NOT NULL AS is_special_event,
       coalesce(s.multiplier, 1.0{D}) AS event_demand_multiplier,
       CASE WHEN s.event_id IS NOT NULL THEN 1.5 ELSE 1.0 END{D} AS default_event_multiplier
FROM rides r LEFT JOIN (SELECT * FROM seg WHERE seg_start < end_ms) s
  ON r.zone_id = s.zone_id AND r.timestamp_ms >= s.seg_start AND r.timestamp_ms < s.end_ms"""

ORACLE["weather_asof"] = f"""{RIDES}
, obs AS (
  SELECT event_id AS obs_id, city, timestamp_ms AS t, k AS weathercode,
         CASE WHEN k % 7 <> 0 THEN value / 10.0{D} - 5.0{D} END AS temperature
  FROM rides WHERE event_type = 'error'
), m AS (
  SELECT r.event_id, r.city, o.obs_id, o.weathercode, o.temperature,
         row_number() OVER (PARTITION BY r.event_id ORDER BY o.t DESC NULLS LAST, o.obs_id DESC) AS rn
  FROM rides r LEFT JOIN obs o ON o.city = r.city AND o.t <= r.timestamp_ms AND r.timestamp_ms - o.t < 660000
)
SELECT event_id, city, obs_id, {wmo_sql('weathercode')} AS weather_severity,
       CASE WHEN obs_id IS NULL THEN 15.0{D} ELSE coalesce(temperature, 15.0{D}) END AS temperature
FROM m WHERE rn = 1"""

# --- features ----------------------------------------------------------------
FTF = time_flags_sql("lt")
FEATURES = HOURLY + BASELINE + f""", fin AS (
  SELECT h.*, {local_sql('h.batch', 'h.city')} AS lt,
         coalesce(b.avg_demand, 20.0{D}) AS hd, coalesce(b.avg_surge, 1.0{D}) AS hs
  FROM hourly h LEFT JOIN base b ON h.zone_id = b.zone_id
), feat AS (
  SELECT zone_id, city, batch AS timestamp, rule_multiplier,
         demand_1min AS demand_last_1min, demand_5min AS demand_last_5min, demand_15min AS demand_last_15min,
         round(CASE WHEN hd > 0 THEN demand_1min{D} / hd ELSE 1.0{D} END, 3) AS demand_spike_factor,
         available_drivers,
         round(CASE WHEN demand_1min > 0 THEN available_drivers{D} / demand_1min{D} ELSE available_drivers{D} END, 3) AS supply_ratio,
         {', '.join(f'{v} AS {k}' for k, v in FTF.items())},
         {holiday_sql('CAST(lt AS DATE)')} AS is_holiday,
         {days_to_next_holiday_sql('CAST(lt AS DATE)')} AS days_to_next_holiday,
         15.0{D} AS temperature, 0.0{D} AS precipitation, weather_severity,
         round(hd, 2) AS historical_avg_demand, round(hs, 2) AS historical_avg_surge,
         false AS is_special_event, 1.0{D} AS event_demand_multiplier
  FROM fin
)"""

FEATURE_LIST = ("demand_last_1min, demand_last_5min, demand_last_15min, demand_spike_factor, available_drivers, "
                "supply_ratio, hour_of_day, day_of_week, is_weekend, is_rush_hour, is_late_night, is_lunch_hour, "
                "is_holiday, days_to_next_holiday, temperature, precipitation, weather_severity, "
                "historical_avg_demand, historical_avg_surge, is_special_event, event_demand_multiplier")

ORACLE["feature_vector"] = f"""{FEATURES}
SELECT zone_id, city, timestamp, {FEATURE_LIST} FROM feat"""

# conditions at the end of the hour: newest weather of the city within 660 s, earliest event still running in the zone
ORACLE["feature_vector_conditions"] = f"""{FEATURES}
, obs AS (
  SELECT event_id AS obs_id, city, timestamp_ms AS t, k,
         CASE WHEN k % 7 <> 0 THEN value / 10.0{D} - 5.0{D} END AS temperature
  FROM rides WHERE event_type = 'error'
), cal AS (
  SELECT event_id, zone_id, timestamp_ms AS start_ms, timestamp_ms + (60 + (k * 180) // 99)::BIGINT * 60000 AS end_ms,
         2.0{D} + k{D} / 50.0{D} AS multiplier
  FROM rides WHERE event_type = 'signup'
), ends AS (SELECT *, epoch_ms(timestamp) + 3600000 AS e, hour({local_sql("timestamp + INTERVAL 3600 SECOND", "city")}) AS eh FROM feat
), w AS (
  SELECT f.*, o.obs_id, o.temperature AS seen, o.k AS wk
  FROM ends f LEFT JOIN obs o ON o.city = f.city AND o.t <= f.e AND f.e - o.t < 660000
  QUALIFY row_number() OVER (PARTITION BY f.zone_id, f.city, f.timestamp ORDER BY o.t DESC NULLS LAST, o.obs_id DESC) = 1
), evs AS (
  SELECT w.*, c.event_id AS special, c.multiplier
  FROM w LEFT JOIN cal c ON c.zone_id = w.zone_id AND c.start_ms <= w.e AND w.e < c.end_ms
  QUALIFY row_number() OVER (PARTITION BY w.zone_id, w.city, w.timestamp ORDER BY c.start_ms NULLS LAST, c.event_id) = 1
)
SELECT zone_id, city, timestamp, {FEATURE_LIST.replace('temperature, precipitation, weather_severity',
    f"coalesce(seen, 15.0{D}) AS temperature, CASE WHEN obs_id IS NOT NULL AND eh < 12 + wk % 13 THEN ((wk + eh) % 10){D} / 10.0{D} ELSE 0.0{D} END AS precipitation, weather_severity")
    .replace('is_special_event, event_demand_multiplier', f"special IS NOT NULL AS is_special_event, coalesce(multiplier, 1.0{D}) AS event_demand_multiplier")}
FROM evs"""

_R = f"(demand_last_1min{D} / (available_drivers{D} + 1.0{D}))"
LABEL = (f"least(greatest((CASE WHEN {_R} > 3 THEN 2.0 WHEN {_R} > 2 THEN 1.5 WHEN {_R} > 1.5 THEN 1.2 "
         f"ELSE 1.0 END){D} + (weather_severity{D} - 1.0{D}) * 0.15{D} + is_rush_hour::INTEGER{D} * 0.2{D} "
         f"+ (event_demand_multiplier - 1.0{D}) * 0.3{D} + is_holiday::INTEGER{D} * 0.3{D}, 1.0{D}), 3.0{D})")

ORACLE["label_formula"] = f"""{FEATURES}
SELECT zone_id, city, timestamp, {LABEL} AS actual_multiplier FROM feat"""

PRICED = FEATURES + f""", ml AS (
  SELECT *, round(least(greatest({LABEL}, 1.0{D}), 3.0{D}), 2) AS ml_multiplier FROM feat
), conf AS (
  SELECT *, round(least(1.0{D} * (CASE WHEN demand_last_1min = 0 THEN 0.5 ELSE 1.0 END){D}
                 * (CASE WHEN historical_avg_demand = 20.0 THEN 0.8 ELSE 1.0 END){D}
                 * (CASE WHEN ml_multiplier > 2.5 OR ml_multiplier < 1.0 THEN 0.7 ELSE 1.0 END){D}, 1.0{D}), 3)
           AS ml_confidence
  FROM ml
), priced AS (
  SELECT *, least(CASE WHEN ml_confidence >= 0.7 THEN greatest(rule_multiplier, ml_multiplier)
                       ELSE rule_multiplier END, 3.0{D}) AS fin FROM conf
)"""

ORACLE["confidence_score"] = f"""{PRICED}
SELECT zone_id, city, timestamp, ml_multiplier, ml_confidence FROM priced"""

ORACLE["hybrid_price"] = f"""{PRICED}
SELECT zone_id, city, timestamp, rule_multiplier, ml_multiplier, ml_confidence,
       round(fin, 2) AS final_multiplier, {tier_sql('fin')} AS surge_tier FROM priced"""

ORACLE["quality_range_checks"] = f"""{PRICED}
SELECT count(*) AS rows_checked,
       count(*) FILTER (WHERE round(fin, 2) < 1.0) AS final_below_1,
       count(*) FILTER (WHERE rule_multiplier < 1.0) AS rule_below_1,
       count(*) FILTER (WHERE ml_multiplier < 1.0) AS ml_below_1,
       count(*) FILTER (WHERE NOT (ml_confidence BETWEEN 0.0 AND 1.0)) AS confidence_out_of_range
FROM priced"""

ORACLE["median_impute"] = f"""{FEATURES}
SELECT {', '.join(f'median({c}{D})::DOUBLE AS median_{c}' for c in
                  ('demand_last_1min', 'demand_spike_factor', 'available_drivers', 'supply_ratio',
                   'hour_of_day', 'weather_severity', 'historical_avg_demand'))}
FROM feat"""

ORACLE["weather_imputed"] = f"""{RIDES}, obs AS (
  SELECT event_id AS obs_id, city, CASE WHEN k % 7 <> 0 THEN value / 10.0{D} - 5.0{D} END AS temperature
  FROM rides WHERE event_type = 'error')
SELECT obs_id, city, temperature IS NULL AS was_missing,
       coalesce(temperature, (SELECT median(temperature) FROM obs)) AS temperature
FROM obs"""

_SIDE = "CAST('0x' || substr(md5('42:' || zone_id || ':' || CAST(epoch_ms(timestamp) // 1000 AS BIGINT)), 1, 8) AS BIGINT) % 100 < 80"
_ZS = ("demand_last_1min", "available_drivers", "supply_ratio", "demand_spike_factor")
ORACLE["train_split_zscore"] = f"""{FEATURES}, sided AS (SELECT *, {_SIDE} AS is_train FROM feat),
fitted AS (SELECT {', '.join(f'avg({c}{D}) AS m_{c}, stddev_pop({c}{D}) AS s_{c}' for c in _ZS)} FROM sided WHERE is_train)
SELECT zone_id, city, timestamp, is_train,
       {', '.join(f'round(CASE WHEN s_{c} = 0 THEN 0 ELSE ({c}{D} - m_{c}) / s_{c} END, 6) AS z_{c}' for c in _ZS)}
FROM sided, fitted"""

ORACLE["feature_zscore"] = f"""{FEATURES}
SELECT zone_id, city, timestamp,
       {', '.join(f'round(({c}{D} - avg({c}{D}) OVER ()) / stddev_samp({c}{D}) OVER (), 6) AS z_{c}' for c in
                  ('demand_last_1min', 'available_drivers', 'supply_ratio', 'demand_spike_factor'))}
FROM feat"""

# --- live prices: the shipped ensemble over the features of the newest hour -------
_BOOLEANS = ("is_weekend", "is_rush_hour", "is_late_night", "is_lunch_hour", "is_holiday", "is_special_event")
_Z, _T, _SUM = sql_columns(default_ensemble(), _BOOLEANS)
LIVE = FEATURES + f""", newest AS (SELECT max(batch) AS t FROM hourly),
fresh AS (
  SELECT feat.* FROM feat, newest
  WHERE date_diff('second', timestamp + INTERVAL 3600 SECOND, t + INTERVAL 3660 SECOND) < 120
  QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY timestamp DESC, city DESC) = 1
), scaled AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in _Z.items())} FROM fresh
), grown AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in _T.items())} FROM scaled
), scored AS (SELECT *, round(least(greatest({_SUM}, 1.0{D}), 3.0{D}), 2) AS ml_multiplier FROM grown
), sure AS (
  SELECT *, round(least((CASE WHEN demand_last_1min = 0 THEN 0.5 ELSE 1.0 END){D}
                 * (CASE WHEN historical_avg_demand = 20.0 THEN 0.8 ELSE 1.0 END){D}
                 * (CASE WHEN ml_multiplier > 2.5 OR ml_multiplier < 1.0 THEN 0.7 ELSE 1.0 END){D}, 1.0{D}), 3) AS ml_confidence
  FROM scored
), blended AS (
  SELECT *, least(CASE WHEN ml_confidence >= 0.7 THEN greatest(rule_multiplier, ml_multiplier)
                       ELSE rule_multiplier END, 3.0{D}) AS fin FROM sure
), live AS (
  SELECT zone_id, city, timestamp, rule_multiplier, ml_multiplier, ml_confidence, true AS ml_available,
         round(fin, 2) AS final_multiplier, {tier_sql('fin')} AS surge_tier FROM blended
)"""

ORACLE["ensemble_metrics"] = f"""{FEATURES}, held AS (SELECT *, {LABEL} AS y FROM feat WHERE NOT ({_SIDE})
), scaled AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in _Z.items())} FROM held
), grown AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in _T.items())} FROM scaled
), scored AS (SELECT y, least(greatest({_SUM}, 1.0{D}), 3.0{D}) AS p FROM grown)
SELECT count(*) AS test_rows, round(avg(abs(y - p)), 4) AS mae,
       round(1.0{D} - sum((y - p) ** 2) / (sum(y * y) - sum(y) * sum(y) / count(*)), 4) AS r2
FROM scored"""

ORACLE["price_all"] = f"""{LIVE}
SELECT * FROM live"""

ORACLE["price_all_totals"] = f"""{LIVE}
SELECT count(*) AS total_zones, count(*) FILTER (WHERE round(final_multiplier, 2) > 1.0) AS surging_zones,
       round(coalesce(avg(final_multiplier), 1.0{D}), 6) AS avg_multiplier,
       coalesce(max(final_multiplier), 1.0{D}) AS max_multiplier
FROM live"""

# --- fleet / dashboard / look-ups ---------------------------------------------
ORACLE["fleet_summary"] = f"""{CURRENT}
SELECT count(*) AS total_zones, count(*) FILTER (WHERE round(rule_multiplier, 2) > 1.0) AS surging_zones,
       round(coalesce(avg(rule_multiplier), 1.0{D}), 6) AS avg_multiplier,
       coalesce(max(rule_multiplier), 1.0{D}) AS max_multiplier
FROM cur"""

ORACLE["fleet_summary_city"] = f"""{CURRENT}
SELECT city, count(*) AS total_zones, count(*) FILTER (WHERE round(rule_multiplier, 2) > 1.0) AS surging_zones,
       round(coalesce(avg(rule_multiplier), 1.0{D}), 6) AS avg_multiplier,
       coalesce(max(rule_multiplier), 1.0{D}) AS max_multiplier
FROM cur GROUP BY city"""

ORACLE["tier_distribution"] = f"""{CURRENT}
, tiers(tier_rank, surge_tier, colour) AS (VALUES (0, 'normal', '#2ecc71'), (1, 'low', '#f1c40f'),
    (2, 'medium', '#e67e22'), (3, 'high', '#e74c3c'), (4, 'maximum', '#8e44ad'))
, counts AS (SELECT {tier_sql('rule_multiplier')} AS surge_tier, count(*) AS zone_count FROM cur GROUP BY 1)
SELECT t.tier_rank::INTEGER AS tier_rank, t.surge_tier, t.colour, coalesce(c.zone_count, 0) AS zone_count
FROM tiers t LEFT JOIN counts c ON t.surge_tier = c.surge_tier"""

ORACLE["active_zones"] = f"""{CURRENT}
SELECT city, zone_id, count(*) OVER (PARTITION BY city) AS zone_count FROM cur"""

REQUESTS = f""", req AS (
  SELECT event_id AS request_id,
         CASE WHEN k % 2 = 0 THEN zone_id ELSE {geohash6_sql('latitude + 0.05::DOUBLE', 'longitude')} END AS zone_id
  FROM rides WHERE event_type = 'view'
)"""

ORACLE["price_batch_lookup"] = f"""{CURRENT}{REQUESTS}
SELECT zone_id, city, rule_multiplier AS final_multiplier, {tier_sql('rule_multiplier')} AS surge_tier
FROM cur WHERE zone_id IN (SELECT zone_id FROM req)"""

ORACLE["price_lookup_default"] = f"""{CURRENT}{REQUESTS}
SELECT r.request_id, r.zone_id, coalesce(c.city, 'unknown') AS city,
       coalesce(c.rule_multiplier, 1.0{D}) AS final_multiplier,
       coalesce(c.rule_multiplier, 1.0{D}) AS rule_multiplier,
       coalesce(c.rule_multiplier, 1.0{D}) AS ml_multiplier,
       CASE WHEN c.zone_id IS NULL THEN 0.0 ELSE 0.0 END{D} AS ml_confidence,
       coalesce({tier_sql('c.rule_multiplier')}, 'normal') AS surge_tier
FROM req r LEFT JOIN cur c ON r.zone_id = c.zone_id"""

ORACLE["price_list"] = f"""{LIVE}{REQUESTS}
SELECT * FROM live WHERE zone_id IN (SELECT zone_id FROM req)"""

ORACLE["price_one"] = f"""{LIVE}{REQUESTS}
SELECT r.request_id, r.zone_id, coalesce(c.city, 'unknown') AS city, c.timestamp,
       coalesce(c.rule_multiplier, 1.0{D}) AS rule_multiplier, coalesce(c.ml_multiplier, 1.0{D}) AS ml_multiplier,
       coalesce(c.ml_confidence, 0.0{D}) AS ml_confidence, coalesce(c.ml_available, false) AS ml_available,
       coalesce(c.final_multiplier, 1.0{D}) AS final_multiplier, coalesce(c.surge_tier, 'normal') AS surge_tier
FROM req r LEFT JOIN live c ON r.zone_id = c.zone_id"""

ORACLE["dashboard_table"] = f"""{CURRENT}
SELECT zone_id, cd AS city_display, printf('%.2fx', rule_multiplier) AS multiplier_text,
       rule_multiplier AS final_multiplier, demand_1min, available_drivers, upper(tier) AS tier_label,
       substring(strftime(batch, '%Y-%m-%dT%H:%M:%S'), 1, 19) AS updated,
       'surge:' || zone_id AS cache_key, regexp_replace('surge:' || zone_id, '^surge:', '') AS key_zone,
       printf('%s — %s — %s (%.2fx)', zone_id, cd, upper(tier), rule_multiplier) AS zone_label
FROM (SELECT *, {initcap_sql("replace(city, '_', ' ')")} AS cd, {tier_sql('rule_multiplier')} AS tier FROM cur)"""

# --- streaming (one file = one micro-batch under availableNow) ---------------
STREAM_AGG = RIDES + f""", valid AS (SELECT * FROM rides WHERE {REASON} = 'valid'),
sagg AS (
  SELECT zone_id, city, count(event_id) AS n, trunc(avg(available_drivers))::INTEGER AS d,
         trunc(avg(weather_severity))::INTEGER AS s, epoch_ms(max(timestamp_ms)) AS ts
  FROM valid GROUP BY ALL
), srow AS (
  SELECT zone_id, city, ts, n::BIGINT AS demand_1min, greatest(coalesce(d, 1), 1)::INTEGER AS drivers,
         coalesce(s, 0)::INTEGER AS severity,
         {rule_sql('n', 'greatest(coalesce(d, 1), 1)')} AS rule_multiplier
  FROM sagg
)"""

ORACLE["stream_surge_batches"] = f"""{STREAM_AGG}
SELECT zone_id, city, ts AS timestamp, demand_1min, demand_1min * 5 AS demand_5min,
       demand_1min * 15 AS demand_15min, drivers AS available_drivers, severity AS weather_severity,
       demand_1min{D} / drivers{D} AS supply_ratio, rule_multiplier, rule_multiplier AS ml_multiplier,
       rule_multiplier AS final_multiplier, 0.0{D} AS ml_confidence, false AS is_special_event
FROM srow"""

ORACLE["stream_current_view"] = f"""{STREAM_AGG}
SELECT zone_id, city, ts AS updated_at, demand_1min, rule_multiplier, rule_multiplier AS final_multiplier,
       {tier_sql('rule_multiplier')} AS surge_tier
FROM srow"""

ORACLE["stream_dead_letters"] = f"""{RIDES}
SELECT event_id, reason AS failure_reason, timestamp_ms AS failed_at_ms
FROM (SELECT *, {REASON} AS reason FROM rides) WHERE reason <> 'valid'"""

ORACLE["stream_sliding_demand"] = f"""{RIDES}
SELECT * FROM (
  SELECT epoch_ms((timestamp_ms // 10000 - g) * 10000) AS window_start,
         epoch_ms((timestamp_ms // 10000 - g) * 10000 + 60000) AS window_end,
         zone_id, city, count(event_id) AS demand
  FROM rides CROSS JOIN (SELECT range AS g FROM range(6)) t
  GROUP BY ALL)
WHERE window_end <= (SELECT max(event_time) FROM rides) - INTERVAL 120 SECOND"""

SLICES = f"""{RIDES}, span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
sliced AS (SELECT rides.*, (epoch_us(event_time) - lo) * 4 // (hi - lo + 1) AS slice FROM rides, span)"""

# the second slice arrives after the third; a batch is judged by the newest event of the batches before it
ORACLE["stream_late_rows"] = f"""{SLICES}, arrived AS (
  SELECT *, CASE slice WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE slice END::BIGINT AS batch_id FROM sliced
), newest AS (
  SELECT batch_id, max(max(event_time)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM arrived GROUP BY batch_id
)
SELECT event_id, zone_id, event_time, batch_id, coalesce(event_time < seen - INTERVAL 120 SECOND, false) AS is_late
FROM arrived JOIN newest USING (batch_id)"""

STREAM_REPLAY = SLICES + f""", valid AS (SELECT * FROM sliced WHERE {REASON} = 'valid'),
sagg AS (
  SELECT slice, zone_id, city, count(event_id) AS n, trunc(avg(available_drivers))::INTEGER AS d,
         trunc(avg(weather_severity))::INTEGER AS s, epoch_ms(max(timestamp_ms)) AS ts
  FROM valid GROUP BY ALL
), srow AS (
  SELECT slice, zone_id, city, ts, n::BIGINT AS demand_1min, greatest(coalesce(d, 1), 1)::INTEGER AS drivers,
         coalesce(s, 0)::INTEGER AS severity,
         {rule_sql('n', 'greatest(coalesce(d, 1), 1)')} AS rule_multiplier
  FROM sagg
)"""

ORACLE["stream_surge_replay"] = f"""{STREAM_REPLAY}
SELECT slice::BIGINT AS batch_id, zone_id, city, ts AS timestamp, demand_1min, demand_1min * 5 AS demand_5min,
       demand_1min * 15 AS demand_15min, drivers AS available_drivers, severity AS weather_severity,
       demand_1min{D} / drivers{D} AS supply_ratio, rule_multiplier, rule_multiplier AS ml_multiplier,
       rule_multiplier AS final_multiplier, 0.0{D} AS ml_confidence, false AS is_special_event
FROM srow"""

ORACLE["stream_batch_ledger"] = f"""{STREAM_REPLAY}
SELECT slice::BIGINT AS batch_id, count(*) AS payloads, count(*) FILTER ({REASON} = 'valid') AS valid,
       count(*) FILTER ({REASON} <> 'valid') AS failed, 0::BIGINT AS late,
       (SELECT count(*) FROM srow WHERE srow.slice = sliced.slice) AS zones,
       count(*) FILTER ({REASON} <> 'valid') AS dead_letters
FROM sliced GROUP BY slice"""

for _s in (60, 300, 900):
    ORACLE[f"stream_windows_{_s}"] = ORACLE[f"demand_sliding_{_s}"]

ORACLE["stream_weather_versions"] = f"""{RIDES}
SELECT event_id AS obs_id, city, {wmo_sql('k')} AS severity, CASE WHEN k % 7 <> 0 THEN value / 10.0{D} - 5.0{D} END AS temperature,
       event_time AS valid_from,
       least(coalesce(lag(event_time) OVER (PARTITION BY city ORDER BY event_time DESC, event_id),
                      event_time + INTERVAL 660 SECOND), event_time + INTERVAL 660 SECOND) AS valid_to
FROM rides WHERE event_type = 'error'"""

ORACLE["stream_ride_events"] = f"""{RIDES}, cal AS (
  SELECT event_id, zone_id, timestamp_ms AS start_ms, timestamp_ms + (60 + (k * 180) // 99)::BIGINT * 60000 AS end_ms,
         2.0{D} + k{D} / 50.0{D} AS multiplier
  FROM rides WHERE event_type = 'signup')
SELECT r.event_id, r.zone_id, c.event_id AS special_event_id, c.multiplier
FROM rides r JOIN cal c ON c.zone_id = r.zone_id AND r.event_time >= epoch_ms(c.start_ms) AND r.event_time < epoch_ms(c.end_ms)"""

ORACLE["stream_dedup"] = f"""{RIDES}
SELECT event_id, zone_id, event_time FROM rides"""

ORACLE["latest_features_per_zone"] = f"""{FEATURES}
, st AS (
  SELECT *, timestamp + INTERVAL 3600 SECOND AS stored_at FROM feat
  WHERE timestamp + INTERVAL 3600 SECOND <= TIMESTAMP '2024-01-20 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY timestamp + INTERVAL 3600 SECOND DESC, city DESC) = 1
)
SELECT zone_id, city, stored_at, demand_last_1min, demand_spike_factor, available_drivers, supply_ratio,
       hour_of_day, is_holiday, historical_avg_demand,
       date_diff('second', stored_at, TIMESTAMP '2024-01-20 00:00:00') AS age_seconds,
       date_diff('second', stored_at, TIMESTAMP '2024-01-20 00:00:00') < 240 AS is_fresh
FROM st"""

ORACLE["zone_history_series"] = f"""{HOURLY}
SELECT zone_id, city, batch AS timestamp, rule_multiplier AS final_multiplier, rule_multiplier,
       rule_multiplier AS ml_multiplier,
       row_number() OVER (PARTITION BY zone_id ORDER BY batch)::INTEGER AS point,
       round(rule_multiplier - lag(rule_multiplier) OVER (PARTITION BY zone_id ORDER BY batch), 6) AS delta
FROM hourly"""

ORACLE["surge_by_zone_hour"] = f"""{RIDES}{surge_cte("date_trunc('hour', event_time)")}
SELECT batch AS batch_hour, zone_id, city, demand_1min, demand_5min, demand_15min,
       available_drivers, weather_severity, supply_ratio, rule_multiplier,
       rule_multiplier AS ml_multiplier, rule_multiplier AS final_multiplier,
       0.0::DOUBLE AS ml_confidence, false AS is_special_event,
       {tier_sql('rule_multiplier')} AS surge_tier
FROM surge"""

ORACLE["stream_expected_demand"] = ORACLE["expected_demand_supply"]

# one special event per zone at a time, taken greedily in start order
ORACLE["stream_event_state"] = f"""WITH RECURSIVE {rides_cte()}
, cal AS (
  SELECT zone_id, event_id, timestamp_ms AS start_ms,
         timestamp_ms + (60 + (k * 180) // 99)::BIGINT * 60000 AS end_ms,
         2.0{D} + k{D} / 50.0{D} AS multiplier
  FROM rides WHERE event_type = 'signup'
), acc AS (
  SELECT * FROM cal QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY start_ms, event_id) = 1
  UNION ALL
  SELECT n.zone_id, n.event_id, n.start_ms, n.end_ms, n.multiplier
  FROM acc a, LATERAL (
    SELECT * FROM cal c WHERE c.zone_id = a.zone_id AND c.start_ms >= a.end_ms
    ORDER BY c.start_ms, c.event_id LIMIT 1) n
)
SELECT zone_id, event_id, start_ms, end_ms, multiplier FROM acc"""

ORACLE["event_state_batch"] = ORACLE["stream_event_state"]
