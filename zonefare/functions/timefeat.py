"""Local-time and calendar features of an event time (UTC instant)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonefare.config import (DEFAULT, DEAD_HOURS, EVENING_RUSH_HOURS, LATE_NIGHT_HOURS,
                             LUNCH_HOURS, MORNING_RUSH_HOURS, TIME_DEMAND, PricingConfig)


def city_timezone(city: Column, cfg: PricingConfig = DEFAULT) -> Column:
    tz = None
    for c in cfg.cities:
        tz = (F.when(city == c.name, c.timezone) if tz is None
              else tz.when(city == c.name, c.timezone))
    return tz


def local_time(ts: Column, tz: Column) -> Column:
    """Wall-clock time in `tz` of a UTC instant (session time zone is UTC)."""
    return F.from_utc_timestamp(ts, tz)


def hour_of_day(local: Column) -> Column:
    return F.hour(local)


def day_of_week(local: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(local)


def is_weekend(dow: Column) -> Column:
    return dow >= 5


def is_rush_hour(hour: Column, dow: Column) -> Column:
    return (hour.between(7, 9) | hour.between(17, 19)) & (dow < 5)


def is_late_night(hour: Column) -> Column:
    return hour.isin(*LATE_NIGHT_HOURS)


def is_lunch_hour(hour: Column) -> Column:
    return hour.between(11, 13)


def time_features(local: Column) -> dict[str, Column]:
    h, d = hour_of_day(local), day_of_week(local)
    return {
        "hour_of_day": h,
        "day_of_week": d,
        "is_weekend": is_weekend(d),
        "is_rush_hour": is_rush_hour(h, d),
        "is_late_night": is_late_night(h),
        "is_lunch_hour": is_lunch_hour(h),
    }


def time_demand_multiplier(hour: Column, dow: Column) -> Column:
    """Demand by time of day; the first matching rule wins."""
    weekend, m = dow >= 5, TIME_DEMAND
    return (F.when(hour.isin(*LATE_NIGHT_HOURS),
                   F.when(weekend, m["late_night_weekend"]).otherwise(m["late_night_weekday"]))
            .when(hour.isin(*MORNING_RUSH_HOURS) & ~weekend, m["morning_rush"])
            .when(hour.isin(*EVENING_RUSH_HOURS) & ~weekend, m["evening_rush"])
            .when(hour.isin(*LUNCH_HOURS), m["lunch"])
            .when(hour.isin(*DEAD_HOURS), m["dead"])
            .otherwise(m["other"]))


def iso_format(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def parse_iso(text: Column) -> Column:
    """ISO-8601 local date-time text (optional fraction) -> timestamp; null
    when the text does not parse."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
                      F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")))


# --- US federal holidays by rule -------------------------------------------
# Fixed dates move to Friday when they fall on Saturday and to Monday when
# they fall on Sunday; the others are the n-th (or last) weekday of a month.
FIXED_HOLIDAYS = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))
JUNETEENTH_FROM = 2021
# (month, weekday Monday=0, first day, last day) of the floating holidays
FLOATING_HOLIDAYS = (
    (1, 0, 15, 21),   # third Monday of January
    (2, 0, 15, 21),   # third Monday of February
    (5, 0, 25, 31),   # last Monday of May
    (9, 0, 1, 7),     # first Monday of September
    (10, 0, 8, 14),   # second Monday of October
    (11, 3, 22, 28),  # fourth Thursday of November
)


def _fixed(d: Column) -> Column:
    m, dd, y = F.month(d), F.dayofmonth(d), F.year(d)
    cond = F.lit(False)
    for mo, da in FIXED_HOLIDAYS:
        c = (m == mo) & (dd == da)
        if (mo, da) == (6, 19):
            c = c & (y >= JUNETEENTH_FROM)
        cond = cond | c
    return cond


def is_us_holiday(d: Column) -> Column:
    """True when date `d` is a US federal holiday or its observed day."""
    wd = F.weekday(d)
    observed = (((wd == 4) & _fixed(F.date_add(d, 1)))
                | ((wd == 0) & _fixed(F.date_sub(d, 1))))
    floating = F.lit(False)
    for mo, wk, lo, hi in FLOATING_HOLIDAYS:
        floating = floating | ((F.month(d) == mo) & (wd == wk) & F.dayofmonth(d).between(lo, hi))
    return _fixed(d) | observed | floating
