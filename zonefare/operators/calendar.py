"""Date dimension: holiday flags and days to the next holiday.

Built from the distinct dates a fact table needs (one row per calendar day
of its span, so its size is bounded by the span, not by the row count) and
joined back to facts on the date, a broadcast equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig
from zonefare.functions.timefeat import is_us_holiday


def holiday_table(candidate_dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Holidays among `candidate_dates` by the US federal rules.  Any other
    calendar can be passed instead as a one-column (holiday_date) table."""
    d = candidate_dates.select(F.col(date_col).alias("holiday_date")).distinct()
    return d.filter(is_us_holiday(F.col("holiday_date")))


def with_calendar(df: DataFrame, date_col: str, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """is_holiday, is_holiday_eve and days_to_next_holiday of a date column by the US federal rules.

    Expressions only: the facts are read once and nothing is joined.  A calendar
    given as a table goes through `date_dimension`.
    """
    d = F.col(date_col)
    near = F.transform(F.sequence(F.lit(0), F.lit(cfg.holiday_lookahead_days)),
                       lambda i: F.coalesce(is_us_holiday(F.date_add(d, i)), F.lit(False)))
    ahead = F.array_position(F.slice("__near", 2, cfg.holiday_lookahead_days), True)
    return df.withColumn("__near", near).withColumns({
        "is_holiday": F.col("__near")[0],
        "is_holiday_eve": ~F.col("__near")[0] & F.col("__near")[1],
        "days_to_next_holiday": F.when(ahead > 0, ahead).otherwise(cfg.holiday_lookahead_days).cast("int")}).drop("__near")


def date_dimension(dates: DataFrame, date_col: str = "date", holidays: DataFrame | None = None,
                   cfg: PricingConfig = DEFAULT) -> DataFrame:
    """date, is_holiday, is_holiday_eve, days_to_next_holiday for each date.

    Each date is fanned out to offsets 0..lookahead and equi-joined with the
    holiday table; days_to_next is the least positive matching offset
    (default: lookahead), so the range predicate never becomes a
    nested-loop join.
    """
    n = cfg.holiday_lookahead_days
    d = dates.select(F.col(date_col).alias("date")).distinct()
    fan = d.select("date", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("offset"))
    fan = fan.withColumn("cand", F.date_add(F.col("date"), F.col("offset")))
    if holidays is None:
        holidays = holiday_table(fan, "cand")
    # one row per holiday day; the table is small (about eleven a year)
    hit = fan.join(F.broadcast(holidays), fan["cand"] == holidays["holiday_date"], "left")
    is_hol = F.col("holiday_date").isNotNull()
    dim = hit.groupBy("date").agg(
        F.max(F.when(F.col("offset") == 0, is_hol)).alias("is_holiday"),
        F.max(F.when(F.col("offset") == 1, is_hol)).alias("_next_is_holiday"),
        F.min(F.when((F.col("offset") >= 1) & is_hol, F.col("offset"))).alias("_next"))
    return dim.select(
        "date", "is_holiday",
        (~F.col("is_holiday") & F.col("_next_is_holiday")).alias("is_holiday_eve"),
        F.coalesce(F.col("_next"), F.lit(n)).cast("int").alias("days_to_next_holiday"))
