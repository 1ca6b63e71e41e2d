"""Rule price, blend and tier: the reference's unit cases as DataFrame rows."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from zonefare.functions.pricing import clamp_drivers, final_multiplier, rule_multiplier, surge_tier

RULE_CASES = [  # demand, supply, expected
    (10, 30, 1.0), (45, 30, 1.2), (70, 30, 1.5), (100, 30, 2.0),
    (100, 0, 3.0), (0, 30, 1.0), (30, 30, 1.0),
]


def test_rule_multiplier_cases(spark):
    df = spark.createDataFrame(RULE_CASES, "d int, s int, want double")
    got = df.select("want", rule_multiplier(F.col("d"), F.col("s")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_rule_multiplier_capped(spark):
    v = spark.range(1).select(rule_multiplier(F.lit(10000), F.lit(1)).alias("m")).first().m
    assert v <= 3.0


def test_negative_supply_is_max(spark):
    v = spark.range(1).select(rule_multiplier(F.lit(5), F.lit(-2)).alias("m")).first().m
    assert v == 3.0


FINAL_CASES = [  # rule, ml, confidence, expected (None = only the cap is checked)
    (1.5, 1.8, 0.95, 1.8), (1.5, 1.8, 0.3, 1.5), (2.0, 0.8, 0.95, 2.0), (3.0, 5.0, 0.99, None),
]


def test_final_multiplier_cases(spark):
    df = spark.createDataFrame(FINAL_CASES, "r double, m double, c double, want double")
    rows = df.select("want", final_multiplier(F.col("r"), F.col("m"), F.col("c")).alias("got")).collect()
    for r in rows:
        assert r.got <= 3.0
        if r.want is not None:
            assert r.got == pytest.approx(r.want)


def test_tiers(spark):
    cases = [(1.0, "normal"), (1.2, "low"), (1.5, "medium"), (2.0, "high"), (3.0, "maximum")]
    df = spark.createDataFrame(cases, "m double, want string")
    assert all(r.got == r.want for r in df.select("want", surge_tier(F.col("m")).alias("got")).collect())


def test_driver_clamp(spark):
    df = spark.createDataFrame([(None,), (0,), (-3,), (7,)], "d int")
    assert [r.c for r in df.select(clamp_drivers(F.col("d")).alias("c")).collect()] == [1, 1, 1, 7]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.floats(1.0, 3.0), st.floats(0.0, 6.0), st.floats(0.0, 1.0)),
                min_size=1, max_size=30))
def test_blend_properties(spark, rows):
    """final >= rule, 1 <= final <= 3, tier monotone in the multiplier."""
    df = spark.createDataFrame(rows, "r double, m double, c double")
    out = df.select("r", final_multiplier(F.col("r"), F.col("m"), F.col("c")).alias("f")).collect()
    for x in out:
        assert x.f >= min(x.r, 3.0) - 1e-12 and 1.0 <= x.f <= 3.0
    order = ["normal", "low", "medium", "high", "maximum"]
    t = (df.select(F.col("m"), surge_tier(F.col("m")).alias("t")).orderBy("m").collect())
    ranks = [order.index(x.t) for x in t]
    assert ranks == sorted(ranks)


def test_sql_functions_match_columns(spark):
    from zonefare.functions.sql import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame(RULE_CASES, "d int, s int, want double")
    df.createOrReplaceTempView("rule_cases")
    got = spark.sql("SELECT want, surge_rule_multiplier(d, s) AS got, surge_tier(surge_rule_multiplier(d, s)) AS t "
                    "FROM rule_cases").collect()
    assert all(r.got == r.want for r in got)
    assert spark.sql("SELECT wmo_severity(95) AS s, surge_final_multiplier(1.5, 1.8, 0.95) AS f").first() == (5, 1.8)
