"""The driver contract: entry runs, every oracle has a query, oracles agree."""

import os

import duckdb
import pandas as pd
import pytest

from conftest import SF001
import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "final_multiplier" in df.columns


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


def _digest(pdf):
    cols = sorted(pdf.columns)
    def norm(v):
        if v is None or (isinstance(v, float) and pd.isna(v)):
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, 9))
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if hasattr(v, "tolist"):
            return str(v.tolist())
        if isinstance(v, (list, tuple)):
            return str(list(v))
        return str(v)
    return len(pdf), cols, sorted("|".join(norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


@pytest.mark.parametrize("name", ["surge_by_zone_day", "zone_grid", "event_validation_split", "rolling_demand",
                                  "calendar_features", "weather_asof", "event_interval_join", "hybrid_price",
                                  "tier_distribution", "price_lookup_default", "dashboard_table"])
def test_matches_duckdb_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = E.queries()[name](spark, SF001)
    got = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    want = con.execute(E.oracle_sql()[name]).df()
    assert _digest(got) == _digest(want)


def test_flagship_golden_counts_sf001(spark):
    """Zone-days and events per rule level at sf0.01 (the blueprint's self-check)."""
    from conftest import SF01
    from pyspark.sql import functions as F
    df = E.queries()["surge_by_zone_day"](spark, SF01)
    got = {r.rule_multiplier: (r.zone_days, r.events) for r in
           df.groupBy("rule_multiplier").agg(F.count(F.lit(1)).alias("zone_days"),
                                             F.sum("demand_1min").alias("events")).collect()}
    assert got == {1.0: (231, 887), 1.2: (172, 963), 1.5: (386, 2777), 2.0: (530, 5373)}
