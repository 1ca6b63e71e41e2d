"""Operators checked against brute force on small inputs."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from zonefare.operators.joins import asof_join, interval_lookup, winner_segments
from zonefare.operators.latest import latest_per_key, newest_n_per_key
from zonefare.operators.windows import sliding_demand, trailing_counts
from zonefare.sources import derived as DV
from zonefare.sources.rides import rides, zone_dim


def test_zone_dimension(spark):
    z = zone_dim(spark).toPandas()
    assert len(z) == 50 and z.zone_id.nunique() == 44
    assert z.groupby("city").zone_id.nunique().to_dict() == {"new_york": 18, "san_francisco": 13, "chicago": 13}
    # the grid starts at offset -side, so no city centre is itself a zone
    assert not ((z.grid_i == 0) & (z.grid_j == 0)).any()


def test_geohash_known_points(spark):
    from zonefare.functions.geo import geohash, with_geohash
    pts = [(40.7128, -74.0060, "dr5reg"), (37.7749, -122.4194, "9q8yyk"), (41.8781, -87.6298, "dp3wjz"),
           (0.0, 0.0, "s00000"), (-33.8688, 151.2093, "r3gx2f")]
    df = spark.createDataFrame(pts, "lat double, lon double, want string")
    a = df.select("want", geohash(F.col("lat"), F.col("lon")).alias("g")).collect()
    b = with_geohash(df, "lat", "lon", "g").collect()
    assert all(r.g == r.want for r in a) and all(r.g == r.want for r in b)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 3, "x", 2.0), ("a", 3, "y", 5.0), ("b", 2, "x", 9.0)],
                               "k string, t int, c string, v double")
    got = {r.k: (r.t, r.c, r.v) for r in latest_per_key(df, "k", ["t", "c"]).collect()}
    assert got == {"a": (3, "y", 5.0), "b": (2, "x", 9.0)}


def test_newest_n(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    got = newest_n_per_key(df, "k", "t", 2).groupBy("k").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    assert {r.k: r.ts for r in got.collect()} == {0: [6, 8], 1: [7, 9]}


def _rides_pd(spark):
    return rides(spark, SF001, extra=("k", "event_type")).toPandas()


@pytest.mark.parametrize("bucket_s", [100, 600, 3600])
def test_trailing_counts_brute_force(spark, bucket_s):
    """Buckets shorter and longer than the windows: counts must be exact."""
    import numpy as np
    r = rides(spark, SF01)
    got = trailing_counts(r, (60, 300, 900), bucket_s=bucket_s).toPandas().set_index("event_id")
    p = r.select("event_id", "zone_id", "timestamp_ms").toPandas()
    for w in (60, 300, 900):
        want = {}
        for _, g in p.groupby("zone_id"):
            t = np.sort(g.timestamp_ms.values)
            hi = np.searchsorted(t, g.timestamp_ms.values, side="right")
            lo = np.searchsorted(t, g.timestamp_ms.values - w * 1000, side="right")
            want.update(dict(zip(g.event_id, (hi - lo).tolist())))
        assert got[f"demand_{w}"].to_dict() == want
    assert (got["demand_900"] > 1).sum() > 0  # the data does exercise multi-event windows


def test_sliding_equals_builtin_window(spark):
    r = rides(spark, SF001)
    a = sliding_demand(r, 300, 10)
    b = (r.groupBy(F.window("event_time", "300 seconds", "10 seconds").alias("w"), "zone_id", "city")
         .agg(F.count("event_id").alias("demand"))
         .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 "zone_id", "city", "demand"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_asof_join_brute_force(spark):
    w = DV.weather_obs(spark, SF001).select("obs_id", "city", "updated_at_ms", "weathercode")
    r = rides(spark, SF001).select("event_id", "city", "timestamp_ms")
    tol = 3 * 3_600_000
    got = asof_join(r, w, "city", "timestamp_ms", "updated_at_ms", ["obs_id"], tol,
                    bucket_ms=4 * 3_600_000, tie="obs_id").toPandas().set_index("event_id").obs_id.to_dict()
    wp, rp = w.toPandas(), r.toPandas()
    for row in rp.itertuples():
        c = wp[(wp.city == row.city) & (wp.updated_at_ms <= row.timestamp_ms)
               & (row.timestamp_ms - wp.updated_at_ms < tol)]
        want = None if c.empty else c.sort_values(["updated_at_ms", "obs_id"]).obs_id.iloc[-1]
        assert got[row.event_id] == want


def test_interval_join_brute_force(spark):
    cal = DV.event_calendar(spark, SF001)
    segs = winner_segments(cal)
    r = rides(spark, SF001).select("event_id", "zone_id", "timestamp_ms")
    got = interval_lookup(r, segs.withColumnRenamed("event_id", "sid"), "zone_id", "timestamp_ms", ["sid"])
    got = got.toPandas().set_index("event_id").sid.to_dict()
    cp, rp = cal.toPandas(), r.toPandas()
    for row in rp.itertuples():
        act = cp[(cp.zone_id == row.zone_id) & (cp.start_ms <= row.timestamp_ms) & (cp.end_ms > row.timestamp_ms)]
        want = None if act.empty else act.sort_values(["start_ms", "event_id"]).event_id.iloc[0]
        assert got[row.event_id] == want


def test_date_dimension(spark):
    from zonefare.operators.calendar import date_dimension
    d = spark.createDataFrame([("2024-01-01",), ("2024-01-08",), ("2024-01-12",), ("2024-01-14",), ("2024-01-30",)],
                              "d string").select(F.col("d").cast("date").alias("d"))
    got = {str(r.date): (r.is_holiday, r.is_holiday_eve, r.days_to_next_holiday)
           for r in date_dimension(d, "d").collect()}
    assert got == {"2024-01-01": (True, False, 7), "2024-01-08": (False, False, 7),
                   "2024-01-12": (False, False, 3), "2024-01-14": (False, True, 1),
                   "2024-01-30": (False, False, 7)}


def test_price_zone_lookups(spark):
    from zonefare.plans import serving as S
    cur = S.current_view(S.surge_history(spark, SF001, "hour"))
    known = cur.select("zone_id").first().zone_id
    one = S.price_zone(spark, cur, "zzzzzz").collect()
    assert len(one) == 1 and one[0].city == "unknown" and one[0].surge_tier == "normal"
    assert S.price_zones(spark, cur, [known, "zzzzzz", known]).count() == 1
    with pytest.raises(ValueError):
        S.price_zones(spark, cur, [])
    with pytest.raises(ValueError):
        S.price_zones(spark, cur, [str(i) for i in range(101)])


@pytest.mark.parametrize("duration,span", [(900, 900), (60, 60), (300, 3600)])
def test_sliding_small_spans(spark, duration, span):
    """Span edges everywhere: the context copies must make every window whole."""
    r = rides(spark, SF001)
    a = sliding_demand(r, duration, 10, span_s=span)
    b = (r.groupBy(F.window("event_time", f"{duration} seconds", "10 seconds").alias("w"), "zone_id", "city")
         .agg(F.count("event_id").alias("demand"))
         .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 "zone_id", "city", "demand"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_window_counts_nest(spark):
    """A trailing 60 s count never exceeds the 300 s one, nor that the 900 s one."""
    t = trailing_counts(rides(spark, SF001), (60, 300, 900))
    bad = t.filter((F.col("demand_60") > F.col("demand_300")) | (F.col("demand_300") > F.col("demand_900")))
    assert bad.count() == 0 and t.filter(F.col("demand_60") < 1).count() == 0


def test_feature_defaults_and_city_filter(spark):
    from zonefare.plans import serving as S
    df = spark.createDataFrame([("z", "chicago", None, None)], "zone_id string, city string, "
                               "available_drivers int, historical_avg_demand double")
    r = S.fill_feature_defaults(df).first()
    assert r.available_drivers == 30 and r.historical_avg_demand == 20.0 and r.zone_id == "z"
    assert S.filter_city(df, "All Cities").count() == 1 and S.filter_city(df, "new_york").count() == 0


def test_model_fallback(spark, tmp_root):
    from zonefare.model import training as M
    from zonefare.plans import serving as S
    h = S.surge_history(spark, SF001, "hour")
    f = S.feature_rows(h, S.historical_baseline(h))
    assert M.load_or_none(spark, tmp_root + "/no-model") is None
    p = M.predict_or_fallback(None, f)
    assert p.filter(F.col("ml_prediction") != 1.0).count() == 0 and p.count() == f.count()


@pytest.mark.parametrize("tol_s,bucket_s", [(660, 660), (660, 3600), (3600, 3600)])
def test_asof_join_dense_brute_force(spark, tol_s, bucket_s):
    w = DV.weather_obs(spark, SF01).select("obs_id", "city", "updated_at_ms")
    r = rides(spark, SF01).select("event_id", "city", "timestamp_ms")
    got = asof_join(r, w, "city", "timestamp_ms", "updated_at_ms", ["obs_id"], tol_s * 1000,
                    bucket_ms=bucket_s * 1000, tie="obs_id").toPandas().set_index("event_id").obs_id
    wp = w.toPandas().sort_values(["updated_at_ms", "obs_id"])
    rp = r.toPandas().sort_values("timestamp_ms")
    want = pd.merge_asof(rp, wp, left_on="timestamp_ms", right_on="updated_at_ms", by="city",
                         tolerance=tol_s * 1000 - 1, direction="backward").set_index("event_id").obs_id
    want = want.where(want.notna(), None)
    assert got.to_dict() == want.to_dict()
    assert got.notna().sum() > 0


@pytest.mark.parametrize("bucket_h", [24, 6])
def test_interval_join_dense_brute_force(spark, bucket_h):
    import numpy as np
    cal = DV.event_calendar(spark, SF01)
    segs = winner_segments(cal, bucket_ms=bucket_h * 3_600_000)
    r = rides(spark, SF01).select("event_id", "zone_id", "timestamp_ms")
    got = interval_lookup(r, segs.withColumnRenamed("event_id", "sid"), "zone_id", "timestamp_ms", ["sid"])
    got = got.toPandas().set_index("event_id").sid.to_dict()
    cp = cal.toPandas().sort_values(["start_ms", "event_id"])
    want = {}
    for z, rz in r.toPandas().groupby("zone_id"):
        cz = cp[cp.zone_id == z]
        s, e, ids = cz.start_ms.values, cz.end_ms.values, cz.event_id.values
        for eid, t in zip(rz.event_id, rz.timestamp_ms):
            act = np.nonzero((s <= t) & (e > t))[0]
            want[eid] = ids[act[0]] if len(act) else None
    assert got == want
    assert sum(v is not None for v in got.values()) > 0


@pytest.mark.parametrize("bucket_h", [24, 6, 5])
def test_greedy_chain_brute_force(spark, bucket_h):
    """One active interval per zone, greedy in start order, as joins only."""
    from zonefare.operators.intervals import greedy_chain
    cal = DV.event_calendar(spark, SF01).select("zone_id", "event_id", "start_ms", "end_ms")
    got = greedy_chain(cal, bucket_ms=bucket_h * 3_600_000).toPandas()
    want = []
    for z, g in cal.toPandas().sort_values(["start_ms", "event_id"]).groupby("zone_id"):
        busy = None
        for row in g.itertuples():
            if busy is None or row.start_ms >= busy:
                want.append((z, row.event_id))
                busy = row.end_ms
    assert sorted(zip(got.zone_id, got.event_id)) == sorted(want)


def test_intervals_longer_than_buckets(spark):
    """Nested and multi-day intervals: no length cap in the winner rule nor in the greedy chain."""
    import random
    from zonefare.operators.intervals import greedy_chain
    rnd = random.Random(1)
    day = 86_400_000
    rows = [("z", i, s, s + rnd.choice([1000, day // 3, 3 * day, 9 * day])) for i in range(60) for s in [rnd.randint(0, 40 * day)]]
    rows += [("y", 900, day, 4 * day), ("y", 901, 2 * day, 2 * day + 1000)]
    cal = spark.createDataFrame(rows, "zone_id string, event_id long, start_ms long, end_ms long")
    segs = winner_segments(cal).collect()
    for z, at in [(z, rnd.randint(0, 50 * day)) for z in "zy" for _ in range(300)] + [("y", 2 * day + 5)]:
        act = sorted((s, i) for k, i, s, e in rows if k == z and s <= at < e)
        got = [r.event_id for r in segs if r.zone_id == z and r.seg_start <= at < r.end_ms]
        assert got == ([act[0][1]] if act else [])
    want = []
    for z in "zy":
        busy = None
        for s, i, e in sorted((s, i, e) for k, i, s, e in rows if k == z):
            if busy is None or s >= busy:
                want.append((z, str(i)))
                busy = e
    got = greedy_chain(cal).collect()
    assert sorted((r.zone_id, str(r.event_id)) for r in got) == sorted(want)


def test_greedy_chain_reads_a_dense_day_once(spark):
    """No frame that is read anew for every row (before: quadratic in the intervals of a key's day)."""
    from zonefare.operators.intervals import greedy_chain, next_interval
    rng = random.Random(9)
    rows = [("z", str(i), s, s + 1000 * rng.randrange(60, 200)) for i, s in enumerate(1000 * rng.randrange(80_000) for _ in range(20_000))]
    cal = spark.createDataFrame(rows, "zone_id string, event_id string, start_ms long, end_ms long")
    plan = next_interval(cal, "zone_id", "start_ms", "end_ms", "event_id")._jdf.queryExecution().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
    want, end = [], None
    for _, i, s, e in sorted(rows, key=lambda r: (r[2], r[1])):
        if end is None or s >= end:
            want.append(i)
            end = e
    assert sorted(r.event_id for r in greedy_chain(cal).select("event_id").collect()) == sorted(want)


def test_greedy_chain_of_rows_that_come_three_times(spark):
    """Repeated rows do not multiply from round to round (before: 3 ** 64 rows in the sixth round)."""
    from zonefare.operators.intervals import greedy_chain
    rows = [("z", str(i), i * 1000, i * 1000 + 900) for i in range(70)]
    cal = spark.createDataFrame(rows * 3, "zone_id string, event_id string, start_ms long, end_ms long")
    got = greedy_chain(cal).groupBy("event_id").count().collect()
    assert len(got) == 70 and {r[1] for r in got} == {3}


def test_greedy_chain_without_known_starts(spark):
    """An unknown start follows nothing; alone in its key it is the first (before: it followed itself without an end)."""
    from zonefare.operators.intervals import greedy_chain
    rows = [("z", "1", None, None), ("z", "2", 1000, 2000), ("z", "3", 1500, 9000), ("z", "4", 2000, 3000), ("y", "6", None, None), ("y", "5", None, None)]
    cal = spark.createDataFrame(rows, "zone_id string, event_id string, start_ms long, end_ms long")
    assert sorted(r.event_id for r in greedy_chain(cal, max_rounds=6).collect()) == ["2", "4", "5"]
