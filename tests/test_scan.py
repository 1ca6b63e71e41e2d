"""Blocked prefix scans against plain loops, with most rows in one key."""

import itertools
import random

from pyspark.sql import functions as F

from zonefare.operators import scan


def rows(n=900):
    rnd = random.Random(7)
    return [("hot" if rnd.random() < 0.9 else f"k{rnd.randrange(5)}", i * 3 % n, rnd.randrange(-4, 9),
             None if rnd.random() < 0.6 else rnd.randrange(100)) for i in range(n)]


def stored(spark, data, blocks=13):
    df = spark.createDataFrame(data, "key string, at long, x long, seen long")
    return scan.checkpointed(scan.in_blocks(df, ["key", "at", "x", "seen"], blocks))


def test_running_sums_per_key_and_overall(spark):
    data = rows()
    s = stored(spark, data)
    assert s.select(scan.BLOCK).distinct().count() > 5
    got = scan.running_sums(s, {"before": "x"}, ["key"]).select("key", "at", "x", "seen", "before").collect()
    want = []
    order = lambda r: (r[0], r[1], r[2], -1 if r[3] is None else r[3])
    for _, g in itertools.groupby(sorted(data, key=order), key=lambda r: r[0]):
        total = 0
        for r in g:
            want.append((*r, total))
            total += r[2]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    overall = scan.running_sums(s, {"upto": "x"}, inclusive=True).agg(F.max_by("upto", scan.AT)).first()[0]
    assert overall == sum(r[2] for r in data)


def test_last_known_crosses_blocks(spark):
    data = rows()
    got = scan.last_known(stored(spark, data), {"newest": F.col("seen")}, ["key"]).select("key", "at", "x", "seen", "newest")
    order = lambda r: (r[0], r[1], r[2], -1 if r[3] is None else r[3])
    want = []
    for _, g in itertools.groupby(sorted(data, key=order), key=lambda r: r[0]):
        newest = None
        for r in g:
            newest = newest if r[3] is None else r[3]
            want.append((*r, newest))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_rank_of_an_empty_table_and_of_ties(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(0,)], "a int")
    got = scan.with_rank(df, ["a"]).collect()
    assert sorted(r["rank"] for r in got) == list(range(51)) and [r["rank"] for r in got if r["a"] == 0] == [0]
    assert scan.with_rank(df.where("a > 5"), ["a"]).collect() == []


def hot_rides(spark, n=1500):
    """Most events in one zone and one hour."""
    rnd = random.Random(3)
    rows = [(i, "hot" if rnd.random() < 0.9 else "cold", rnd.randrange(3_600_000) if rnd.random() < 0.9 else rnd.randrange(90_000_000))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "event_id long, zone_id string, timestamp_ms long")


def task_rows(df):
    return df.groupBy(scan.BLOCK).count().agg(F.max("count")).first()[0]


def test_trailing_counts_with_a_hot_zone(spark):
    from zonefare.operators.windows import trailing_counts_scan
    rows, df = hot_rides(spark)
    got = {r.event_id: (r.demand_60, r.demand_900) for r in trailing_counts_scan(df, (60, 900), rows_per_block=100).collect()}
    want = {i: tuple(sum(z == y and t - w * 1000 < u <= t for _, y, u in rows) for w in (60, 900)) for i, z, t in rows}
    assert got == want
    stored = scan.checkpointed(scan.in_blocks(df, ["zone_id", "timestamp_ms"], scan.blocks_for(df, 100)))
    assert task_rows(stored) < 300  # 1 350 rows share one zone and hour


def test_asof_with_a_hot_key(spark):
    from zonefare.operators.joins import asof_scan
    rows, df = hot_rides(spark)
    obs = [(f"o{i}", "hot" if i % 4 else "cold", i * 7919 % 3_600_000) for i in range(200)] + [("tie1", "hot", 50_000), ("tie2", "hot", 50_000)]
    right = spark.createDataFrame(obs, "obs_id string, zone_id string, at_ms long")
    got = asof_scan(df, right, "zone_id", "timestamp_ms", "at_ms", ["obs_id"], 20_000, "obs_id", rows_per_block=100)
    want = {}
    for i, z, t in rows:
        near = max(((u, o) for o, y, u in obs if y == z and u <= t), default=None)
        want[i] = near[1] if near and t - near[0] < 20_000 else None
    assert {r.event_id: r.obs_id for r in got.collect()} == want and got.columns == [*df.columns, "obs_id", "at_ms_matched"]


def test_history_series_with_a_hot_zone(spark):
    from zonefare.plans.serving import history_series
    rnd = random.Random(8)
    rows = [("hot" if i % 10 else "cold", "c", i * 60, rnd.choice([1.0, 1.2, 2.0])) for i in range(600)]
    h = spark.createDataFrame(rows, "zone_id string, city string, t long, final_multiplier double").select(
        "zone_id", "city", F.timestamp_seconds("t").alias("timestamp"), "final_multiplier",
        F.col("final_multiplier").alias("rule_multiplier"), F.col("final_multiplier").alias("ml_multiplier"))
    got = history_series(h, rows_per_block=50).orderBy("zone_id", "timestamp").collect()
    for zone in ("hot", "cold"):
        mine, values = [r for r in got if r.zone_id == zone], [v for z, _, _, v in rows if z == zone]
        assert [r.point for r in mine] == list(range(1, len(values) + 1)) and [r.final_multiplier for r in mine] == values
        assert [r.delta for r in mine] == [None] + [round(b - a, 6) for a, b in itertools.pairwise(values)]


def test_exact_medians_and_imputation(spark):
    import statistics

    from zonefare.operators.selection import exact_medians, impute
    rnd = random.Random(4)
    rows = [(rnd.choice([0.0, 0.0, 0.0, rnd.gauss(0, 1), rnd.gauss(0, 1e9)]), None if i % 3 else float(i), i % 7,
             float("nan") if i % 2 else rnd.choice([1.7e308, -1.7e308, 5e-324]), None) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double, c int, d double, e double").repartition(7)
    got = exact_medians(df, ["a", "b", "c", "d", "e"], bins=16)
    value = lambda k: [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
    assert got["a"] == statistics.median(value(0)) and got["b"] == statistics.median(value(1)) and got["c"] == statistics.median(value(2))
    assert sorted(value(3))[249:251].count(got["d"]) and got["e"] is None
    filled = impute(df, got)
    assert filled.filter("b IS NULL OR isnan(d)").count() == 0 and filled.filter("e IS NOT NULL").count() == 0
    assert exact_medians(df.limit(0), ["a"]) == {"a": None}
