"""Streams: several micro-batches, replay from checkpoint, late data, state."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from zonefare.operators.quality import validate_events
from zonefare.sources import derived as DV
from zonefare.sources.rides import ride_columns, zone_dim
from zonefare.streaming import jobs as J
from zonefare.streaming import store as ST
from zonefare.streaming.sources import ride_stream


def _split_events(spark, root, n=4):
    """Copy sf0.001 events into n files (one per time slice) for n batches."""
    src = os.path.join(root, "events")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev = ev.withColumn("_slice", F.ntile(n).over(Window.orderBy("ts")))
    for i in range(1, n + 1):
        ev.filter(F.col("_slice") == i).drop("_slice").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(src, f"part{i}"))
    # flatten: one file per slice directly under src
    files = []
    for i in range(1, n + 1):
        d = os.path.join(src, f"part{i}")
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.link(os.path.join(d, f), os.path.join(src, f"slice{i}.parquet"))
        files.append(os.path.join(src, f"slice{i}.parquet"))
    return src


def _run_surge(spark, src, root, ckpt):
    r = ride_stream(spark, src, glob="slice*.parquet", extra=("k", "event_type"))
    q = J.surge_stream_job(DV.payload_text(r), root, ckpt, available_now=True)
    q.awaitTermination()
    return q


def test_surge_stream_matches_batch_and_replays(spark, tmp_root):
    src = _split_events(spark, tmp_root)
    root, ckpt = os.path.join(tmp_root, "out"), os.path.join(tmp_root, "ckpt")
    q = _run_surge(spark, src, root, ckpt)
    m = [p["observedMetrics"]["ride_payloads"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(x["payloads"] for x in m) == 1000
    assert sum(x["valid"] for x in m) + sum(x["failed"] for x in m) == 1000
    hist = ST.read_history(spark, root)
    batches = hist.select("batch_id").distinct().count()
    assert batches == 4
    # batch twin: each slice priced on its own
    slices = []
    for i in range(1, 5):
        one = spark.read.parquet(os.path.join(src, f"slice{i}.parquet"))
        dim = zone_dim(spark).select("zone_idx", "zone_id", "city", "latitude", "longitude")
        r = ride_columns(one).join(F.broadcast(dim), "zone_idx")
        v = validate_events(DV.payload_text(r)).filter(F.col("failure_reason").isNull()).select("event.*") \
            .withColumn("event_time", F.timestamp_millis("timestamp_ms"))
        slices.append(J.price_micro_batch(v))
    want = slices[0]
    for s in slices[1:]:
        want = want.unionByName(s)
    got = hist.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # current = latest per zone over all batches
    cur = ST.read_current(spark, root)
    assert cur.count() == hist.select("zone_id").distinct().count()
    # restart with the same checkpoint: nothing is reprocessed or duplicated
    _run_surge(spark, src, root, ckpt)
    assert ST.read_history(spark, root).count() == hist.count()
    dlq = ST.read_dead_letters(spark, root)
    assert dlq.count() > 0 and dlq.filter(F.col("failure_reason").isNull()).count() == 0


def test_sliding_stream_drops_late_rows(spark, tmp_root):
    """Two on-time batches advance the watermark; the third holds rows a day
    older, which are dropped (and counted) instead of reopening closed
    windows.  Spark filters late rows against the watermark of the previous
    batch, hence two on-time batches before the late one."""
    import time
    src = os.path.join(tmp_root, "late")
    base = spark.read.parquet(f"{SF001}/events.parquet").orderBy("ts").limit(300)
    cut = base.orderBy("ts").collect()[150].ts
    base.filter(F.col("ts") < cut).coalesce(1).write.parquet(os.path.join(tmp_root, "a"))
    base.filter(F.col("ts") >= cut).coalesce(1).write.parquet(os.path.join(tmp_root, "a2"))
    late = base.limit(5).withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY"))
    late.coalesce(1).write.parquet(os.path.join(tmp_root, "b"))
    os.makedirs(src)
    for name in ("a", "a2", "b"):  # file source order = modification time
        f = [x for x in os.listdir(os.path.join(tmp_root, name)) if x.endswith(".parquet")][0]
        os.link(os.path.join(tmp_root, name, f), os.path.join(src, f"{name}.parquet"))
        os.utime(os.path.join(src, f"{name}.parquet"))
        time.sleep(1.1)
    r = ride_stream(spark, src, glob="*.parquet")
    q = (J.sliding_demand_stream(r, 60).writeStream.format("memory").queryName("slide_late")
         .outputMode("update").option("checkpointLocation", os.path.join(tmp_root, "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.table("slide_late")
    oldest = base.agg(F.min("ts")).first()[0]
    assert out.count() > 0
    assert out.filter(F.col("window_end") <= F.lit(oldest)).count() == 0
    dropped = sum(sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
                  for p in q.recentProgress)
    assert dropped == 5 * 6  # each late row falls in six 60 s windows sliding by 10 s


def test_event_state_brute_force(spark, tmp_root):
    from zonefare.plans.queries import q_stream_event_state
    got = q_stream_event_state(spark, SF001).toPandas()
    cal = DV.event_calendar(spark, SF001).toPandas().sort_values(["start_ms", "event_id"])
    want = []
    for z, g in cal.groupby("zone_id"):
        end = None
        for row in g.itertuples():
            if end is not None and row.start_ms < end:
                continue
            end = row.end_ms
            want.append((z, row.event_id))
    assert sorted(zip(got.zone_id, got.event_id)) == sorted(want)


def test_dedup_stream(spark):
    from zonefare.plans.queries import q_stream_dedup
    d = q_stream_dedup(spark, SF001)
    assert d.count() == d.select("event_id").distinct().count() == 1000


def test_stream_windows_equal_batch_on_closed_windows(spark):
    """Streamed sliding windows = batch windows that the watermark closed."""
    from zonefare.operators.windows import sliding_demand
    from zonefare.plans.queries import q_stream_sliding_demand
    from zonefare.sources.rides import rides
    got = q_stream_sliding_demand(spark, SF001)
    r = rides(spark, SF001)
    wm = r.agg(F.max("event_time")).first()[0]
    want = sliding_demand(r, 60, 10).filter(F.col("window_end") <= F.lit(wm) - F.expr("INTERVAL 120 SECONDS"))
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_preaggregated_stream_windows_equal_direct(spark, tmp_root):
    """Chained (10 s tumbling -> sliding) windows equal the direct form."""
    r = ride_stream(spark, SF001, glob="events.parquet")
    outs = []
    for pre in (False, True):
        name = f"pre_{pre}".lower()
        q = (J.sliding_demand_stream(r, 300, preaggregate=pre).writeStream.format("memory").queryName(name)
             .outputMode("append").option("checkpointLocation", os.path.join(tmp_root, name))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        outs.append(spark.table(name))
    a, b = outs
    assert a.count() > 0
    # the chained form closes windows one watermark later; compare what both emitted
    common = a.join(b.select("window_start", "zone_id").distinct(), ["window_start", "zone_id"],
                    "left_semi").select(*b.columns)
    assert common.exceptAll(b).count() == 0
    assert b.count() > 0.5 * a.count() and b.exceptAll(a).count() == 0


def test_history_retention_opens_kept_dates_only(spark, tmp_root):
    from zonefare.plans import serving as S
    h = S.surge_history(spark, SF001, "hour")
    ST.commit_prices(spark, tmp_root, "batch", 0, h)
    stored = ST.read_history(spark, tmp_root, since="2024-01-13 00:00:00")
    kept = ST.retained(stored, "2024-01-20 00:00:00", 7 * 86_400)
    want = h.filter((F.col("timestamp") > F.lit("2024-01-13 00:00:00").cast("timestamp"))
                    & (F.col("timestamp") <= F.lit("2024-01-20 00:00:00").cast("timestamp")))
    assert kept.count() == want.count() > 0
    assert len(stored.inputFiles()) < len(ST.read_history(spark, tmp_root).inputFiles())
    assert all("__date=2024-01-12" not in f for f in stored.inputFiles())


def test_cluster_conf_is_accepted(spark):
    from zonefare.session import cluster_conf
    conf = cluster_conf(800)
    assert conf["spark.sql.shuffle.partitions"] == "2400"
    keys = [k for k in conf if k.startswith("spark.sql.") and "stateStore" not in k]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, conf[k])
            assert spark.conf.get(k) == conf[k]
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_stream_query_reads_a_table_of_part_files(spark, tmp_root):
    """`events.parquet` as a folder: the same rows as the single file."""
    import __spark_entry__ as E
    from conftest import SF001
    spark.read.parquet(f"{SF001}/events.parquet").coalesce(1).write.parquet(f"{tmp_root}/events.parquet")
    q = E.queries()["stream_dedup"]
    a, b = q(spark, SF001), q(spark, tmp_root)
    assert a.count() == b.count() == 1000 and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("ordered", [True, False])
def test_replay_does_not_depend_on_part_files(spark, tmp_root, ordered):
    """Four part files, in order of event time or not: the rows of the single file."""
    import time
    import __spark_entry__ as E
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev = ev.withColumn("_slice", F.ntile(4).over(Window.orderBy("ts"))).persist()
    out = os.path.join(tmp_root, "events.parquet")
    os.makedirs(out)
    for i in (1, 2, 3, 4) if ordered else (4, 2, 3, 1):  # file source order = modification time
        ev.filter(F.col("_slice") == i).drop("_slice").coalesce(1).write.parquet(os.path.join(tmp_root, f"part{i}"))
        f = [x for x in os.listdir(os.path.join(tmp_root, f"part{i}")) if x.endswith(".parquet")][0]
        os.link(os.path.join(tmp_root, f"part{i}", f), os.path.join(out, f"part{i}.parquet"))
        os.utime(os.path.join(out, f"part{i}.parquet"))
        time.sleep(1.1)
    ev.unpersist()
    for name in ("stream_sliding_demand", "stream_dedup", "stream_event_state", "stream_surge_batches", "stream_current_view"):
        a, b = E.queries()[name](spark, SF001), E.queries()[name](spark, tmp_root)
        assert a.count() == b.count() > 0, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


@pytest.fixture()
def few_partitions(spark):
    """State of two partitions: the tests below start many small batches."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _arrivals(spark, root, n, ordered):
    """The events in n folders of part files, as they come one after the other."""
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("_slice", F.ntile(n).over(Window.orderBy("ts"))).persist()
    for step, i in enumerate(range(1, n + 1) if ordered else (3, 1, 4, 2)):
        ev.filter(F.col("_slice") == i).drop("_slice").write.parquet(f"{root}/src/{step}")
        yield f"{root}/src/*"
    ev.unpersist()


@pytest.mark.parametrize("n,ordered", [(1, True), (4, True), (4, False)])
def test_on_time_and_late_rows_are_the_input(spark, tmp_root, few_partitions, n, ordered):
    from zonefare.streaming.commitlog import CommitLog
    for path in _arrivals(spark, tmp_root, n, ordered):
        J.on_time_job(ride_stream(spark, path, max_files_per_trigger=None), f"{tmp_root}/store", f"{tmp_root}/ckpt",
                      available_now=True).awaitTermination()
    log = CommitLog(spark, f"{tmp_root}/store")
    on_time, late = log.read("on_time"), log.read("late")
    ids = on_time.select("event_id").unionByName(late.select("event_id"))
    assert ids.count() == ids.distinct().count() == 1000
    assert (late.count() > 0) == (not ordered)
    ledger = ST.read_ledger(spark, f"{tmp_root}/store")
    assert ledger.agg(F.sum("payloads"), F.sum("valid"), F.sum("late")).first() == (1000, on_time.count(), late.count())
    # a late row is older than the delay below the newest row of the batches before its own
    newest = {r.batch_id: r.t for r in on_time.unionByName(late).groupBy("batch_id").agg(F.max("event_time").alias("t")).collect()}
    for r in late.select("batch_id", "event_time").collect():
        assert (max(t for b, t in newest.items() if b < r.batch_id) - r.event_time).total_seconds() > 120


def test_event_state_over_many_batches_and_expired_state(spark, tmp_root, few_partitions):
    """Timers decide in start order although the starts arrive in any order within the delay; ended events leave the state."""
    import random
    from zonefare.operators.intervals import greedy_chain
    J.rocksdb_state(spark)
    rnd, rows = random.Random(5), []
    for i in range(240):
        start = 1_000 * (10 * i + rnd.randrange(60))
        rows.append((f"z{rnd.randrange(3)}", f"e{i:03d}", start, start + 1_000 * rnd.choice([5, 40, 200])))
    schema, out = "zone_id string, event_id string, start_ms long, end_ms long", f"{tmp_root}/out"
    late = 0
    for step in range(5):
        part = rows[60 * step:60 * (step + 1)] if step < 4 else [("end", "flush", 10_000_000, 10_000_001)]
        rnd.shuffle(part)
        spark.createDataFrame(part, schema).withColumn("multiplier", F.lit(2.0)).coalesce(1).write.parquet(f"{tmp_root}/src/{step}")
        cal = spark.readStream.schema(schema + ", multiplier double").parquet(f"{tmp_root}/src/*")
        q = (J.event_state_stream(cal).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_root}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        ops = [op for p in q.recentProgress for op in p["stateOperators"]]
        late += sum(op["numRowsDroppedByWatermark"] for op in ops)
    cal = spark.createDataFrame(rows, schema).withColumn("multiplier", F.lit(2.0))
    want = greedy_chain(cal).select("zone_id", "event_id", "start_ms", "end_ms", "multiplier")
    got = spark.read.parquet(out).select(*want.columns)
    assert late == 0 and 3 < got.count() < 240
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_shared_windows_update_over_batches(spark, tmp_root, few_partitions):
    """After all batches the three window lengths hold the counts of all rides."""
    from zonefare.operators.windows import sliding_demand
    from zonefare.sources.rides import RIDE_COLUMNS
    for path in _arrivals(spark, tmp_root, 3, True):
        J.shared_windows_job(ride_stream(spark, path, max_files_per_trigger=None), f"{tmp_root}/store", f"{tmp_root}/ckpt",
                             available_now=True).awaitTermination()
    dim = zone_dim(spark).select("zone_idx", "zone_id", "city", "latitude", "longitude")
    so_far = ride_columns(spark.read.parquet(f"{tmp_root}/src/*")).join(F.broadcast(dim), "zone_idx").select(*RIDE_COLUMNS)
    for s in (60, 300, 900):
        want = sliding_demand(so_far, s, 10)
        got = J.current_windows(spark, f"{tmp_root}/store", s).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ride_event_join_state_falls_behind_the_watermark(spark, tmp_root, few_partitions):
    kept = []
    for path in _arrivals(spark, tmp_root, 4, True):
        r = ride_stream(spark, path, max_files_per_trigger=None, extra=("k", "event_type"))
        from zonefare.plans.queries import _calendar
        both = J.ride_events_stream(ride_stream(spark, path, max_files_per_trigger=None).select("event_id", "zone_id", "event_time"),
                                    _calendar(r.filter(F.col("event_type") == "signup")))
        q = (both.writeStream.format("noop").option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        kept.append([op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]][-1])
    assert all(k < 350 for k in kept)  # a batch brings 250 rides; those of earlier days are gone


def test_ride_event_join_meets_by_slots_of_time(spark, tmp_root, few_partitions):
    """A ride is compared to the events of its slot only (before: to all of its zone in the state), and meets each running one once."""
    import random
    from datetime import datetime, timezone
    rnd, minute, t0 = random.Random(3), 60_000, 1_704_067_200_000
    events = [("z%d" % rnd.randrange(2), "e%02d" % i, t0 + rnd.randrange(0, 600) * minute, rnd.choice([-5, 0, 1, 29, 30, 31, 200, 300])) for i in range(60)]
    events += [("z0", "e60", t0 + 30 * minute, 30), (None, "e61", t0, 60), ("z1", "e62", None, 60)]
    events = [(z, e, s, None if s is None else s + n * minute, 2.0) for z, e, s, n in events]
    rides = [("r%03d" % i, "z%d" % rnd.randrange(2), t0 + rnd.randrange(0, 20) * 30 * minute + rnd.choice([0, -1, 1, 7 * minute])) for i in range(150)]
    rides += [("r150", None, t0), ("r151", "z0", None)]
    at = lambda ms: None if ms is None else datetime.fromtimestamp(ms / 1000, timezone.utc)
    spark.createDataFrame([(r, z, at(t)) for r, z, t in rides], "event_id string, zone_id string, event_time timestamp").write.parquet(f"{tmp_root}/rides")
    spark.createDataFrame(events, "zone_id string, event_id string, start_ms long, end_ms long, multiplier double").write.parquet(f"{tmp_root}/events")
    stream = lambda name: spark.readStream.schema(spark.read.parquet(f"{tmp_root}/{name}").schema).parquet(f"{tmp_root}/{name}")
    both = J.ride_events_stream(stream("rides"), stream("events"))
    join = [x for x in both._jdf.queryExecution().analyzed().toString().splitlines() if "Join Inner" in x]
    assert len(join) == 1 and "__slot" in join[0] and "__event_slot" in join[0]
    both.writeStream.format("parquet").option("path", f"{tmp_root}/out").option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_root}/out").collect()
    want = [(r, e) for r, rz, t in rides for ez, e, s, end, _ in events
            if None not in (rz, t, s) and rz == ez and s <= t < min(end, s + J.MAX_EVENT_MINUTES * minute)]
    assert len(want) > 100 and sorted((x.event_id, x.special_event_id) for x in got) == sorted(want)


def test_event_state_decides_all_starts_behind_the_watermark_at_once(monkeypatch):
    """Work of a batch follows its starts: one timer for them all, each read once (before: a timer for each, and each read all)."""
    import pandas as pd

    class Value:
        def __init__(self):
            self.held, self.read = None, 0

        def exists(self):
            return bool(self.held)

        def get(self):
            self.read += len(self.held or [])
            return list(self.held or [])

        def update(self, v):
            self.held = v

        def appendList(self, rows):
            self.held = (self.held or []) + rows

        def clear(self):
            self.held = None

    class Handle:
        def __init__(self):
            self.timers, self.states = [], []

        def getListState(self, *_):
            self.states.append(Value())
            return self.states[-1]

        getValueState = getMapState = getListState

        def registerTimer(self, at):
            self.timers.append(at)

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    handle, job = Handle(), J.OneEventAtATime()
    monkeypatch.setattr(job, "APPENDED", 7, raising=False)
    job.init(handle)
    n = 500
    rows = pd.DataFrame({"zone_id": "z", "event_id": [f"e{i}" for i in range(n)], "start_ms": [10 * (n - i) for i in range(n)],
                         "end_ms": [10 * (n - i) + 25 for i in range(n)], "multiplier": 2.0})
    list(job.handleInputRows(("z",), iter([rows[:200], rows[200:]]), At(0)))
    assert handle.timers == [10]
    out = pd.concat(list(job.handleExpiredTimer(("z",), At(3000), At(10))))
    assert out["start_ms"].tolist() == list(range(10, 3000, 30))
    assert handle.states[0].read == n and sorted(x[0] for x in handle.states[0].held) == list(range(3000, 10 * n + 10, 10))
    assert handle.timers[1:] == [3000, out["end_ms"].iloc[-1]]
    out = pd.concat(list(job.handleExpiredTimer(("z",), At(100_000), At(3000))))
    assert out["start_ms"].tolist() == list(range(3010, 10 * n + 1, 30)) and handle.states[0].held is None and handle.states[1].held is None


def test_surge_batch_is_dealt_over_tasks(spark, tmp_root, monkeypatch):
    """A batch that comes as one row group is not read by one task (before: one task held all payloads, decoded)."""
    rides = [(i % 900, i % 11, i) for i in range(3000)]  # events come several times
    ev = spark.createDataFrame(rides, "event_id long, user_id long, k long").select(
        "event_id", F.timestamp_millis(F.lit(1_704_067_200_000) + F.col("event_id") * 1000).alias("ts"), "user_id",
        F.when(F.col("k") % 5 == 0, "error").otherwise("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.format_string('{"k": %d}', F.col("event_id") % 100).alias("props"))
    src, root = os.path.join(tmp_root, "src"), os.path.join(tmp_root, "out")
    ev.coalesce(1).write.parquet(src)
    seen, price = [], J.price_micro_batch

    def spy(valid, cfg):
        seen.append((valid.columns, [r[1] for r in valid.groupBy(F.spark_partition_id()).count().collect()]))
        return price(valid, cfg)

    monkeypatch.setattr(J, "price_micro_batch", spy)
    payloads = DV.payload_text(ride_stream(spark, src, max_files_per_trigger=None, extra=("k", "event_type")))
    q = J.surge_stream_job(payloads, root, os.path.join(tmp_root, "ckpt"), available_now=True)
    q.awaitTermination()
    dim = zone_dim(spark).select("zone_idx", "zone_id", "city", "latitude", "longitude")
    v = validate_events(DV.payload_text(ride_columns(spark.read.parquet(src)).join(F.broadcast(dim), "zone_idx")))
    valid = v.filter("failure_reason IS NULL").select("event.*").withColumn("event_time", F.timestamp_millis("timestamp_ms"))
    (columns, rows), = seen
    assert sum(rows) == valid.count() and max(rows) < sum(rows) / 2
    assert set(columns) == {*J.PRICED_COLUMNS, "event_time"}
    want, got = price(valid), ST.read_history(spark, root)
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    dead, bad = ST.read_dead_letters(spark, root), v.filter("failure_reason IS NOT NULL").select("event_id", "failure_reason", "timestamp_ms", "value")
    texts = dead.select("event_id", "failure_reason", "failed_at_ms", F.get_json_object("dlq_value", "$.original_event").alias("value"))
    assert bad.count() > 500 and texts.exceptAll(bad).count() == 0 and bad.exceptAll(texts).count() == 0
    assert len(dead.inputFiles()) == 1
    n = ST.read_ledger(spark, root).first()
    assert (n.payloads, n.valid, n.failed) == (3000, valid.count(), bad.count())
    m = [p["observedMetrics"]["ride_payloads"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(x["payloads"] for x in m) == 3000
