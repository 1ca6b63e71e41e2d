"""The commit log and the store on it: two writers, replays, flat work, compaction, expiry, pruning."""

import os

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from zonefare.plans import serving as S
from zonefare.streaming import commitlog, store as ST
from zonefare.streaming.commitlog import CommitLog


def prices(spark, zones, t, value):
    return spark.createDataFrame([(z, "c", t, 5, float(value)) for z in zones], "zone_id string, city string, t long, demand_1min int, final_multiplier double") \
        .withColumn("timestamp", F.timestamp_seconds("t")).drop("t")


def log_files(root):
    return sorted(os.listdir(os.path.join(root, "_log")))


def test_two_streams_on_one_root_keep_all_rows(spark, tmp_root):
    """Batches of two runs with the same batch ids: nothing is overwritten, the newest row per zone is current."""
    for i in range(3):
        assert ST.commit_prices(spark, tmp_root, "a", i, prices(spark, ["z1", "z2"], 100 * i, i))
        assert ST.commit_prices(spark, tmp_root, "b", i, prices(spark, ["z2", "z3"], 100 * i + 50, i + 0.5))
    h = ST.read_history(spark, tmp_root)
    assert h.count() == 12 and h.select("run", "batch_id").distinct().count() == 6
    assert {r.zone_id: r.final_multiplier for r in ST.read_current(spark, tmp_root).collect()} == {"z1": 2.0, "z2": 2.5, "z3": 2.5}


def test_two_checkpoints_of_the_pricing_stream(spark, tmp_root):
    from zonefare.streaming.run import main
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    for half in (0, 1):
        ev.filter(F.col("event_id") % 2 == half).write.parquet(f"{tmp_root}/in{half}")
        main(["--source", "files", "--path", f"{tmp_root}/in{half}", "--root", f"{tmp_root}/store",
              "--checkpoint", f"{tmp_root}/ckpt{half}", "--once"])
    ledger = ST.read_ledger(spark, f"{tmp_root}/store")
    assert ledger.agg(F.sum("payloads")).first()[0] == ev.count()
    h = ST.read_history(spark, f"{tmp_root}/store")
    assert h.agg(F.sum("demand_1min")).first()[0] == ledger.agg(F.sum("valid")).first()[0]
    assert h.select("run").distinct().count() == 2
    assert ST.read_dead_letters(spark, f"{tmp_root}/store").count() == ledger.agg(F.sum("failed")).first()[0]


def test_replayed_batch_is_left_out(spark, tmp_root):
    for _ in range(2):
        ST.commit_prices(spark, tmp_root, "a", 0, prices(spark, ["z1"], 0, 1), counts={"payloads": 1, "valid": 1, "failed": 0})
    assert not ST.commit_prices(spark, tmp_root, "a", 0, prices(spark, ["z1"], 0, 9))
    assert ST.read_history(spark, tmp_root).count() == 1 == ST.read_ledger(spark, tmp_root).count()


def test_lost_race_merges_again(spark, tmp_root, monkeypatch):
    """Another writer commits between the state that a commit was made for and the commit itself."""
    log, put, raced = CommitLog(spark, tmp_root), CommitLog._put, []

    def late_put(self, st, entry):
        if not raced:
            raced.append(1)
            assert ST.commit_prices(spark, tmp_root, "other", 0, prices(spark, ["z2"], 900, 7))
        return put(self, st, entry)

    monkeypatch.setattr(CommitLog, "_put", late_put)
    assert ST.commit_prices(spark, tmp_root, "a", 0, prices(spark, ["z1", "z2"], 100, 1))
    assert log.state().version == 2 and ST.read_history(spark, tmp_root).count() == 3
    assert {r.zone_id: r.final_multiplier for r in ST.read_current(spark, tmp_root).collect()} == {"z1": 1.0, "z2": 7.0}


def test_only_one_writer_creates_a_version(spark, tmp_root):
    files = commitlog.Files(spark, tmp_root)
    assert files.create_new(f"{tmp_root}/_log/1.json", "a") and not files.create_new(f"{tmp_root}/_log/1.json", "b")
    assert files.read(f"{tmp_root}/_log/1.json") == "a" and files.names(f"{tmp_root}/_log") == ["1.json"]


def test_work_of_a_commit_stays_flat(spark, tmp_root, monkeypatch):
    """Many commits: the log keeps a bounded number of files and a reader a bounded number to read."""
    monkeypatch.setattr(commitlog, "STATE_EVERY", 5)
    log, seen = CommitLog(spark, tmp_root), []
    read = commitlog.Files.read
    monkeypatch.setattr(commitlog.Files, "read", lambda self, p: seen.append(p) or read(self, p))
    for i in range(60):  # entries as a batch makes them, without their data
        st = log.state()
        assert log._put(st, {"run": "a", "batch": i, "add": {f"data/t/{i}": {"table": "t", "rows": 1}}, "schemas": {"t": "{}"}})
    assert len(log_files(tmp_root)) < 20 and len(seen) < 60 * 7
    seen.clear()
    st = log.state()
    assert len(seen) <= 6 and len(st.files) == 60 and st.runs == {"a": 59} and log.rows("t") == 60


def test_compaction_expiry_and_one_zone_reads(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(commitlog, "STATE_EVERY", 3)
    day, zones = 86_400, [f"z{i:02d}" for i in range(20)]
    for i in range(9):
        ST.commit_prices(spark, tmp_root, "a", i, prices(spark, zones, (i % 3) * day + i, 1 + i).coalesce(1))
    before = ST.read_history(spark, tmp_root)
    rows = sorted(map(tuple, before.collect()))
    assert len(before.inputFiles()) == 9
    monkeypatch.setattr(commitlog.CommitLog.compact, "__defaults__", (2, 2_000))  # files of about 2 kB: several a date
    assert CommitLog(spark, tmp_root).compact(ST.HISTORY, "timestamp", "zone_id", 2, 4_000) == 3
    after = ST.read_history(spark, tmp_root)
    assert sorted(map(tuple, after.collect())) == rows
    # one zone: the files that hold it, and no others
    one = ST.read_history(spark, tmp_root, zone="z07", until="1970-01-02 12:00:00")
    assert one.count() == 6 and 0 < len(one.inputFiles()) < len(after.inputFiles())
    assert all(spark.read.parquet(f).filter("zone_id = 'z07'").count() > 0 for f in one.inputFiles())
    # retention of one day at the third day's second hour: the first date goes, whole files only
    from dataclasses import replace

    from zonefare.config import DEFAULT
    cfg = replace(DEFAULT, history_retention_seconds=day)
    as_of = "1970-01-03 02:00:00"
    assert ST.expire_history(spark, tmp_root, as_of, cfg) > 0
    left = ST.read_history(spark, tmp_root)
    # dates stay whole: retention hides what is older inside them
    assert left.filter("date = '1970-01-01'").count() == 0 and left.filter("date = '1970-01-03'").count() == 60
    assert ST.retained(left, as_of, day).count() == 60
    for i in range(9, 18):  # files that left the log are deleted with a later state
        ST.commit_prices(spark, tmp_root, "a", i, prices(spark, ["z00"], 3 * day, i))
    on_disk = sum(f.endswith(".parquet") for d in ("data/history",) for _, _, fs in os.walk(os.path.join(tmp_root, d)) for f in fs)
    assert on_disk == len(ST.read_history(spark, tmp_root).inputFiles())
    assert len(os.listdir(os.path.join(tmp_root, "views/current"))) <= commitlog.KEPT_SNAPSHOTS + 2 * 3


def test_empty_batch_and_missing_store(spark, tmp_root):
    with pytest.raises(FileNotFoundError):
        ST.read_current(spark, tmp_root)
    with pytest.raises(FileNotFoundError):
        ST.read_history(spark, tmp_root)
    assert ST.commit_prices(spark, tmp_root, "a", 0, prices(spark, ["z"], 0, 1).limit(0))
    assert ST.read_history(spark, tmp_root).count() == 0 == ST.read_current(spark, tmp_root).count()


def test_time_to_live_of_the_current_view(spark, tmp_root):
    ST.commit_prices(spark, tmp_root, "a", 0, prices(spark, ["old"], 0, 1).unionByName(prices(spark, ["new"], 100, 1)))
    assert {r.zone_id for r in ST.read_current(spark, tmp_root, as_of="1970-01-01 00:02:00").collect()} == {"new"}
    assert ST.read_current(spark, tmp_root, as_of="1970-01-01 00:10:00").count() == 0
    assert ST.read_current(spark, tmp_root).count() == 2


def test_feature_upsert(spark, tmp_root):
    h = S.surge_history(spark, SF001, "hour")
    f = S.feature_rows(h, S.historical_baseline(h)).select("zone_id", "city", "timestamp", "demand_last_1min")
    assert ST.commit_features(spark, tmp_root, "a", 0, f) and not ST.commit_features(spark, tmp_root, "a", 0, f)
    assert ST.read_features(spark, tmp_root).count() == f.count()
    assert ST.latest_features(spark, tmp_root).count() == f.select("zone_id").distinct().count()
