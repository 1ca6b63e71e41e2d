"""Streaming jobs.  Each takes a streaming DataFrame built by
streaming.sources and reuses the batch operators unchanged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from zonefare.config import DEFAULT, PricingConfig
from zonefare.operators.aggregate import surge_rows
from zonefare.functions.conditions import wmo_severity
from zonefare.operators.latest import latest_per_key
from zonefare.operators.scan import checkpointed, in_blocks, last_known
from zonefare.operators.quality import dead_letters, validate_events
from zonefare.operators.windows import windows_of_buckets
from zonefare.plans.serving import HISTORY_COLUMNS
from zonefare.streaming import store
from zonefare.streaming.commitlog import CommitLog, run_of


def _writer(df: DataFrame, checkpoint: str, available_now: bool, cfg: PricingConfig):
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=f"{cfg.trigger_seconds} seconds")


def _run_of_folder(checkpoint: str) -> str:
    return hashlib.md5(checkpoint.encode()).hexdigest()


def price_micro_batch(valid: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Aggregate one micro-batch of valid rides per zone and price it.

    The row's time is the newest event of the zone in the batch, so the
    result depends on the data only (replays give identical rows).
    """
    agg = (valid.groupBy("zone_id", "city")
           .agg(F.count("event_id").alias("demand_1min"),
                F.avg("available_drivers").cast("int").alias("available_drivers"),
                F.avg("weather_severity").cast("int").alias("weather_severity"),
                F.max("event_time").alias("timestamp")))
    return surge_rows(agg, cfg).select(*HISTORY_COLUMNS)


#: What a valid payload hands over to pricing.
PRICED_COLUMNS = ("event_id", "zone_id", "city", "available_drivers", "weather_severity", "timestamp_ms")
#: Dead letters are written one file for about so many payloads of the batch: a small batch leaves few files, a task of a large one reads few.
PAYLOADS_PER_FILE = 200_000


def surge_stream_job(payloads: DataFrame, root: str, checkpoint: str,
                     cfg: PricingConfig = DEFAULT, available_now: bool = False):
    """JSON ride payloads -> validate -> (dead letters | price per zone) ->
    history append + current snapshot, once per micro-batch.

    Every batch is one commit of the store.  Validation runs on the stream itself, so the valid / failed counts of
    every batch are reported in the query progress (`observedMetrics`).
    Only the needed columns cross into foreachBatch (pruning does not pass
    that boundary): a valid row hands over what its price needs, a failed one its text.
    The batch is persisted because several sinks read it, dealt evenly over the
    shuffle partitions first: a scan task may hold a whole row group, and its rows as
    JSON text and decoded columns are many times the file.
    Errors propagate so the batch is retried from the checkpoint instead of
    being lost.
    """
    v = validate_events(payloads.select("event_id", "timestamp_ms", "value"))
    ok = F.col("failure_reason").isNull()
    v = v.observe("ride_payloads", F.count(F.lit(1)).alias("payloads"),
                  F.count_if(ok).alias("valid"), F.count_if(~ok).alias("failed"))
    v = v.select("event_id", "timestamp_ms", "failure_reason", F.when(~ok, F.col("value")).alias("value"),
                 F.when(ok, F.struct(*[F.col("event")[c].alias(c) for c in PRICED_COLUMNS])).alias("event"))

    def process(batch_df: DataFrame, batch_id: int) -> None:
        b = batch_df.repartition("event_id", "timestamp_ms").persist()
        try:
            n = b.agg(F.count(F.lit(1)).alias("payloads"),
                      F.count_if(F.col("failure_reason").isNull()).alias("valid")).first()
            if not n.payloads:  # nothing to price; keep the previous snapshot
                return
            spark = b.sparkSession
            valid = (b.filter(F.col("failure_reason").isNull()).select("event.*")
                     .withColumn("event_time", F.timestamp_millis(F.col("timestamp_ms"))))
            rows = price_micro_batch(valid, cfg).persist()
            dead = dead_letters(b, F.col("timestamp_ms")).select("event_id", "failure_reason", "failed_at_ms", "dlq_value")
            dead = dead.coalesce(-(-n.payloads // PAYLOADS_PER_FILE))
            store.commit_prices(spark, root, run_of(b, _run_of_folder(checkpoint)), batch_id, rows, dead,
                                {"payloads": n.payloads, "valid": n.valid, "failed": n.payloads - n.valid})
            rows.unpersist()
        finally:
            b.unpersist()

    return _writer(v, checkpoint, available_now, cfg).foreachBatch(process).start()


def sliding_demand_stream(rides: DataFrame, duration_s: int, cfg: PricingConfig = DEFAULT,
                          preaggregate: bool = False) -> DataFrame:
    """Requests per zone over event-time sliding windows, late rows beyond
    the watermark dropped (state is purged once a window closes).

    With `preaggregate` (for dense streams, append mode) events are first
    counted per slide-sized tumbling window and those counts feed the
    sliding window through `window_time`: the sliding state then grows with
    zone-buckets instead of events.
    """
    slide = f"{cfg.slide_seconds} seconds"
    r = rides.withWatermark("event_time", f"{cfg.watermark_seconds} seconds")
    if preaggregate:
        r = (r.groupBy(F.window("event_time", slide).alias("t"), "zone_id", "city")
             .agg(F.count("event_id").alias("n"))
             .select(F.window_time("t").alias("event_time"), "zone_id", "city", "n"))
        agg = F.sum("n").alias("demand")
    else:
        agg = F.count("event_id").alias("demand")
    w = F.window("event_time", f"{duration_s} seconds", slide)
    return (r.groupBy(w.alias("w"), "zone_id", "city").agg(agg)
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "zone_id", "city", F.col("demand").cast("long").alias("demand")))


def dedup_stream(rides: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Drop re-delivered events (same event_id) seen within the watermark."""
    return (rides.withWatermark("event_time", f"{cfg.watermark_seconds} seconds")
            .dropDuplicatesWithinWatermark(["event_id"]))


def on_time_job(rides: DataFrame, root: str, checkpoint: str, cfg: PricingConfig = DEFAULT, available_now: bool = False):
    """Sends every ride to the `on_time` or the `late` table of the store: nothing is dropped.

    The watermark is kept in the commit log: a batch is judged by the newest event
    time of the batches committed before it, less the allowed delay, and raises the
    mark in its own commit.  So a replayed batch is judged by the same mark, and
    on-time rows + late rows = input, whatever the order of the files.
    """
    mark = "event_time"

    def process(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            spark, run = b.sparkSession, run_of(b, _run_of_folder(checkpoint))
            log = CommitLog(spark, root)
            watermark = log.state().marks.get(mark)
            late = F.lit(False) if watermark is None else F.coalesce(
                F.unix_micros("event_time") < F.lit(watermark), F.lit(False))
            rows = b.withColumns({"batch_id": F.lit(batch_id).cast("long"), "is_late": late})
            n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_late").alias("late"),
                         F.unix_micros(F.max("event_time")).alias("newest")).first()
            if not n.n:
                return
            counts = store.ledger_row(spark, run, batch_id, n.n, n.n - n.late, 0, n.late)
            log.commit_batch(run, batch_id, {"on_time": (rows.filter("NOT is_late").drop("is_late"), "event_time", "zone_id"),
                                             "late": (rows.filter("is_late").drop("is_late"), "event_time", "zone_id"),
                                             store.LEDGER: (counts, None, None)},
                             marks={} if n.newest is None else {mark: n.newest - cfg.watermark_seconds * 1_000_000})
        finally:
            b.unpersist()

    return _writer(rides, checkpoint, available_now, cfg).foreachBatch(process).start()


def shared_windows_job(rides: DataFrame, root: str, checkpoint: str, cfg: PricingConfig = DEFAULT,
                       available_now: bool = False):
    """Sliding windows of all configured lengths from one state, in update mode.

    The state of the stream counts requests per zone and 10-second pane; a batch hands
    over the panes that changed.  Every window is a sum of panes, so the windows of 60,
    300 and 900 s that hold a changed pane are summed up anew from the stored panes
    around it (files of other times are not opened) and appended with their batch: the
    newest row of a window is its value.  Panes and windows of a batch are one commit.
    """
    slide, longest = cfg.slide_seconds, max(cfg.window_seconds)
    panes = (rides.withWatermark("event_time", f"{cfg.watermark_seconds} seconds")
             .groupBy(F.window("event_time", f"{slide} seconds").alias("w"), "zone_id", "city")
             .agg(F.count("event_id").alias("n"))
             .select(F.col("w.start").alias("pane_start"), "zone_id", "city", "n",
                     F.floor(F.unix_millis("w.start") / (slide * 1000)).alias("bucket")))

    def process(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()
        try:
            spark = changed.sparkSession
            span = changed.agg(F.min("pane_start").alias("lo"), F.max("pane_start").alias("hi")).first()
            if span.lo is None:
                return
            log, around = CommitLog(spark, root), timedelta(seconds=longest)
            known = changed.select("zone_id", "city", "bucket", "n")
            if "panes" in log.state().schemas:
                known = known.unionByName(log.read("panes", since=span.lo - around, until=span.hi + around).select(*known.columns))
            known = known.groupBy("zone_id", "city", "bucket").agg(F.max("n").alias("n"))  # a pane's count only grows
            all_ = []
            for seconds in cfg.window_seconds:
                w = windows_of_buckets(known, seconds, slide).withColumn("__at", F.floor(F.unix_millis("window_start") / (slide * 1000)))
                touched = changed.select("zone_id", "city", F.explode(F.sequence(
                    F.col("bucket") - (seconds // slide - 1), F.col("bucket"))).alias("__at")).distinct()
                all_.append(w.join(touched, ["zone_id", "city", "__at"], "left_semi").select(
                    F.lit(seconds).alias("seconds"), "window_start", "window_end", "zone_id", "city", "demand"))
            windows = all_[0]
            for more in all_[1:]:
                windows = windows.unionByName(more)
            stamp = lambda df: df.withColumn("batch_id", F.lit(batch_id).cast("long"))
            log.commit_batch(run_of(changed, _run_of_folder(checkpoint)), batch_id,
                             {"panes": (stamp(changed), "pane_start", "zone_id"), "windows": (stamp(windows), "window_start", "zone_id")})
        finally:
            changed.unpersist()

    return _writer(panes, checkpoint, available_now, cfg).outputMode("update").foreachBatch(process).start()


def current_windows(spark, root: str, seconds: int) -> DataFrame:
    """The newest value of every window of one length."""
    w = CommitLog(spark, root).read("windows").filter(F.col("seconds") == seconds)
    return latest_per_key(w, ["window_start", "window_end", "zone_id", "city"], "batch_id").select(
        "window_start", "window_end", "zone_id", "city", "demand")


def weather_job(readings: DataFrame, root: str, checkpoint: str, cfg: PricingConfig = DEFAULT, available_now: bool = False):
    """Weather readings (obs_id, city, updated_at, weathercode, temperature) as versions with a time of validity.

    A reading holds from its time until the next one of its city, and no longer than the
    weather time-to-live.  A batch adds its readings, with their severity, to a version
    table and merges the newest one per city into the `weather` view (the upsert); ends
    follow from the next start and are not stored, so a reading that comes late simply
    falls between its neighbours.  One commit a batch.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        b = batch.select("obs_id", "city", "updated_at", "weathercode", "temperature",
                         wmo_severity(F.col("weathercode")).alias("severity")).persist()
        try:
            if b.isEmpty():
                return
            CommitLog(b.sparkSession, root).commit_batch(
                run_of(b, _run_of_folder(checkpoint)), batch_id,
                {"weather_versions": (b.withColumn("batch_id", F.lit(batch_id).cast("long")), "updated_at", "city")},
                {"weather": (b, "city", ["updated_at", "obs_id"])})
        finally:
            b.unpersist()

    return _writer(readings, checkpoint, available_now, cfg).foreachBatch(process).start()


def weather_versions(spark, root: str, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """All versions with valid_from and valid_to (of equal times the least obs_id comes last)."""
    v = CommitLog(spark, root).read("weather_versions").withColumn("__back", -F.unix_micros("updated_at"))
    # newest first, so that the row before is the next version; blocked, as a city may hold most readings
    stored = checkpointed(in_blocks(v, ["city", "__back", "obs_id"]))
    nxt = last_known(stored, {"__next": F.col("updated_at")}, ["city"], inclusive=False)
    end = F.col("updated_at") + F.expr(f"INTERVAL {cfg.weather_ttl_seconds} SECONDS")
    return nxt.select("obs_id", "city", "weathercode", "temperature", "severity", F.col("updated_at").alias("valid_from"),
                      F.least(F.coalesce("__next", end), end).alias("valid_to"))


def current_weather(spark, root: str, as_of=None, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """The newest reading per city; with `as_of`, without those that have outlived the weather time-to-live."""
    cur = CommitLog(spark, root).view("weather")
    return cur if as_of is None else store.fresh(cur, as_of, cfg.weather_ttl_seconds)


#: No special event lasts longer; it bounds how long rides and events wait for each other.
MAX_EVENT_MINUTES = 240
#: Rides meet the events of their zone and slot of time.
SLOT_MINUTES = 30


def ride_events_stream(rides: DataFrame, calendar: DataFrame, cfg: PricingConfig = DEFAULT,
                       max_minutes: int = MAX_EVENT_MINUTES) -> DataFrame:
    """Rides joined with the special events running in their zone, both as streams.

    Either side may come first; the time range of the condition and the watermarks of
    both sides let the state drop a ride or an event as soon as nothing can meet it.
    The state is kept by zone and slot of time, with an event in every slot it runs in:
    a ride is compared to the events of its slot, not to all of its zone that the state holds.
    """
    delay, slot = f"{cfg.watermark_seconds} seconds", SLOT_MINUTES * 60_000_000
    lasts = F.expr(f"INTERVAL {max_minutes} MINUTES")
    slot_of = lambda t: F.floor(F.unix_micros(t) / F.lit(slot))
    r = rides.withWatermark("event_time", delay).withColumn("__slot", slot_of(F.col("event_time")))
    e = calendar.select(F.col("zone_id").alias("__zone"), F.col("event_id").alias("special_event_id"),
                        F.timestamp_millis("start_ms").alias("start_time"), F.timestamp_millis("end_ms").alias("end_time"),
                        "multiplier").withWatermark("start_time", delay)
    until = F.least(F.col("end_time"), F.col("start_time") + lasts)
    e = (e.filter(until > F.col("start_time"))
         .withColumn("__event_slot", F.explode(F.sequence(slot_of(F.col("start_time")), slot_of(until)))))
    met = ((F.col("zone_id") == F.col("__zone")) & (F.col("__slot") == F.col("__event_slot"))
           & (F.col("event_time") >= F.col("start_time")) & (F.col("event_time") < F.col("start_time") + lasts)
           & (F.col("event_time") < F.col("end_time")))
    return r.join(e, met).drop("__zone", "__slot", "__event_slot")


EVENT_STATE_OUT = "zone_id string, event_id string, start_ms long, end_ms long, multiplier double"


class OneEventAtATime(StatefulProcessor):
    """Per zone: at most one special event at a time, whatever the order of arrival.

    Starts wait in the state until the watermark has passed them, so they are decided
    in start order: a start while the accepted event is still running is refused.  An
    event-time timer at the earliest start that waits decides all starts behind the
    watermark in one pass and is set anew for the earliest one left, so a start is read
    once, not once for every other start of its zone.  Another timer at the end of the
    accepted event clears the zone's state.  A call sees the rows of one zone and one
    micro-batch in Arrow batches; the state holds the starts that still wait and one end.
    """

    #: Waiting starts that go to the state in one message.
    APPENDED = 5_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "start_ms long, event_id string, end_ms long, multiplier double")
        self.running = handle.getValueState("running", "end_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            starts = [(int(start), event, int(stop), float(multiplier)) for start, event, stop, multiplier in
                      zip(part["start_ms"], part["event_id"], part["end_ms"], part["multiplier"])]
            for i in range(0, len(starts), self.APPENDED):
                self.waiting.appendList(starts[i:i + self.APPENDED])
            first = min([s[0] for s in starts] + ([] if first is None else [first]), default=None)
        if first is not None:
            self.handle.registerTimer(first)
        yield pd.DataFrame(columns=["zone_id", "event_id", "start_ms", "end_ms", "multiplier"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = {(start, event): (stop, multiplier) for start, event, stop, multiplier in self.waiting.get()}  # a start that came again counts once
        due = sorted(k for k in waiting if k[0] < watermark)
        end = self.running.get()[0] if self.running.exists() else None
        accepted = []
        for start, event in due:
            stop, multiplier = waiting.pop((start, event))
            if end is None or start >= end:
                end = stop
                accepted.append((key[0], event, start, stop, multiplier))
        if due:
            self.waiting.clear()
            left = [(*k, *v) for k, v in waiting.items()]
            for i in range(0, len(left), self.APPENDED):
                self.waiting.appendList(left[i:i + self.APPENDED])
            if left:
                self.handle.registerTimer(min(x[0] for x in left))
        if end is not None and end < watermark:
            self.running.clear()
        elif accepted:
            self.running.update((end,))
            self.handle.registerTimer(end)
        yield pd.DataFrame(accepted, columns=["zone_id", "event_id", "start_ms", "end_ms", "multiplier"])

    def close(self) -> None:
        pass


def event_state_stream(calendar: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """The accepted events of a stream of event starts (zone_id, event_id, start_ms,
    end_ms, multiplier), each emitted once the watermark has passed its start.  Needs
    the RocksDB state store (`rocksdb_state`)."""
    timed = (calendar.withColumn("start_time", F.timestamp_millis("start_ms"))
             .withWatermark("start_time", f"{cfg.watermark_seconds} seconds"))
    return timed.groupBy("zone_id").transformWithStateInPandas(
        OneEventAtATime(), EVENT_STATE_OUT, "Append", "EventTime")


def rocksdb_state(spark) -> None:
    """State off the heap with incremental checkpoints, which timers and map states need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
