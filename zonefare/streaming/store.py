"""The pricing store: surge history, current view, dead letters, features, batch ledger.

All of them live in one commit log (streaming/commitlog.py).  A micro-batch is one
commit: its history rows, the merged current view, its dead letters and a ledger row
appear together or not at all, a replayed batch is left out, and several streams may
write into one root.

* history: append-only, one date per file; reads choose files by zone and time range,
  `compact_history` clusters a date by zone, `expire_history` drops expired files;
* current: snapshot of the latest row per zone; the time-to-live is applied at read
  time against an explicit `as_of`;
* ledger: rows read, valid, failed and late of every batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, PricingConfig
from zonefare.streaming.commitlog import CommitLog

HISTORY, CURRENT, DEAD_LETTERS, FEATURES, LATEST_FEATURES, LEDGER = (
    "history", "current", "dead_letters", "features", "latest_features", "ledger")

# Column defaults of a history row (missing or null values are filled).
HISTORY_DEFAULTS = {
    "demand_1min": 0, "demand_5min": 0, "demand_15min": 0, "available_drivers": 0,
    "supply_ratio": 0.0, "rule_multiplier": 1.0, "ml_multiplier": 1.0, "final_multiplier": 1.0,
    "ml_confidence": 0.0, "is_special_event": False, "weather_severity": 1,
}

LEDGER_SCHEMA = "run string, batch_id long, payloads long, valid long, failed long, late long"


def history_row(df: DataFrame) -> DataFrame:
    """Project any surge-shaped frame to the history schema with defaults;
    a missing timestamp becomes the current time."""
    from zonefare.schemas import SURGE_HISTORY_SCHEMA
    cols = []
    for f in SURGE_HISTORY_SCHEMA.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in HISTORY_DEFAULTS:
            c = F.coalesce(c, F.lit(HISTORY_DEFAULTS[f.name]))
        elif f.name == "timestamp":
            c = F.coalesce(c, F.current_timestamp())
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def ledger_row(spark: SparkSession, run: str, batch_id: int, payloads: int, valid: int, failed: int, late: int = 0) -> DataFrame:
    return spark.createDataFrame([(run, batch_id, payloads, valid, failed, late)], LEDGER_SCHEMA)


def commit_prices(spark: SparkSession, root: str, run: str, batch_id: int, rows: DataFrame,
                  dead: DataFrame | None = None, counts: dict | None = None) -> bool:
    """One micro-batch: zone prices into history and current view, its dead letters and ledger row.

    Rows of the current view carry `updated_at` (the row's time) and `cached_at`.
    """
    stamp = lambda df: df.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
    appends = {HISTORY: (stamp(history_row(rows)), "timestamp", "zone_id")}
    if dead is not None:
        appends[DEAD_LETTERS] = (stamp(dead), None, None)
    if counts is not None:
        appends[LEDGER] = (ledger_row(spark, run, batch_id, **counts), None, None)
    current = rows.withColumns({"updated_at": F.col("timestamp"), "cached_at": F.current_timestamp()})
    return CommitLog(spark, root).commit_batch(run, batch_id, appends, {CURRENT: (current, "zone_id", ["updated_at", "city"])})


def read_history(spark: SparkSession, root: str, zone: str | None = None, since=None, until=None) -> DataFrame:
    """History rows (all, or of one zone and time range); files outside the range are not opened."""
    h = CommitLog(spark, root).read(HISTORY, zone, since, until).withColumn("date", F.to_date("timestamp"))
    if zone is not None:
        h = h.filter(F.col("zone_id") == zone)
    if since is not None:
        h = h.filter(F.col("timestamp") >= F.lit(since).cast("timestamp"))
    if until is not None:
        h = h.filter(F.col("timestamp") <= F.lit(until).cast("timestamp"))
    return h


def fresh(current: DataFrame, as_of, ttl_seconds: int, stamp: str = "updated_at") -> DataFrame:
    """Rows whose age at `as_of` is under the time-to-live."""
    t = F.lit(as_of).cast("timestamp")
    return current.filter((F.unix_seconds(t) - F.unix_seconds(stamp)) < ttl_seconds)


def read_current(spark: SparkSession, root: str, as_of=None, ttl_seconds: int | None = None,
                 cfg: PricingConfig = DEFAULT) -> DataFrame:
    """The current view; with `as_of`, without the zones whose row has outlived the surge time-to-live."""
    cur = CommitLog(spark, root).view(CURRENT)
    if as_of is None:
        return cur
    return fresh(cur, as_of, cfg.surge_ttl_seconds if ttl_seconds is None else ttl_seconds)


def read_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return CommitLog(spark, root).read(DEAD_LETTERS)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return CommitLog(spark, root).read(LEDGER)


def compact_history(spark: SparkSession, root: str, min_files: int = 8) -> int:
    return CommitLog(spark, root).compact(HISTORY, "timestamp", "zone_id", min_files)


def expire_history(spark: SparkSession, root: str, as_of, cfg: PricingConfig = DEFAULT) -> int:
    """Drop the history files that hold expired rows only; `retained` hides expired rows of the other files."""
    return CommitLog(spark, root).expire(HISTORY, as_of, cfg.history_retention_seconds)


def retained(history: DataFrame, as_of, retention_seconds: int, ts: str = "timestamp") -> DataFrame:
    """Rows inside the retention span (its start excluded, `as_of` included)."""
    t = F.lit(as_of).cast("timestamp")
    lo = t - F.expr(f"INTERVAL {retention_seconds} SECONDS")
    return history.filter((F.col(ts) > lo) & (F.col(ts) <= t))


def commit_features(spark: SparkSession, root: str, run: str, batch_id: int, features: DataFrame) -> bool:
    """Feature rows of one batch: appended to the feature table, and upserted as the latest row per zone."""
    rows = features.withColumn("batch_id", F.lit(batch_id).cast("long"))
    return CommitLog(spark, root).commit_batch(run, batch_id, {FEATURES: (rows, "timestamp", "zone_id")},
                                               {LATEST_FEATURES: (features, "zone_id", ["timestamp", "city"])})


def read_features(spark: SparkSession, root: str) -> DataFrame:
    return CommitLog(spark, root).read(FEATURES)


def expire_features(spark: SparkSession, root: str, as_of, cfg: PricingConfig = DEFAULT) -> int:
    return CommitLog(spark, root).expire(FEATURES, as_of, cfg.feature_retention_seconds)


def latest_features(spark: SparkSession, root: str, as_of=None, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Newest feature row per zone; with `as_of`, those younger than twice the surge time-to-live."""
    cur = CommitLog(spark, root).view(LATEST_FEATURES)
    return cur if as_of is None else fresh(cur, as_of, 2 * cfg.surge_ttl_seconds, "timestamp")
