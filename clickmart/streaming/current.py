"""Current tables and corrected window counts that the job keeps.

``user_behavior_current`` and ``device_analytics_current`` hold the exact rows of
the functions of the same names in :mod:`clickmart.operators.marts`, kept by
ledgers: after any number of batches, in any order, replayed or not, they equal
what those functions give over all raw events.

Window counts: a window is closed once the watermark (latest event time seen less
``delay``) has passed its end, and its counts are published then.  Late events
still count: the closed windows they fall in are published again with their new
totals and a higher version, and the late events themselves are rows of the
``late_events`` table.
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions import epoch_micros, pct2
from clickmart.operators.windows import _seconds
from clickmart.schema import PURCHASE, RAW_EVENT_COLUMNS, TABLE_DIMENSIONS, TABLE_USERS
from clickmart.sinks import files
from clickmart.sinks.tables import replace_batch, table_path
from clickmart.streaming.ledger import TOTALS, Ledger, State, apply_batch, hashed, read_state, read_totals, stored_table

LATE_TABLE = "late_events"
PUBLISHED = "published"

USERS = Ledger(
    name=f"{TABLE_USERS}_current", keys={"user_id": "string"}, member="session_id", levels=("sessions",), sums=("events", "purchases"),
    peaks={"last_active": "timestamp_ntz"}, bucket=lambda: hashed("user_id", "member"), total_bucket=lambda: hashed("user_id", buckets=8))
DIMENSIONS = Ledger(
    name=f"{TABLE_DIMENSIONS}_current", keys={"dimension_type": "string", "dimension_value": "string"}, member="user_id",
    levels=("unique_users", "buyers"), sums=("event_count",),
    bucket=lambda: hashed("dimension_type", "dimension_value", "member"), total_bucket=lambda: F.col("dimension_type"))


def window_ledger(width: str) -> Ledger:
    """Counts per event type and tumbling window, by days."""
    day = lambda: F.date_format("window_start", "yyyy-MM-dd")
    return Ledger(name=f"window_counts_{width.replace(' ', '_')}", keys={"window_start": "timestamp_ntz", "window_end": "timestamp_ntz", "event_type": "string"},
                  member="user_id", levels=("users",), sums=("events",), bucket=day, total_bucket=day)


def _as_ntz(ev: DataFrame) -> DataFrame:
    return ev.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def keep_users(ev: DataFrame, root: str, stream: str, batch_id: int) -> bool:
    """Add a batch of decoded events to ``user_behavior_current``; False if it is in."""
    buys = (F.col("event_type") == PURCHASE).cast("int")
    rows = _as_ntz(ev).select("user_id", "session_id", F.lit(1).alias("events"), F.coalesce(buys, F.lit(0)).alias("purchases"), F.col("timestamp").alias("last_active"))
    return apply_batch(ev.sparkSession, root, USERS, rows, stream, batch_id)


def keep_dimensions(ev: DataFrame, root: str, stream: str, batch_id: int, region_label: str = "region") -> bool:
    """Add a batch of decoded events to ``device_analytics_current``."""
    both = F.array(F.struct(F.lit("device").alias("dimension_type"), F.col("device").alias("dimension_value")),
                   F.struct(F.lit(region_label).alias("dimension_type"), F.col("region").alias("dimension_value")))
    bought = F.coalesce((F.col("event_type") == PURCHASE).cast("int"), F.lit(0))
    rows = ev.select("user_id", bought.alias("level"), F.lit(1).alias("event_count"), F.inline(both))
    return apply_batch(ev.sparkSession, root, DIMENSIONS, rows, stream, batch_id)


def read_users(spark: SparkSession, root: str) -> DataFrame:
    """user_id, sessions, events, purchases, last_active over all batches kept."""
    return read_totals(spark, root, USERS).select("user_id", "sessions", "events", "purchases", "last_active")


def read_dimensions(spark: SparkSession, root: str) -> DataFrame:
    """The rows of ``device_analytics_current`` over all batches kept."""
    return read_totals(spark, root, DIMENSIONS).select(
        "dimension_type", "dimension_value", "event_count", "unique_users", pct2("buyers", "unique_users").alias("conversion_rate"))


# --- windows -----------------------------------------------------------------

PUBLISHED_DDL = "window_start timestamp_ntz, window_end timestamp_ntz, event_type string, events bigint, users bigint, version bigint, run string, bucket string"
KEYS = ("window_start", "window_end", "event_type")


def _newest(published: DataFrame) -> DataFrame:
    """Of every window and type the row of the highest version.  Types never leave
    a window, so these rows are its newest publication."""
    row = F.max_by(F.struct("events", "users", "version"), "version").alias("_row")
    return published.groupBy(*KEYS).agg(row).select(*KEYS, "_row.*")


def keep_windows(ev: DataFrame, root: str, stream: str, batch_id: int, width: str = "5 minutes", delay: str = "10 minutes",
                 batch_date: dt.date | None = None) -> bool:
    """Add a batch of decoded events to the window counts of ``width``; False if it
    is in.  Events without a time are in no window.  Events of windows that were
    closed before this batch are also written to ``late_events``."""
    spark, ledger = ev.sparkSession, window_ledger(width)
    state = read_state(spark, root, ledger)
    if state.has(stream, batch_id):
        return False
    timed = _as_ntz(ev).filter(F.col("timestamp").isNotNull()).withColumn("_w", F.window("timestamp", width))
    timed = timed.withColumn("window_start", F.col("_w.start")).withColumn("window_end", F.col("_w.end")).drop("_w")
    micros = lambda c: epoch_micros(c, T.TimestampNTZType())
    newest = timed.agg(F.max(micros("timestamp")).alias("n")).first().n
    wait, length = _seconds(delay), _seconds(width)
    if wait is None or not length:
        raise ValueError(f"not a span of whole seconds: {delay!r} or {width!r}")

    def mark(old: State) -> int | None:
        seen = [m for m in (old.mark, None if newest is None else newest - wait * 1_000_000) if m is not None]
        return max(seen, default=None)

    def write_late(old: State) -> None:
        # Written before the commit: a replay of a batch that was not committed finds the same mark and writes the same rows.
        if old.mark is None:
            return
        late = timed.filter(micros("window_end") <= F.lit(old.mark)).select(
            *[c for c in RAW_EVENT_COLUMNS if c in timed.columns], "window_start", F.lit(old.mark).alias("watermark_micros"))
        late = late.withColumn("batch_date", F.lit(batch_date).cast("date")).withColumn("stream_id", F.lit(stream)).withColumn("batch_id", F.lit(int(batch_id)))
        replace_batch(late, root, LATE_TABLE, ("batch_date", "stream_id", "batch_id"), stream, batch_id)

    def publish(old: State, own: DataFrame) -> dict[str, DataFrame]:
        write_late(old)
        passed = mark(old)
        end = micros("window_end")
        if passed is None:
            return {}
        was = F.lit(False) if old.mark is None else end <= F.lit(old.mark)
        # Those closed by this batch, and those closed before that it adds to; only their days are read.
        corrected = own.filter(was).select("window_start").distinct()
        low = "" if old.mark is None else str((dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=old.mark, seconds=-length)).date())
        days = [r.bucket for r in own.filter(was).select("bucket").distinct().collect()]
        before = stored_table(spark, root, ledger, old, TOTALS).filter((F.col("bucket") >= low) | F.col("bucket").isin(days))
        totals = before.unionByName(own).groupBy(*ledger.keys).agg(F.sum("events").alias("events"), F.sum("users").alias("users"))
        closing = totals.filter((end <= F.lit(passed)) & ~was)
        again = totals.filter(was).join(corrected, "window_start", "left_semi")
        out = closing.unionByName(again).withColumn("version", F.lit(old.seq + 1).cast("bigint"))
        return {PUBLISHED: out.withColumn("bucket", F.date_format("window_start", "yyyy-MM-dd"))}

    rows = timed.select("window_start", "window_end", "event_type", "user_id", F.lit(1).alias("events"))
    return apply_batch(spark, root, ledger, rows, stream, batch_id, mark, publish, WINDOW_FOLDS)


# Of every window the newest publication stays.
WINDOW_FOLDS = {PUBLISHED: lambda d: _newest(d).withColumn("bucket", F.date_format("window_start", "yyyy-MM-dd"))}


def read_windows(spark: SparkSession, root: str, width: str = "5 minutes") -> DataFrame:
    """Closed windows: window_start, window_end, event_type, events, users and the
    version (number of the commit) that holds."""
    ledger = window_ledger(width)
    return _newest(stored_table(spark, root, ledger, read_state(spark, root, ledger), PUBLISHED, T.StructType.fromDDL(PUBLISHED_DDL)))


def read_late(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The late events so far, with the window they belong to and the watermark
    that had passed it."""
    fields = ", ".join(f"{c} {'timestamp_ntz' if c == 'timestamp' else 'string'}" for c in RAW_EVENT_COLUMNS)
    schema = schema or T.StructType.fromDDL(f"{fields}, window_start timestamp_ntz, watermark_micros bigint, batch_date date, stream_id string, batch_id bigint")
    path = table_path(root, LATE_TABLE)
    return spark.read.schema(schema).parquet(path) if files.path_exists(spark, path) else spark.createDataFrame([], schema)

