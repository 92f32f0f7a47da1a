"""Adapter from the driver's generic ``events`` table to click events.

The driver's ``events`` (event_id, ts, user_id, event_type, value, props)
have no page, session, device or region.  The adapter derives them with
Spark expressions only, and plants NULLs on purpose so that every NULL rule
of the data model is exercised (see FIXTURES.md).  The same derivation is
written as DuckDB SQL in :mod:`clickmart.plans.oracle` for the oracle check.

Sessions of the fixture come from the skew-safe :func:`sessionize` (gap 1
day), so the adapter itself scales the same way as the library.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators.sessions import sessionize
from clickmart.sinks import files

# --- fixed values of the fixture (FIXTURES.md section 4) --------------------
FIXTURE_EPOCH = "2024-01-01"          # batch_id = days since this date
SESSION_GAP_SECONDS = 86_400          # adapter session gap: 1 day
NULL_USER_EVERY = 97                  # event_id % 97 = 0  -> user NULL
NULL_TIME_EVERY = 83                  # event_id % 83 = 0  -> time NULL / 'not-a-time'
NULL_SESSION_EVERY = 61               # event_id % 61 = 0  -> session NULL
NULL_DEVICE_EVERY = 50                # event_id % 50 = 0  -> device NULL
NULL_REGION_EVERY = 70                # event_id % 70 = 0  -> region NULL
GARBAGE_EVERY = 194                   # event_id % 194 = 0 -> undecodable wire record
DUPLICATE_EVERY = 40                  # K8 input: rows with event_id % 40 = 0 sent twice
TWIN_EVERY = 45                       # K8 input: rows with event_id % 45 = 0 have a look-alike
TWIN_DEVICE, TWIN_OFFSET = "tv", 1_000_000_000  # its device, and what its offset is higher by
TOPIC = "clickstream-events"
TYPE_MAP = {"view": "PAGE_VIEW", "click": "ADD_TO_CART", "purchase": "PURCHASE", "signup": "LOGIN"}  # else LOGOUT
DEVICES = ("mobile", "desktop", "tablet")                 # by k % 3
REGIONS = ("us-east-1", "us-west-2", "eu-central-1")      # by user_id % 3
REFERRER = "/home"
NOW = dt.datetime(2024, 1, 31, 0, 0, 0)                   # dashboard "now"
TIME_FROM = dt.datetime(2024, 1, 15, 0, 0, 0)             # dashboard range
TIME_TO = dt.datetime(2024, 1, 31, 0, 0, 0)
# N3 alert fixture: error predicate, window, threshold (per second), hold.
ALERT_EVENT_TYPE = "error"
ALERT_WINDOW_SECONDS = 6 * 3600
ALERT_THRESHOLD = 0.0009
ALERT_HOLD = 2
# ---------------------------------------------------------------------------


# Schema of the driver's ``events`` table; given explicitly so no job is run
# to infer it from file footers.
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _every(n: int) -> F.Column:
    return F.col("event_id") % n == 0


def _pick(index: F.Column, values: tuple[str, ...]) -> F.Column:
    expr = F.when(index == 0, values[0])
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(index == i, v)
    return expr


_MATERIALIZED: dict[tuple, DataFrame] = {}
_LOCK = threading.Lock()


def _shared_dir(spark: SparkSession) -> str | None:
    try:
        conf = spark.sparkContext.getConf()
    except Exception:  # a remote (Spark Connect) session has no SparkContext
        return None
    return spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived click events, including those without a user (which the
    decoder drops).  Keeps ``event_id`` and the original time ``_ts``.

    The derivation stands in for the stored ``clickstream_events`` table, so
    it runs once per application and input: the result is written as Parquet
    under the shared ``spark.checkpoint.dir`` (lineage cut, recoverable after
    executor loss), and every query scans that table with its own columns and
    filters.  Changed input files (name, size, time, on any file system) are
    derived anew.  Without a shared folder (or without a SparkContext, as in a
    remote session) the plan stays lazy.
    """
    root = _shared_dir(spark)
    if root is None:
        return derive_raw_clicks(spark, sf_dir)
    stamp = files.stamp(spark, f"{sf_dir}/events.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, stamp)
    with _LOCK:  # queries started from several threads derive the copy once
        if key not in _MATERIALIZED:
            name = hashlib.sha256(repr(key).encode()).hexdigest()[:16]
            path = f"{root.rstrip('/')}/clickmart-fixture-{name}"
            df = derive_raw_clicks(spark, sf_dir)
            # Spread the copy like the many files of a stored table (the one
            # input file would otherwise make every scan a single task);
            # round-robin, so no key can skew it.
            df.repartition(spark.sparkContext.defaultParallelism).write.mode("overwrite").parquet(path)
            _MATERIALIZED[key] = spark.read.schema(df.schema).parquet(path)
        return _MATERIALIZED[key]


def derive_raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter itself: driver events -> click events (see :func:`raw_clicks`)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = driver_events(spark, sf_dir).select(
        "event_id", F.col("ts").alias("_ts"), "user_id", "event_type", "value", k.alias("k")
    ).withColumn("uid", F.lit(1000) + F.col("user_id") * 10 + F.col("k") % 8)
    e = sessionize(e, user="uid", ts="_ts", gap_seconds=SESSION_GAP_SECONDS, out="sn")

    et = F.col("event_type")
    event_type = F.lit("LOGOUT")
    for src, dst in reversed(list(TYPE_MAP.items())):
        event_type = F.when(et == src, dst).otherwise(event_type)
    uid = F.col("uid").cast("string")
    return e.select(
        "event_id",
        F.when(~_every(NULL_USER_EVERY), F.concat(F.lit("u"), uid)).alias("user_id"),
        F.concat(F.lit("/products/"), (F.lit(100) + F.col("k")).cast("string")).alias("page_url"),
        event_type.alias("event_type"),
        F.when(~_every(NULL_TIME_EVERY), F.col("_ts")).alias("timestamp"),
        F.when(~_every(NULL_SESSION_EVERY), F.concat(F.lit("s"), uid, F.lit("-"), F.col("sn").cast("string"))).alias("session_id"),
        F.when(~_every(NULL_DEVICE_EVERY), _pick(F.col("k") % 3, DEVICES)).alias("device"),
        F.when(~_every(NULL_REGION_EVERY), _pick(F.col("user_id") % 3, REGIONS)).alias("region"),
        F.lit(REFERRER).alias("referrer"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.datediff(F.to_date("_ts"), F.lit(FIXTURE_EPOCH).cast("date")).cast("bigint").alias("batch_id"),
        "_ts",
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded click events with ``batch_id`` (= day) and ``amount``: the
    input of every mart and query."""
    return raw_clicks(spark, sf_dir).filter(F.col("user_id").isNotNull()).drop("_ts")


def metric_ts() -> F.Column:
    """Fixture ``metric_timestamp``: midnight after the batch's day."""
    return F.date_add(F.lit(FIXTURE_EPOCH).cast("date"), (F.col("batch_id") + 1).cast("int")).cast("timestamp_ntz")


def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click events as a Kafka-shaped frame (key, value, topic, partition,
    offset, timestamp) plus ``batch_id``: JSON text with the wire names, the
    event time written as ISO text (``not-a-time`` where the fixture nulls
    it), and a non-JSON value every ``GARBAGE_EVERY`` events."""
    r = raw_clicks(spark, sf_dir)
    event_time = F.when(_every(NULL_TIME_EVERY), F.lit("not-a-time")).otherwise(
        F.date_format("_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    body = F.to_json(F.struct(
        F.col("user_id").alias("userId"), F.col("session_id").alias("sessionId"),
        F.col("event_type").alias("eventType"), event_time.alias("eventTime"),
        F.col("page_url").alias("page"), "referrer", "device", "region", F.col("amount").cast("string").alias("amount"),
    ))
    value = F.when(_every(GARBAGE_EVERY), F.concat(F.lit("garbage-"), F.col("event_id").cast("string"))).otherwise(body)
    return r.select(
        F.col("session_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("_ts").alias("timestamp"),
        "batch_id",
    )


def duplicated_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 input: ``clicks`` with their source's identity, a second copy of every
    ``DUPLICATE_EVERY``-th (a redelivery: the same identity), and for every
    ``TWIN_EVERY``-th another event that equals it in user, session, type, time
    and page but came from another device at an offset of its own."""
    c = clicks(spark, sf_dir).withColumns({
        "topic": F.lit(TOPIC), "partition": (F.col("event_id") % 3).cast("int"), "offset": F.col("event_id")})
    twins = c.filter(_every(TWIN_EVERY)).withColumn("device", F.lit(TWIN_DEVICE)).withColumn("offset", F.col("offset") + TWIN_OFFSET)
    return c.unionByName(c.filter(_every(DUPLICATE_EVERY))).unionByName(twins)
