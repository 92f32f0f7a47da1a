"""Event-time operators: tumbling and sliding windows, deduplication, the
active-session gauge and the windowed error-rate alert.

Each function works on a bounded DataFrame and, but for the alert, on a
streaming one (the alert looks back over rows, so on a stream it runs over the
stored window counts: :func:`alert_over_counts`).  For a stream pass ``watermark`` (e.g. ``"10 minutes"``): the event-time column
must then be a zoned TIMESTAMP (``withWatermark`` rejects TIMESTAMP_NTZ),
late rows leave the window aggregates, and the state of closed windows is
dropped.  Exact distinct counts are not allowed on streams, so stream
callers use the ``approx`` forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions import epoch_micros, floor_div
from clickmart.schema import IDENTITY


def _watermarked(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    return df.withWatermark(ts, watermark) if watermark else df


def _flat(w: str = "_w") -> list[Column]:
    return [F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


def _seconds(text: str) -> int | None:
    """Seconds of an interval like ``10 minutes``; None for others."""
    n, _, unit = text.strip().partition(" ")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}.get(unit.strip().rstrip("s").lower())
    return int(n) * scale if scale and n.isdigit() else None


def _whole_multiple(width: str, slide: str) -> bool:
    w, s = _seconds(width), _seconds(slide)
    return bool(w and s and w % s == 0)


def tumbling_event_counts(
    ev: DataFrame, width: str = "5 minutes", ts: str = "timestamp", watermark: str | None = None
) -> DataFrame:
    """K5: events per event type per tumbling event-time window."""
    d = _watermarked(ev, ts, watermark)
    return d.groupBy(F.window(ts, width).alias("_w"), "event_type").agg(F.count(F.lit(1)).alias("events")).select(
        *_flat(), "event_type", "events"
    )


def sliding_active_users(
    ev: DataFrame,
    width: str = "1 hour",
    slide: str = "10 minutes",
    ts: str = "timestamp",
    watermark: str | None = None,
    approx: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """K6: distinct users per sliding window (exact in batch; ``approx`` for
    streams, HyperLogLog++ with relative error ``rsd``).

    Where the width is a whole number of slides, exact counts come from
    intervals (:func:`_active_by_intervals`), whose rows do not grow with that
    number."""
    if not approx and not watermark and not ev.isStreaming and _whole_multiple(width, slide):
        return _active_by_intervals(ev, _seconds(width), _seconds(slide), ts)
    d = _watermarked(ev, ts, watermark)
    users = F.approx_count_distinct("user_id", rsd) if approx else F.count_distinct("user_id")
    return d.groupBy(F.window(ts, width, slide).alias("_w")).agg(users.alias("active_users")).select(*_flat(), "active_users")


def _active_by_intervals(ev: DataFrame, width: int, slide: int, ts: str) -> DataFrame:
    """Exact distinct users per sliding window, from +1 and -1.

    A slide in which a user is seen makes them active in the windows that start at
    it and at the ``width / slide - 1`` slides before.  Of these the windows up to
    the user's slide before are covered already, so each slide adds one interval
    of windows that no other interval of the user holds: +1 where it begins, -1
    behind its end.  Summed per window start and then along them, that is the
    number of users.  Events shrink to one row per user and slide before they
    move; the window over a user's slides and the one over all window starts run
    over rows bounded by the time span.  A NULL user is nobody, but their events
    make a window appear, with 0 users."""
    dtype, reach = ev.schema[ts].dataType, width // slide
    at = floor_div(epoch_micros(ts, dtype), F.lit(slide * 1_000_000))
    seen = ev.filter(F.col(ts).isNotNull()).select("user_id", at.alias("_s")).distinct()
    before = F.lag("_s").over(Window.partitionBy("user_id").orderBy("_s"))
    seen = seen.withColumn("_from", F.greatest(F.col("_s") - (reach - 1), before + 1))
    known = F.col("user_id").isNotNull().cast("bigint")
    ends = F.array(F.struct(F.col("_from").alias("_k"), known.alias("_users"), F.lit(1).alias("_any")),
                   F.struct((F.col("_s") + 1).alias("_k"), (-known).alias("_users"), F.lit(-1).alias("_any")))
    steps = seen.select(F.inline(ends)).groupBy("_k").agg(F.sum("_users").alias("_users"), F.sum("_any").alias("_any"))
    along = Window.orderBy("_k")
    steps = steps.select("_k", F.lead("_k").over(along).alias("_next"), F.sum("_users").over(along).alias("active_users"), F.sum("_any").over(along).alias("_any"))
    # Between two steps the number stays as it is.
    rows = steps.filter("_any > 0").select(F.explode(F.sequence("_k", F.col("_next") - 1)).alias("_k"), "active_users")
    return rows.select(_slide_time("_k", slide, dtype).alias("window_start"), _slide_time("_k", slide, dtype, width).alias("window_end"), "active_users")


def _slide_time(k: str, slide: int, dtype: T.DataType, plus: int = 0) -> Column:
    """The time ``k`` slides and ``plus`` seconds after 1970-01-01 00:00."""
    seconds = F.col(k) * slide + plus
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_seconds(seconds)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=floor_div(seconds, F.lit(86_400)).cast("int"), secs=F.pmod(seconds, F.lit(86_400)).cast("decimal(18,6)"))


def approx_uniques_windowed(
    ev: DataFrame, width: str = "1 hour", ts: str = "timestamp", watermark: str | None = None, rsd: float = 0.05
) -> DataFrame:
    """Streaming-safe distinct users and sessions per tumbling window
    (HyperLogLog++ sketches merge map-side, so no value list is shuffled)."""
    d = _watermarked(ev, ts, watermark)
    return d.groupBy(F.window(ts, width).alias("_w")).agg(
        F.count(F.lit(1)).alias("events"),
        F.approx_count_distinct("user_id", rsd).alias("approx_users"),
        F.approx_count_distinct("session_id", rsd).alias("approx_sessions"),
    ).select(*_flat(), "events", "approx_users", "approx_sessions")


def active_sessions(
    ev: DataFrame, width: str = "30 minutes", ts: str = "timestamp", watermark: str | None = None, approx: bool = False
) -> DataFrame:
    """Gauge of active sessions = distinct session ids per window."""
    d = _watermarked(ev, ts, watermark)
    sessions = F.approx_count_distinct("session_id") if approx else F.count_distinct("session_id")
    return d.groupBy(F.window(ts, width).alias("_w")).agg(sessions.alias("active_sessions")).select(*_flat(), "active_sessions")


def approx_uniques_check(ev: DataFrame, width: str = "1 hour", ts: str = "timestamp", rsd: float = 0.05, sigmas: int = 4) -> DataFrame:
    """D13 beside the exact figures: per window the events, the exact distinct
    users and sessions, and whether the estimates lie within ``sigmas`` times
    the stated error (at least one) of them."""
    exact = ev.groupBy(F.window(ts, width).alias("_w")).agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("session_id").alias("sessions")).select(*_flat(), "users", "sessions")
    near = lambda est, n: F.abs(F.col(est) - F.col(n)) <= F.greatest(F.lit(1.0), F.col(n) * (sigmas * rsd))
    return approx_uniques_windowed(ev, width, ts, rsd=rsd).join(exact, ["window_start", "window_end"]).select(
        "window_start", "window_end", "events", "users", "sessions",
        near("approx_users", "users").alias("users_within"), near("approx_sessions", "sessions").alias("sessions_within"))


def dedup_events(
    ev: DataFrame, keys: Sequence[str] = IDENTITY, ts: str = "timestamp", watermark: str | None = None
) -> DataFrame:
    """K8: drop repeated deliveries of the same record, told by its identity: the
    source's topic, partition and offset, or an event id of the caller's.

    Events that merely look alike are different events.  In batch, rows
    without a full identity are all kept.  On a stream the state is bounded by
    the watermark (``dropDuplicatesWithinWatermark``), and NULL keys count as
    equal there, so give keys that are never NULL."""
    keys = list(keys)
    if watermark:
        return ev.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    alone = F.when(~known, F.monotonically_increasing_id())
    return ev.withColumn("_alone", alone).dropDuplicates([*keys, "_alone"]).drop("_alone")


def error_rate_alert(
    events: DataFrame,
    predicate: Column,
    window_seconds: int = 300,
    threshold_per_second: float = 0.1,
    hold: int = 2,
    ts: str = "ts",
) -> DataFrame:
    """Per tumbling window, the number of matching events, their rate
    per second, whether the rate is above the threshold, and whether the
    alert fires -- the window and the ``hold - 1`` windows right before it
    are all above.

    Windows without a matching event are absent (their rate is 0, so they
    are never above); the firing test therefore looks back by *time* -- a
    RANGE frame over the window start -- not by row count.  The events are
    scanned once; the window function runs over the per-window table, which
    has one row per window (bounded by time span / width, not by data
    volume), so its single partition stays small.
    """
    width = int(window_seconds)
    per_window = events.filter(predicate).groupBy(F.window(ts, f"{width} seconds").alias("_w")).agg(
        F.count(F.lit(1)).alias("errors")
    ).select(*_flat(), "errors")
    return alert_over_counts(per_window, width, threshold_per_second, hold)


def alert_over_counts(per_window: DataFrame, window_seconds: int, threshold_per_second: float = 0.1, hold: int = 2) -> DataFrame:
    """N3 over one row per window (window_start, window_end, errors): the form for
    streams, whose window counts :func:`clickmart.streaming.pipeline.start_window_counts`
    stores."""
    width = int(window_seconds)
    rate = F.col("errors").cast("double") / F.lit(float(width))
    above = rate > F.lit(float(threshold_per_second))
    dtype = per_window.schema["window_start"].dataType
    start_seconds = floor_div(epoch_micros("window_start", dtype), F.lit(1_000_000))
    recent = Window.orderBy("_start_s").rangeBetween(-(int(hold) - 1) * width, 0)
    return (
        per_window.select("window_start", "window_end", "errors", rate.alias("error_rate"),
                          above.alias("above_threshold"), start_seconds.alias("_start_s"))
        .withColumn("firing", F.sum(F.col("above_threshold").cast("int")).over(recent) == int(hold))
        .drop("_start_s")
    )
