"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables under ``sf_dir`` (through the fixture
adapter) and builds one lazy Spark plan; nothing is collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions import ntz_lit
from clickmart.operators import bitmaps, marts, sessions, windows
from clickmart.plans import panels as P
from clickmart.plans.dashboard import PANELS, bind
from clickmart.schema import AMOUNT, RAW_EVENT_COLUMNS
from clickmart.sinks.publish import publish_events
from clickmart.sinks.tables import conform, scratch_root
from clickmart.sources import decode, fixture as fx
from clickmart.streaming import current, observe

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.clicks(spark, sf_dir)


class LazyTables(Mapping):
    """The five stored tables derived from the fixture, each built on first use
    (so a query only plans the tables it reads), with the stored schema."""

    _BUILDERS = {
        "clickstream_events": lambda ev: marts.raw_events(ev, with_created_at=False),
        "realtime_metrics": lambda ev: marts.realtime_metrics(ev, metric_ts=fx.metric_ts()),
        "page_metrics": marts.page_metrics,
        "user_behavior": marts.user_behavior,
        "device_analytics": marts.device_analytics,
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._ev = events(spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = conform(self._BUILDERS[name](self._ev), name)
        return self._built[name]

    def __iter__(self):
        return iter(self._BUILDERS)

    def __len__(self) -> int:
        return len(self._BUILDERS)


def tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return LazyTables(spark, sf_dir)


RNG = (fx.TIME_FROM, fx.TIME_TO)


# --- A: decoding -------------------------------------------------------------

@register("parse_events")
def q_parse_events(spark, sf_dir):
    return decode.parse_events(fx.wire_records(spark, sf_dir))


@register("quarantine_events")
def q_quarantine_events(spark, sf_dir):
    return decode.quarantine_events(fx.wire_records(spark, sf_dir), keep=("partition", "offset")).drop("value")


@register("raw_events")
def q_raw_events(spark, sf_dir):
    parsed = decode.parse_events(fx.wire_records(spark, sf_dir), keep=("batch_id",))
    return marts.raw_events(decode.to_click_events(parsed), with_created_at=False)


# --- D: marts ----------------------------------------------------------------

@register("realtime_metrics")
def q_realtime_metrics(spark, sf_dir):
    return marts.realtime_metrics(events(spark, sf_dir), metric_ts=fx.metric_ts())


@register("bounce_rate")
def q_bounce_rate(spark, sf_dir):
    return marts.bounce_rate(events(spark, sf_dir))


@register("page_metrics")
def q_page_metrics(spark, sf_dir):
    return marts.page_metrics(events(spark, sf_dir))


@register("page_metrics_full")
def q_page_metrics_full(spark, sf_dir):
    return marts.page_metrics_full(events(spark, sf_dir))


@register("user_behavior")
def q_user_behavior(spark, sf_dir):
    return marts.user_behavior(events(spark, sf_dir))


@register("device_analytics")
def q_device_analytics(spark, sf_dir):
    return marts.device_analytics(events(spark, sf_dir))


@register("user_behavior_current")
def q_user_behavior_current(spark, sf_dir):
    return marts.user_behavior_current(events(spark, sf_dir))


@register("device_analytics_current")
def q_device_analytics_current(spark, sf_dir):
    return marts.device_analytics_current(events(spark, sf_dir))


# Queries that write batches before they read: several jobs each.
KEPT = ("user_behavior_kept", "device_analytics_kept", "window_counts_corrected", "late_events")


def _in_batches(spark, sf_dir, keep, order=(0, 1, 2)) -> str:
    """The fixture's events through ``keep`` in three batches of ten days each, in
    this order of arrival, the first one twice; the folder of what is kept."""
    root = f"{scratch_root(spark)}/kept-{uuid.uuid4().hex}"
    ev = events(spark, sf_dir)
    for n, part in enumerate((*order, order[0])):
        keep(ev.filter(F.col("batch_id").between(10 * part, 10 * part + 9)), root, "fixture", n % len(order))
    return root


@register("user_behavior_kept")
def q_user_behavior_kept(spark, sf_dir):
    return current.read_users(spark, _in_batches(spark, sf_dir, current.keep_users))


@register("device_analytics_kept")
def q_device_analytics_kept(spark, sf_dir):
    return current.read_dimensions(spark, _in_batches(spark, sf_dir, current.keep_dimensions))


@register("window_counts_corrected")
def q_window_counts_corrected(spark, sf_dir):
    # The middle days come first, so all that follows from the first days is late.
    root = _in_batches(spark, sf_dir, current.keep_windows, (1, 0, 2))
    return current.read_windows(spark, root).drop("version")


@register("late_events")
def q_late_events(spark, sf_dir):
    root = _in_batches(spark, sf_dir, current.keep_windows, (1, 0, 2))
    return current.read_late(spark, root).select(*RAW_EVENT_COLUMNS, "window_start", "batch_id")


def _in_range(bitmaps: DataFrame) -> DataFrame:
    """The batches whose metrics time lies in the panels' range."""
    return bitmaps.filter(fx.metric_ts().between(ntz_lit(RNG[0]), ntz_lit(RNG[1])))


@register("top_pages_unique")
def q_top_pages_unique(spark, sf_dir):
    ev = events(spark, sf_dir)
    return bitmaps.top_pages_unique(_in_range(bitmaps.page_bitmaps(ev, bitmaps.user_numbers(ev))))


@register("total_users_in_range")
def q_total_users_in_range(spark, sf_dir):
    ev = events(spark, sf_dir)
    return bitmaps.distinct_users(_in_range(bitmaps.hour_bitmaps(ev, bitmaps.user_numbers(ev))), name="total_users")


@register("active_users_by_hour_unique")
def q_active_users_by_hour_unique(spark, sf_dir):
    ev = events(spark, sf_dir)
    rows = bitmaps.distinct_users(bitmaps.hour_bitmaps(ev, bitmaps.user_numbers(ev)), ["hour_start"], "active_users")
    return rows.filter(F.col("hour_start").between(ntz_lit(RNG[0]), ntz_lit(RNG[1])))


@register("consumer_lag")
def q_consumer_lag(spark, sf_dir):
    """Two thirds of the days are read, all are there."""
    records = fx.wire_records(spark, sf_dir).select("topic", "partition", "offset", "timestamp", "batch_id")
    read_to = records.filter("batch_id < 20").groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
    return observe.lag_in_time(records, read_to)


@register("dimension_conversion_rate")
def q_dimension_conversion_rate(spark, sf_dir):
    return marts.dimension_conversion_rate(events(spark, sf_dir))


@register("rollup_dimensions")
def q_rollup_dimensions(spark, sf_dir):
    return marts.rollup_dimensions(events(spark, sf_dir))


# --- J: dashboard panels -----------------------------------------------------

_PANELS: dict[str, Callable] = {name: (lambda fn: lambda T: bind(fn, T, fx.NOW, RNG))(fn) for name, fn in PANELS.items()}
# The write time differs from run to run; the rest of the row is compared.
_PANELS["time_range_events"] = lambda T: P.time_range_events(T, RNG).select(*RAW_EVENT_COLUMNS, AMOUNT, "batch_id")


def _panel_query(panel: Callable) -> Query:
    return lambda spark, sf_dir: panel(tables(spark, sf_dir))


for _name, _panel in _PANELS.items():
    register(_name)(_panel_query(_panel))


# --- K/M: sessions -------------------------------------------------------------

@register("sessionize")
def q_sessionize(spark, sf_dir):
    return sessions.derived_sessions(events(spark, sf_dir), gap_seconds=fx.SESSION_GAP_SECONDS)


@register("session_windows")
def q_session_windows(spark, sf_dir):
    return sessions.session_windows(events(spark, sf_dir), gap_seconds=fx.SESSION_GAP_SECONDS)


@register("avg_session_duration")
def q_avg_session_duration(spark, sf_dir):
    return sessions.avg_session_duration(events(spark, sf_dir), by_batch=True)


@register("avg_time_on_page")
def q_avg_time_on_page(spark, sf_dir):
    return sessions.avg_time_on_page(events(spark, sf_dir))


@register("page_bounce_rate")
def q_page_bounce_rate(spark, sf_dir):
    return sessions.page_bounce_rate(events(spark, sf_dir))


@register("page_conversion_rate")
def q_page_conversion_rate(spark, sf_dir):
    return sessions.page_conversion_rate(events(spark, sf_dir))


@register("session_funnel")
def q_session_funnel(spark, sf_dir):
    return sessions.session_funnel(events(spark, sf_dir))


# --- K/D/N: event-time windows ------------------------------------------------------

@register("tumbling_event_counts")
def q_tumbling_event_counts(spark, sf_dir):
    return windows.tumbling_event_counts(events(spark, sf_dir), "5 minutes")


@register("sliding_active_users")
def q_sliding_active_users(spark, sf_dir):
    return windows.sliding_active_users(events(spark, sf_dir), "1 hour", "10 minutes")


@register("approx_uniques_windowed")
def q_approx_uniques_windowed(spark, sf_dir):
    return windows.approx_uniques_check(events(spark, sf_dir), "1 hour")


@register("active_sessions")
def q_active_sessions(spark, sf_dir):
    return windows.active_sessions(events(spark, sf_dir), "30 minutes")


@register("dedup_events")
def q_dedup_events(spark, sf_dir):
    return windows.dedup_events(fx.duplicated_clicks(spark, sf_dir)).select(
        "user_id", "session_id", "event_type", "timestamp", "page_url", "device", "partition", "offset")


@register("error_rate_alert")
def q_error_rate_alert(spark, sf_dir):
    return windows.error_rate_alert(
        fx.driver_events(spark, sf_dir), F.col("event_type") == fx.ALERT_EVENT_TYPE,
        window_seconds=fx.ALERT_WINDOW_SECONDS, threshold_per_second=fx.ALERT_THRESHOLD, hold=fx.ALERT_HOLD, ts="ts",
    )


# --- B6: publishing ----------------------------------------------------------------

@register("publish_events")
def q_publish_events(spark, sf_dir):
    # The records as text (the sink writes the same bytes).
    return publish_events(events(spark, sf_dir)).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
