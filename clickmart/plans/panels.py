"""Dashboard queries (J1-J31) over the five stored tables.

Each function takes ``T`` -- a mapping from table name to DataFrame (stored
tables in production, derived ones in tests) -- and, where the panel needs
them, ``now`` and a time range ``rng = (time_from, time_to)``.  Both are
explicit arguments, never the clock, so every result is reproducible.

Top-k panels keep their LIMIT (it is the feature) and get a unique
tie-break so the chosen rows are deterministic; Spark plans ``orderBy +
limit`` as a TakeOrderedAndProject (per-task top-k, then a merge), so no
full sort happens.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions import day_bucket, hour_bucket, idiv, is_type, mean2, ntz_lit, pct2
from clickmart.schema import (
    FUNNEL_STAGES,
    LABEL_BOUNCE_RATE,
    LABEL_TOTAL_EVENTS,
    PAGE_VIEW,
    PURCHASE,
    SEGMENT_BROWSERS,
    SEGMENT_ONE_TIME,
    SEGMENT_REPEAT,
    TABLE_METRICS,
    TABLE_SCHEMAS,
)
from clickmart.sinks.tables import stored_dates

Tables = Mapping[str, DataFrame]
Range = tuple[dt.datetime, dt.datetime]


def _ts(v: dt.datetime) -> Column:
    return ntz_lit(v)


def _since(df: DataFrame, date: str, day: dt.date) -> DataFrame:
    """Only the folders from ``day`` on, where ``df`` has that partition column."""
    return df.filter(F.col(date) >= F.lit(day)) if date in df.columns else df


def _within(df: DataFrame, c: str, date: str, rng: Range) -> DataFrame:
    """``$__timeFilter(c)``: inclusive BETWEEN of the panel range, and on a stored
    table the date folders that the range touches."""
    out = df.filter(F.col(c).between(_ts(rng[0]), _ts(rng[1])))
    return out.filter(F.col(date).between(F.lit(rng[0].date()), F.lit(rng[1].date()))) if date in df.columns else out


def _newest(df: DataFrame, date: str, k: int) -> DataFrame:
    """The rows among which the newest ``k`` are: those of the newest date folders
    that together have ``k`` rows.  The folders come from the file listing;
    folders are added, twice as many each time, until a count finds ``k``."""
    dates = stored_dates(df, date) if date in df.columns else None
    n = 1
    while dates and n < len(dates):
        recent = _since(df, date, dates[n - 1])
        if recent.limit(k).count() >= k:
            return recent
        n *= 2
    return df


def _events(T: Tables) -> DataFrame:
    return T["clickstream_events"]


def _metrics(T: Tables) -> DataFrame:
    return T["realtime_metrics"]


def _rate(c: str, name: str | None = None) -> Column:
    """A stored rate (decimal) as the number the panels show."""
    return F.col(c).cast("double").alias(name or c)


def _latest_metrics(T: Tables, k: int) -> DataFrame:
    rows = _newest(_metrics(T), "batch_date", k)
    return rows.orderBy(F.col("metric_timestamp").desc(), F.col("batch_id").desc()).limit(k)


# --- real-time metrics panels -------------------------------------------------

def event_stream_series(T: Tables, rng: Range, labelled: bool = True) -> DataFrame:
    """Total events per metrics row in the range, oldest first."""
    cols = [F.col("metric_timestamp").alias("time"), F.col("total_events").alias("value")]
    if labelled:
        cols.append(F.lit(LABEL_TOTAL_EVENTS).alias("metric"))
    return _within(_metrics(T), "metric_timestamp", "batch_date", rng).select(*cols).orderBy("time")


def event_stream_series_plain(T: Tables, rng: Range) -> DataFrame:
    """As J1, without the label."""
    return event_stream_series(T, rng, labelled=False)


def conversion_rate_latest_nullable(T: Tables) -> DataFrame:
    """As J4, NULL without page views."""
    return conversion_rate_latest(T, null_if_no_views=True)


def active_users_latest(T: Tables) -> DataFrame:
    """Distinct users of the newest metrics row."""
    return _latest_metrics(T, 1).select("unique_users")


def conversion_rate_latest(T: Tables, null_if_no_views: bool = False) -> DataFrame:
    """100 x purchases / page views of the newest row; 0 (J4) or NULL
    (J5) when the row has no page views."""
    ratio = F.col("purchases").cast("double") / F.col("page_views").cast("double") * F.lit(100.0)
    value = F.when(F.col("page_views") > 0, ratio)
    if not null_if_no_views:
        value = value.otherwise(F.lit(0.0))
    return _latest_metrics(T, 1).select(value.alias("value"))


def recent_session_metrics(T: Tables, k: int = 20) -> DataFrame:
    """Session figures of the newest ``k`` metrics rows."""
    return _latest_metrics(T, k).select(
        "metric_timestamp", "unique_sessions", _rate("bounce_rate"), "page_views", "purchases", "cart_additions"
    )


def session_metrics(T: Tables, k: int = 20) -> DataFrame:
    """Sessions, bounce rate and mean session duration of the newest ``k`` rows."""
    return _latest_metrics(T, k).select("metric_timestamp", "unique_sessions", _rate("bounce_rate"), "avg_session_duration")


def bounce_rate_trend(T: Tables, rng: Range) -> DataFrame:
    """Bounce rate per metrics row in the range, oldest first."""
    return _within(_metrics(T), "metric_timestamp", "batch_date", rng).select(
        F.col("metric_timestamp").alias("time"), _rate("bounce_rate", "value"), F.lit(LABEL_BOUNCE_RATE).alias("metric")
    ).orderBy("time")


def recent_metrics_check(T: Tables, k: int = 5) -> DataFrame:
    """The newest ``k`` metrics rows, all figures."""
    kept = [f.name for f in TABLE_SCHEMAS[TABLE_METRICS].fields if f.name not in ("created_at", "batch_date", "stream_id")]
    return _latest_metrics(T, k).select(*[_rate(c) if c == "bounce_rate" else c for c in kept])


# --- page panels -----------------------------------------------------------------

def top_pages(T: Tables, k: int = 10) -> DataFrame:
    """Views summed over batches, visitors = max of the per-batch distinct
    counts (a lower bound of the true distinct count, as the panel has it)."""
    return T["page_metrics"].groupBy("page_url").agg(
        F.sum("view_count").alias("total_views"), F.max("unique_visitors").alias("unique_visitors")
    ).orderBy(F.col("total_views").desc(), "page_url").limit(k)


def top_pages_visitor_ratio(T: Tables, k: int = 10) -> DataFrame:
    """The ``k`` stored page rows with most views and 100 x visitors / views
    (the panel labels it ``bounce_rate``)."""
    return T["page_metrics"].orderBy(F.col("view_count").desc(), "page_url", "batch_id").limit(k).select(
        "page_url", "view_count", "unique_visitors", pct2("unique_visitors", "view_count").alias("bounce_rate")
    )


# --- raw-event panels ------------------------------------------------------------

def events_by_type_last_hour(T: Tables, now: dt.datetime, hours: int = 1) -> DataFrame:
    """Events per type with a time after ``now - hours`` (no upper bound)."""
    since = _ts(now) - F.expr(f"INTERVAL {int(hours)} HOURS")
    ev = _since(_events(T), "event_date", (now - dt.timedelta(hours=int(hours))).date())
    return ev.filter(F.col("timestamp") > since).groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


def hourly_activity(T: Tables, rng: Range) -> DataFrame:
    """Events per hour bucket in the range, with the hour of day."""
    ev = _within(_events(T), "timestamp", "event_date", rng)
    return ev.groupBy(hour_bucket("timestamp").alias("time"), F.hour("timestamp").cast("bigint").alias("hour")).agg(
        F.count(F.lit(1)).alias("value")
    ).orderBy("time")


def active_users_by_hour(T: Tables, rng: Range) -> DataFrame:
    """Distinct users per hour bucket in the range."""
    ev = _within(_events(T), "timestamp", "event_date", rng)
    return ev.groupBy(hour_bucket("timestamp").alias("time")).agg(
        F.count_distinct("user_id").alias("active_users")
    ).orderBy("time")


def recent_activity(T: Tables, k: int = 50) -> DataFrame:
    """The newest ``k`` events (events without a time come last)."""
    return _newest(_events(T), "event_date", k).orderBy(
        F.col("timestamp").desc_nulls_last(), "user_id", "event_type", "page_url", "device", "session_id"
    ).limit(k).select(F.col("timestamp").alias("time"), "user_id", "event_type", "page_url", "device")


def event_count_check(T: Tables) -> DataFrame:
    """Number of stored events."""
    return _events(T).agg(F.count(F.lit(1)).alias("event_count"))


def time_range_events(T: Tables, rng: Range) -> DataFrame:
    """The stored events inside the panel range."""
    return _within(_events(T), "timestamp", "event_date", rng)


def _stage_counts(ev: DataFrame, compare) -> DataFrame:
    """One pass over the events: a count per funnel stage, as rows."""
    totals = ev.agg(*[F.count_if(compare(t)).alias(f"_s{i}") for i, (_, t) in enumerate(FUNNEL_STAGES)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("stage"), F.col(f"_s{i}").alias("count"))
        for i, (label, _) in enumerate(FUNNEL_STAGES)
    ])))


def conversion_funnel(T: Tables) -> DataFrame:
    """Events per funnel stage (UNION ALL of three counts in the panel,
    one scan here; a stage without events shows 0), most first."""
    return _stage_counts(_events(T), lambda t: F.col("event_type") == t).orderBy(F.col("count").desc(), "stage")


def engagement_funnel_distinct(T: Tables) -> DataFrame:
    """The same counts under the ``metric``/``value`` names, set-union
    semantics, event types compared case-insensitively."""
    rows = _stage_counts(_events(T), lambda t: is_type("event_type", t))
    return rows.select(F.col("stage").alias("metric"), F.col("count").alias("value")).distinct()


def top_users_by_page_views(T: Tables, k: int = 20) -> DataFrame:
    """Per user from raw events: distinct sessions, page views,
    purchases and lifetime value (sum of PURCHASE amounts); top ``k`` by views."""
    ev = _events(T)
    purchase = F.col("event_type") == PURCHASE
    amount = F.sum(F.when(purchase, F.col("amount")))  # an events table without amounts is an error, not 0.0
    return ev.groupBy("user_id").agg(
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_if(F.col("event_type") == PAGE_VIEW).alias("total_page_views"),
        F.count_if(purchase).alias("total_purchases"),
        F.coalesce(amount.cast("double"), F.lit(0.0)).alias("lifetime_value"),
    ).orderBy(F.col("total_page_views").desc(), "user_id").limit(k)


def retention_cohort_daily(T: Tables) -> DataFrame:
    """J21, as the panel is written: one row per (user, day) with more than
    one event, whose "cohort day" is that same day (the minimum is taken
    inside the group).  ``users`` is COUNT(DISTINCT user) of a one-user group."""
    per_user_day = _events(T).groupBy("user_id", day_bucket("timestamp").alias("activity_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("timestamp").alias("_first")
    )
    return per_user_day.filter(F.col("_n") > 1).select(
        day_bucket("_first").alias("cohort_day"), "activity_day", F.lit(1).cast("bigint").alias("users")
    )


def retention_cohort(T: Tables) -> DataFrame:
    """J21b, the intended cohort table: cohort day = a user's first active
    day; per (cohort day, activity day) the distinct active users.

    Events are first reduced to distinct (user, day); the first day comes
    from a window over those rows (at most one row per active day of a
    user, so no user's history is gathered in one place)."""
    days = _events(T).filter(F.col("timestamp").isNotNull()).select(
        "user_id", F.to_date("timestamp").alias("_day")
    ).distinct()
    first = F.min("_day").over(Window.partitionBy("user_id"))
    return days.withColumn("_cohort", first).groupBy("_cohort", "_day").agg(F.count(F.lit(1)).alias("users")).select(
        F.col("_cohort").cast("timestamp_ntz").alias("cohort_day"),
        F.col("_day").cast("timestamp_ntz").alias("activity_day"),
        F.datediff("_day", "_cohort").cast("bigint").alias("day_offset"),
        "users",
    )


# --- dimension panels --------------------------------------------------------------

def device_distribution(T: Tables) -> DataFrame:
    """Events per device summed over batches (the NULL device is kept)."""
    da = T["device_analytics"].filter(F.col("dimension_type") == "device")
    return da.groupBy("dimension_value").agg(F.sum("event_count").alias("total_events")).select(
        F.col("dimension_value").alias("device"), "total_events"
    ).orderBy(F.col("total_events").desc(), "device")


def device_distribution_rows(T: Tables) -> DataFrame:
    """The stored device rows, most events first."""
    da = T["device_analytics"].filter(F.col("dimension_type") == "device")
    return da.select(F.col("dimension_value").alias("device"), "event_count").orderBy(
        F.col("event_count").desc(), "device")


def region_distribution(T: Tables, k: int = 10, region_label: str = "region") -> DataFrame:
    """Events per region (NULL dropped), top ``k``."""
    da = T["device_analytics"].filter((F.col("dimension_type") == region_label) & F.col("dimension_value").isNotNull())
    return da.groupBy("dimension_value").agg(F.sum("event_count").alias("events")).select(
        F.col("dimension_value").alias("region"), "events"
    ).orderBy(F.col("events").desc(), "region").limit(k)


# --- user panels ----------------------------------------------------------------------

def _per_user(T: Tables) -> DataFrame:
    return T["user_behavior"].groupBy("user_id")


def total_users(T: Tables) -> DataFrame:
    """Distinct users in the user table."""
    return T["user_behavior"].agg(F.count_distinct("user_id").alias("total_users"))


def avg_sessions_per_user(T: Tables) -> DataFrame:
    """Mean over users of their summed sessions, two places."""
    per_user = _per_user(T).agg(F.sum("sessions").alias("_s"))
    return per_user.agg(mean2(F.sum("_s"), F.count(F.lit(1))).alias("avg_sessions"))


def purchase_conversion(T: Tables) -> DataFrame:
    """% of users with at least one purchase, two places; NULL without users."""
    per_user = _per_user(T).agg(F.sum("purchases").alias("_p"))
    return per_user.agg(pct2(F.count_if(F.col("_p") > 0), F.count(F.lit(1))).alias("conversion_rate"))


def top_active_users(T: Tables, k: int = 20) -> DataFrame:
    """Per user, summed partials; top ``k`` by events."""
    return _per_user(T).agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("events").alias("total_events"),
        F.sum("purchases").alias("total_purchases"),
        F.max("last_active").alias("last_seen"),
    ).orderBy(F.col("total_events").desc(), "user_id").limit(k)


def user_activity_distribution(T: Tables) -> DataFrame:
    """Events per user, one row per user (the histogram is drawn client side)."""
    return _per_user(T).agg(F.sum("events").alias("events_per_user")).select("events_per_user")


def user_activity_histogram(T: Tables, width: int = 5) -> DataFrame:
    """The histogram itself: users per bucket ``[start, start + width)``
    of events per user."""
    per_user = _per_user(T).agg(F.sum("events").alias("_e"))
    start = idiv("_e", F.lit(int(width))) * int(width)
    return per_user.groupBy(start.alias("bucket_start")).agg(F.count(F.lit(1)).alias("users")).orderBy("bucket_start")


def device_by_segment(T: Tables) -> DataFrame:
    """Users per (purchase segment, device).

    Segments come from the summed purchases of each user; events are first
    reduced to distinct (user, device) pairs, so the join is between two
    per-user sets and a very active user adds one row per device, not one
    per event."""
    p = F.col("_p")
    segments = _per_user(T).agg(F.sum("purchases").alias("_p")).select(
        "user_id",
        F.when(p == 0, SEGMENT_BROWSERS).when(p == 1, SEGMENT_ONE_TIME).otherwise(SEGMENT_REPEAT).alias("segment"),
    )
    pairs = _events(T).filter(F.col("device").isNotNull()).select("user_id", "device").distinct()
    return segments.join(pairs, "user_id", "inner").groupBy("segment", "device").agg(
        F.count(F.lit(1)).alias("users")
    ).orderBy(F.col("users").desc(), "segment", "device")

