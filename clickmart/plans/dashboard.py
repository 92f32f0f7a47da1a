"""Dashboard queries over the stored tables, from the command line.

    python -m clickmart.plans.dashboard --tables /data/clicks top_pages
    python -m clickmart.plans.dashboard --tables /data/clicks hourly_activity --from 2024-01-15 --to 2024-01-31

``--now`` defaults to the current UTC time and the range to the last hour
before it (the panels' default range).
"""

from __future__ import annotations

import argparse
import datetime as dt
import inspect

from pyspark.sql import DataFrame, SparkSession

from clickmart.plans import panels as P
from clickmart.sinks.tables import read_tables

# Panels by key (the same keys as the query registry).
PANELS = {
    "event_stream_series": P.event_stream_series, "event_stream_series_plain": P.event_stream_series_plain,
    "conversion_rate_latest_nullable": P.conversion_rate_latest_nullable, "active_users_latest": P.active_users_latest,
    "conversion_rate_latest": P.conversion_rate_latest, "top_pages": P.top_pages,
    "top_pages_visitor_ratio": P.top_pages_visitor_ratio, "events_by_type_last_hour": P.events_by_type_last_hour,
    "device_distribution": P.device_distribution, "device_distribution_rows": P.device_distribution_rows,
    "hourly_activity": P.hourly_activity, "recent_session_metrics": P.recent_session_metrics,
    "session_metrics": P.session_metrics, "bounce_rate_trend": P.bounce_rate_trend,
    "region_distribution": P.region_distribution, "engagement_funnel_distinct": P.engagement_funnel_distinct,
    "conversion_funnel": P.conversion_funnel, "top_users_by_page_views": P.top_users_by_page_views,
    "retention_cohort_daily": P.retention_cohort_daily, "retention_cohort": P.retention_cohort,
    "total_users": P.total_users, "avg_sessions_per_user": P.avg_sessions_per_user,
    "purchase_conversion": P.purchase_conversion, "top_active_users": P.top_active_users,
    "user_activity_distribution": P.user_activity_distribution, "user_activity_histogram": P.user_activity_histogram,
    "device_by_segment": P.device_by_segment, "active_users_by_hour": P.active_users_by_hour,
    "recent_activity": P.recent_activity, "event_count_check": P.event_count_check,
    "recent_metrics_check": P.recent_metrics_check, "time_range_events": P.time_range_events,
}


def bind(fn, T, now: dt.datetime, rng: tuple[dt.datetime, dt.datetime], **extra) -> DataFrame:
    """Call a panel with those of ``now``, ``rng`` and ``extra`` that it takes."""
    params = inspect.signature(fn).parameters
    return fn(T, **{k: v for k, v in {"now": now, "rng": rng, **extra}.items() if k in params})


def run_panel(spark: SparkSession, root: str, name: str, now: dt.datetime, rng: tuple[dt.datetime, dt.datetime], **extra) -> DataFrame:
    """Build panel ``name`` over the tables under ``root``."""
    return bind(PANELS[name], read_tables(spark, root), now, rng, **extra)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="clickmart.plans.dashboard", description=__doc__)
    p.add_argument("panel", choices=sorted(PANELS))
    p.add_argument("--tables", required=True)
    p.add_argument("--now", type=dt.datetime.fromisoformat, default=None)
    p.add_argument("--from", dest="time_from", type=dt.datetime.fromisoformat, default=None)
    p.add_argument("--to", dest="time_to", type=dt.datetime.fromisoformat, default=None)
    p.add_argument("--region-label", default="region", help="the label the job stored regions under")
    p.add_argument("--rows", type=int, default=50)
    a = p.parse_args(argv)
    now = a.now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rng = (a.time_from or now - dt.timedelta(hours=1), a.time_to or now)
    spark = SparkSession.builder.appName(f"clickmart-{a.panel}").getOrCreate()
    run_panel(spark, a.tables, a.panel, now, rng, region_label=a.region_label).show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
