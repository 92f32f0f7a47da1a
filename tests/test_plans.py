"""Plan-shape checks: the physical plans keep the scale properties the
README promises (single scans, no pair-producing joins, top-k, pushdown,
no row-level window on a bare hot key)."""

import contextlib
import datetime as dt
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from clickmart.operators import marts, sessions, windows
from clickmart.plans import dashboard
from clickmart.plans import panels as P
from clickmart.plans import registry
from clickmart.sinks import tables as tb
from clickmart.sources import fixture as fx

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def scans(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Scan", text, flags=re.M))


@pytest.fixture(scope="module")
def clicks(spark):
    return fx.derive_raw_clicks(spark, SMOKE).filter(F.col("user_id").isNotNull())


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def test_no_pair_producing_join_or_python_anywhere(spark):
    for name, fn in registry.queries().items():
        if name in registry.KEPT[1:]:
            continue  # one of them shows the plan that reads a ledger
        text = plan(fn(spark, SMOKE))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert not any(node in text for node in PYTHON_NODES), name


def test_realtime_metrics_is_one_pass(spark):
    ev = spark.read.schema(fx.EVENTS_SCHEMA).parquet(f"{SMOKE}/events.parquet").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("user_id").cast("string").alias("session_id"),
        "event_type", F.col("ts").alias("timestamp"), F.lit(0).cast("bigint").alias("batch_id"))
    text = plan(marts.realtime_metrics(ev, fx.metric_ts()))
    assert scans(text) == 1 and "Join" not in text and "Expand" in text


def test_dimension_mart_scans_once(spark):
    ev = spark.read.schema(fx.EVENTS_SCHEMA).parquet(f"{SMOKE}/events.parquet").select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("m").alias("device"), F.lit("r").alias("region"),
        "event_type", F.lit(0).cast("bigint").alias("batch_id"))
    text = plan(marts.device_analytics(ev))
    assert scans(text) == 1 and "Union" not in text


def test_sessionize_sorts_no_rows_per_user(spark):
    ev = spark.read.schema(fx.EVENTS_SCHEMA).parquet(f"{SMOKE}/events.parquet")
    text = plan(sessions.sessionize(ev, user="user_id", ts="ts", gap_seconds=1800))
    # Every window runs over the per-(user, bucket) summary rows (first/last
    # time of a bucket), never over the events themselves.
    inputs = re.findall(r"^\(\d+\) Window\nInput \[\d+\]: \[([^\]]*)\]", text, flags=re.M)
    assert inputs and all("_bmax" in i or "_st" in i for i in inputs), inputs
    assert not any("event_type" in i for i in inputs)
    assert re.search(r"hashpartitioning\(user_id#\d+L?, _tb#\d+L?", text)


def test_page_row_and_funnel_scan_once_and_join_nothing(spark):
    ev = spark.read.schema(fx.EVENTS_SCHEMA).parquet(f"{SMOKE}/events.parquet").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("user_id").cast("string").alias("session_id"), "event_type",
        F.lit("/").alias("page_url"), F.col("ts").alias("timestamp"), F.lit(0).cast("bigint").alias("batch_id"))
    for df, shuffles in ((marts.page_metrics_full(ev), 4), (sessions.session_funnel(ev), 3)):
        text = plan(df)
        assert scans(text) == 1 and "Join" not in text and "SortAggregate" not in text and "Union" not in text
        assert len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M)) == shuffles
        # No window over events has a bare session: rows meet per minute, then as minutes' rows.
        first = re.search(r"^\(\d+\) Exchange\n.*\nArguments: hashpartitioning\(([^)]*)", text, flags=re.M).group(1)
        assert "session_id" in first and "_tb" in first


def test_alert_scans_events_once(spark):
    ev = fx.driver_events(spark, SMOKE)
    text = plan(windows.error_rate_alert(ev, F.col("event_type") == "error", 21600, 0.0009, 2))
    assert scans(text) == 1
    assert "EqualTo(event_type,error)" in re.search(r"PushedFilters: \[(.*)\]", text).group(1)


def test_topk_panels_do_not_sort_everything(spark):
    from clickmart.plans.registry import tables

    T = tables(spark, SMOKE)
    for df in (P.top_pages(T), P.recent_activity(T), P.top_active_users(T)):
        assert "TakeOrderedAndProject" in plan(df)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The five tables as the stream would leave them: a partition per day and batch."""
    root = str(tmp_path_factory.mktemp("wh"))
    for name, df in marts.build_marts(fx.clicks(spark, SMOKE), metric_ts=fx.metric_ts()).items():
        tb.write_batch_idempotent(df, root, name)
    return root


RNG = (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 20))


def test_stored_table_reads_push_filters_and_prune(spark, stored):
    T = tb.read_tables(spark, stored)
    text = plan(P.active_users_by_hour(T, RNG))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(timestamp," in pushed and "LessThanOrEqual(timestamp," in pushed
    assert re.search(r"ReadSchema: struct<user_id:string,timestamp:timestamp_ntz>", text)
    pruned = plan(T["clickstream_events"].filter("batch_id >= 28").select("user_id"))
    assert re.search(r"PartitionFilters: \[isnotnull\(batch_id#\d+L?\), \(batch_id#\d+L? >= 28\)\]", pruned)


RANGE_PANELS = {"event_stream_series": "batch_date", "event_stream_series_plain": "batch_date", "bounce_rate_trend": "batch_date",
                "hourly_activity": "event_date", "active_users_by_hour": "event_date", "time_range_events": "event_date",
                "events_by_type_last_hour": "event_date"}
NEWEST_PANELS = {"active_users_latest": "batch_date", "conversion_rate_latest": "batch_date", "conversion_rate_latest_nullable": "batch_date",
                 "recent_session_metrics": "batch_date", "session_metrics": "batch_date", "recent_metrics_check": "batch_date",
                 "recent_activity": "event_date"}


@pytest.mark.parametrize("panel", sorted({**RANGE_PANELS, **NEWEST_PANELS}))
def test_time_panels_open_only_the_dates_they_need(spark, stored, panel):
    column = {**RANGE_PANELS, **NEWEST_PANELS}[panel]
    text = plan(dashboard.run_panel(spark, stored, panel, dt.datetime(2024, 1, 30), RNG, k=5))
    filters = re.findall(r"PartitionFilters: \[(.*)\]", text)
    assert filters and all(f"{column}#" in f for f in filters), filters


def test_panels_agree_on_stored_and_derived_tables(spark, stored):
    derived, T = registry.tables(spark, SMOKE), tb.read_tables(spark, stored)
    for name, panel in registry._PANELS.items():
        rows = lambda df: sorted(map(str, df.drop("created_at", "updated_at").collect()))
        assert rows(panel(T)) == rows(panel(derived)), name
    assert P.top_users_by_page_views(T).agg(F.sum("lifetime_value")).first()[0] > 0


def test_events_without_amounts_are_an_error(spark, stored):
    T = {"clickstream_events": tb.read_table(spark, stored, "clickstream_events").drop("amount")}
    with pytest.raises(Exception, match="amount"):
        P.top_users_by_page_views(T)


def test_queries_scan_parquet_with_their_own_columns(spark):
    text = plan(registry.queries()["hourly_activity"](spark, SMOKE))
    assert "Scan ExistingRDD" not in text and "Scan parquet" in text
    assert re.search(r"ReadSchema: struct<user_id:string,timestamp:timestamp_ntz>", text)


def test_sliding_windows_multiply_reduced_rows(spark):
    text = plan(windows.sliding_active_users(fx.clicks(spark, SMOKE)))
    order = [m for m in re.findall(r"^\(\d+\) (\w+)", text, flags=re.M)]
    assert "Expand" not in order or order.index("HashAggregate") < order.index("Expand")


def test_backfill_does_not_write_every_batch_from_every_task(spark, stored):
    import glob

    files = glob.glob(os.path.join(stored, "clickstream_events", "**", "*.parquet"), recursive=True)
    parts = {os.path.dirname(f) for f in files}
    assert len(files) <= tb.SPREAD * len(parts)


def test_reading_kept_tables_opens_no_members_or_events(spark):
    text = plan(registry.queries()["user_behavior_kept"](spark, SMOKE))
    assert scans(text) == 1 and "/totals/" in text and "/members/" not in text and "Join" not in text


def test_sliding_windows_are_not_multiplied(spark, clicks):
    text = plan(windows.sliding_active_users(clicks, "24 hours", "1 minute"))
    assert "Expand" not in text
