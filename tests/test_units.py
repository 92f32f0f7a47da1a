"""Hand-made edge rows (FIXTURES.md section 5) and known values at sf0.01."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickmart.functions import ntz_lit

from clickmart.operators import marts, sessions, windows
from clickmart.plans import panels as P
from clickmart.sources import decode
from clickmart.sources import fixture as fx

EV_SCHEMA = ("user_id string, page_url string, event_type string, timestamp timestamp_ntz, session_id string, "
             "device string, region string, referrer string, batch_id bigint")


def T0(h=0, m=0, s=0):
    return dt.datetime(2025, 8, 3, h, m, s)


def ev(spark, rows):
    return spark.createDataFrame(rows, EV_SCHEMA)


def row(user="u1", page="/p/1", et="PAGE_VIEW", ts=None, sess="s1", device="mobile", region="us-east-1", batch=0):
    return (user, page, et, ts if ts is not None else T0(), sess, device, region, "/home", batch)


# --- decoding -----------------------------------------------------------------------

def wire(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_and_quarantine_edge_rows(spark):
    values = [
        "not json", '[{"userId":"u9"}]', None, '{"sessionId":"a"}', '{"userId":5}',
        '{"userId":"u1","x":1}', '{"USERID":"q"}', '{"userId":"u2","eventTime":"garbage"}',
        '{"userId":"u3","eventTime":"2025-08-03T10:00:00"}',
    ]
    raw = wire(spark, values)
    parsed = {r.userId: r for r in decode.parse_events(raw).collect()}
    assert set(parsed) == {"5", "u1", "u2", "u3"}
    q = sorted((r.value or "", r.reason) for r in decode.quarantine_events(raw).collect())
    assert q == sorted([
        ("not json", "undecodable"), ('[{"userId":"u9"}]', "undecodable"), ("", "undecodable"),
        ('{"sessionId":"a"}', "missing_user"), ('{"USERID":"q"}', "missing_user"),
    ])
    ev_ = {r.user_id: r for r in decode.to_click_events(decode.parse_events(raw)).collect()}
    assert ev_["u2"].timestamp is None
    assert ev_["u3"].timestamp == dt.datetime(2025, 8, 3, 10, 0, 0)


def test_parse_and_quarantine_partition_the_input(spark, sf_dir):
    raw = fx.wire_records(spark, sf_dir)
    n = raw.count()
    good = decode.parse_events(raw).count()
    bad = decode.quarantine_events(raw).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in bad} == {"undecodable": 52, "missing_user": 52}
    assert good + 104 == n


def test_event_time_with_zone_is_moved_to_utc(spark):
    from clickmart.functions import parse_event_time

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2025-08-03T10:00:00",), ("2025-08-03T10:00:00Z",), ("2025-08-03T12:00:00+02:00",),
                                    ("2025-08-03T10:00:00.5",), ("garbage",)], "t string")
        got = [r.ts for r in df.select(parse_event_time("t").alias("ts")).collect()]
        ten = dt.datetime(2025, 8, 3, 10, 0, 0)
        assert got == [ten, ten, ten, dt.datetime(2025, 8, 3, 10, 0, 0, 500000), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_event_times_at_the_edges(spark, zone):
    from clickmart.functions import parse_event_time

    cases = [("2024-01-15", dt.datetime(2024, 1, 15)), ("2024-01", dt.datetime(2024, 1, 1)),
             ("2024-01-15T10:00:00 Europe/Paris", dt.datetime(2024, 1, 15, 9)), ("2024-01-15T10:00:00 UTC", dt.datetime(2024, 1, 15, 10)),
             ("2024-01-15 10:00:00-08:00", dt.datetime(2024, 1, 15, 18)), ("2024-01-15T10:00:00+0200", None),
             ("1969-12-31T23:31:00", dt.datetime(1969, 12, 31, 23, 31)), ("2024-01-15T10:00:00 Nowhere/Land", None)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(c,) for c, _ in cases], "t string")
        got = {r.t: r.ts for r in df.select("t", parse_event_time("t").alias("ts")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for text, want in cases:
        assert got[text] == want or (want is None and got[text] == dt.datetime(2024, 1, 15, 8)), (text, got[text])


def test_streams_want_utc(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        with pytest.raises(ValueError, match="UTC"):
            decode.to_click_events(decode.parse_events(wire(spark, ["{}"])), zoned=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_sessions_before_1970(spark):
    rows = [row(ts=dt.datetime(1969, 12, 31, 23, 31)), row(ts=dt.datetime(1970, 1, 1, 0, 29))]
    got = sessions.derived_sessions(ev(spark, rows), gap_seconds=1800).collect()
    assert sorted((r.session_start, r.events) for r in got) == [(rows[0][3], 1), (rows[1][3], 1)]


# --- marts --------------------------------------------------------------------------

def test_known_realtime_metrics_values(spark, sf_dir):
    rm = marts.realtime_metrics(fx.clicks(spark, sf_dir), fx.metric_ts())
    assert rm.count() == 30
    b0 = rm.filter("batch_id = 0").first()
    assert (b0.total_events, b0.unique_users, b0.unique_sessions, b0.page_views) == (360, 303, 301, 71)
    assert b0.bounce_rate == 82.12
    assert b0.metric_timestamp == dt.datetime(2024, 1, 2)
    groups = marts.bounce_rate(fx.clicks(spark, sf_dir)).filter("batch_id = 0").first().session_groups
    assert groups == 302


def test_known_segment_and_dimension_values(spark, sf_dir):
    from clickmart.plans.registry import tables

    T = tables(spark, sf_dir)
    seg = {(r.segment, r.device): r.users for r in P.device_by_segment(T).collect()}
    assert len(seg) == 9 and seg[("Browsers", "desktop")] == 201
    assert T["device_analytics"].count() == 240


def test_all_single_event_sessions_bounce_100(spark):
    rows = [row(user=f"u{i}", sess=f"s{i}") for i in range(4)]
    rm = marts.realtime_metrics(ev(spark, rows), ntz_lit(T0()))
    assert rm.first().bounce_rate == 100.0


def test_null_session_among_others(spark):
    rows = [row(sess=None), row(sess="a"), row(sess="a", ts=T0(0, 5)), row(sess="b")]
    r = marts.realtime_metrics(ev(spark, rows), ntz_lit(T0())).first()
    assert r.unique_sessions == 2
    b = marts.bounce_rate(ev(spark, rows)).first()
    assert (b.session_groups, b.bounced_sessions) == (3, 2)
    assert r.bounce_rate == 66.67
    assert r.avg_session_duration == 150  # sessions a (300 s) and b (0 s)


def test_no_page_view_panels(spark):
    rows = [row(et="PURCHASE")]
    e = ev(spark, rows)
    T = {"realtime_metrics": marts.realtime_metrics(e, ntz_lit(T0())), "page_metrics": marts.page_metrics(e)}
    assert P.conversion_rate_latest(T).first().value == 0.0
    assert P.conversion_rate_latest(T, null_if_no_views=True).first().value is None
    assert T["page_metrics"].count() == 0


def test_null_device_kept_in_marts_and_ignored_by_segments(spark):
    rows = [row(device=None), row(user="u2", device="tablet", sess="s2")]
    e = ev(spark, rows)
    da = marts.device_analytics(e).filter("dimension_type = 'device'").collect()
    assert sorted((r.dimension_value or "") for r in da) == ["", "tablet"]
    T = {"user_behavior": marts.user_behavior(e), "clickstream_events": marts.raw_events(e, with_created_at=False)}
    assert {r.device for r in P.device_by_segment(T).collect()} == {"tablet"}


def test_rollup_keeps_real_null_apart_from_subtotal(spark):
    rows = [row(device=None), row(user="u2", sess="s2")]
    cube = marts.rollup_dimensions(ev(spark, rows)).collect()
    levels = {(r.device, r.region, r.grouping_level): r.event_count for r in cube}
    assert levels[(None, "us-east-1", 0)] == 1      # genuine NULL device
    assert levels[(None, "us-east-1", 2)] == 2      # device rolled up
    assert levels[(None, None, 3)] == 2


def test_user_over_two_batches(spark):
    rows = [row(sess="a", batch=0), row(sess="a", batch=1, ts=T0(0, 1))]
    e = ev(spark, rows)
    partial_sum = marts.user_behavior_from_partials(marts.user_behavior(e)).first().sessions
    exact = marts.user_behavior_current(e).first().sessions
    assert (partial_sum, exact) == (2, 1)


def test_latest_wins_upsert(spark):
    rows = [row(sess="a", batch=0), row(sess="a", batch=1, ts=T0(0, 1), et="PURCHASE"), row(user="u2", sess="b", batch=0)]
    partials = marts.user_behavior(ev(spark, rows))
    latest = {r.user_id: (r.batch_id, r.purchases, r.events) for r in marts.user_behavior_latest(partials).collect()}
    assert latest == {"u1": (1, 1, 1), "u2": (0, 0, 1)}
    dims = marts.device_analytics_latest(marts.device_analytics(ev(spark, rows))).collect()
    assert len(dims) == 2 and all(r.batch_id == 1 for r in dims if r.dimension_type == "device")


def test_sketch_partials_merge_to_current_figures(spark, sf_dir):
    clicks = fx.clicks(spark, sf_dir)
    exact = {(r.dimension_type, r.dimension_value): (r.event_count, r.unique_users)
             for r in marts.device_analytics_current(clicks).collect()}
    merged = marts.device_analytics_from_sketches(marts.dimension_sketches(clicks)).collect()
    assert len(merged) == len(exact)
    for r in merged:
        events, users = exact[(r.dimension_type, r.dimension_value)]
        assert r.event_count == events and abs(r.approx_unique_users - users) <= max(2, 0.05 * users)
    users = {r.user_id: r for r in marts.user_behavior_current(clicks).collect()}
    for r in marts.user_behavior_from_sketches(marts.user_sessions_sketches(clicks)).collect():
        u = users[r.user_id]
        assert (r.events, r.purchases, r.last_active) == (u.events, u.purchases, u.last_active)
        assert abs(r.approx_sessions - u.sessions) <= 1


def test_pct2_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 0)], "n long, d long")
    from clickmart.functions import mean2, pct2

    got = [r.p for r in df.select(pct2("n", "d").alias("p")).collect()]
    assert got == [12.5, 33.33, 66.67, None]
    assert df.select(mean2("n", "d").alias("m")).collect()[0].m == 0.13


# --- sessions -------------------------------------------------------------------------

def test_gap_exactly_threshold_stays_in_session(spark):
    rows = [row(ts=T0(0, 0)), row(ts=T0(0, 30)), row(ts=T0(1, 0, 1))]
    s = sessions.sessionize(ev(spark, rows), gap_seconds=1800).select("timestamp", "session_seq").collect()
    assert sorted((r.timestamp, r.session_seq) for r in s) == [(T0(0, 0), 1), (T0(0, 30), 1), (T0(1, 0, 1), 2)]


def test_session_funnel_is_time_ordered(spark):
    rows = [
        row(sess="a", et="ADD_TO_CART", ts=T0(0, 0)), row(sess="a", et="PAGE_VIEW", ts=T0(0, 1)),   # cart before view
        row(sess="b", et="PAGE_VIEW", ts=T0(0, 0)), row(sess="b", et="ADD_TO_CART", ts=T0(0, 1)),
        row(sess="b", et="PURCHASE", ts=T0(0, 2)),
        row(sess="c", et="PAGE_VIEW", ts=T0(0, 0)), row(sess="c", et="PURCHASE", ts=T0(0, 1)),
        row(sess="c", et="ADD_TO_CART", ts=T0(0, 2)),                                                  # purchase before cart
    ]
    f = {r.stage: r.sessions for r in sessions.session_funnel(ev(spark, rows)).collect()}
    assert f == {"Page Views": 3, "Add to Cart": 2, "Purchases": 1}


def test_time_on_page_uses_next_event(spark):
    rows = [row(ts=T0(0, 0)), row(page="/p/2", ts=T0(0, 0, 40)), row(et="LOGOUT", ts=T0(0, 2))]
    got = {r.page_url: (r.timed_views, r.avg_time_on_page) for r in sessions.avg_time_on_page(ev(spark, rows)).collect()}
    assert got == {"/p/1": (1, 40), "/p/2": (1, 80)}


# --- windows / dedup ------------------------------------------------------------------

def test_duplicate_event_kept_once(spark):
    rows = [("t", 0, 1, "a"), ("t", 0, 1, "a"), ("t", 0, 2, "a"), ("t", None, 1, "a"), ("t", None, 1, "a")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, user_id string")
    assert windows.dedup_events(df).count() == 4  # the redelivery goes; unknown identities stay
    assert windows.dedup_events(df, ["user_id"]).count() == 1


def test_alert_fires_after_hold_windows(spark):
    base = dt.datetime(2024, 1, 1)
    hits = [base + dt.timedelta(minutes=m) for m in (0, 1, 2, 5, 6, 7, 20, 21, 22)]  # windows 0, 5 above; 10, 15 empty
    df = spark.createDataFrame([(t, "error") for t in hits], "ts timestamp_ntz, event_type string")
    out = {r.window_start: (r.errors, r.above_threshold, r.firing) for r in windows.error_rate_alert(
        df, F.col("event_type") == "error", window_seconds=300, threshold_per_second=2 / 300, hold=2).collect()}
    assert out[base] == (3, True, False)
    assert out[base + dt.timedelta(minutes=5)] == (3, True, True)
    assert out[base + dt.timedelta(minutes=20)] == (3, True, False)


def test_hour_bucket_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "ts timestamp_ntz")
        from clickmart.functions import hour_bucket, micros_between, ntz_lit

        start = ntz_lit(dt.datetime(2024, 3, 10, 1, 30))
        r = df.select(hour_bucket("ts").alias("h"), micros_between(start, "ts").alias("d")).first()
        assert r.h == dt.datetime(2024, 3, 10, 2, 0)
        assert r.d == 3_600_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_panel_sql_text_runs_on_the_tables(spark, sf_dir):
    from clickmart.plans import sql
    from clickmart.plans.registry import tables

    T = tables(spark, sf_dir)
    sql.register_views(spark, {"clickstream_events": T["clickstream_events"]})
    rng = (fx.TIME_FROM, fx.TIME_TO)
    text = """SELECT window(timestamp, '1 hour').start AS time, COUNT(DISTINCT user_id) AS active_users
              FROM clickstream_events WHERE $__timeFilter(timestamp) GROUP BY 1"""
    got = sql.run_sql(spark, text, rng)
    want = P.active_users_by_hour(T, rng)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    recent = sql.run_sql(spark, "SELECT COUNT(*) AS n FROM clickstream_events WHERE timestamp > NOW() - INTERVAL 1 HOUR",
                         now=fx.NOW).first().n
    assert recent == sum(r["count"] for r in P.events_by_type_last_hour(T, fx.NOW).collect())
    with pytest.raises(ValueError):
        sql.expand_macros("SELECT 1 WHERE $__timeFilter(ts)")


def test_fixture_stays_lazy_without_checkpoint_folder(spark, monkeypatch):
    monkeypatch.setattr(fx, "_shared_dir", lambda s: None)
    lazy = fx.raw_clicks(spark, "/root/testdata/sf0.001")
    assert "clickmart-fixture" not in lazy._jdf.queryExecution().toString()
    assert lazy.count() == fx.driver_events(spark, "/root/testdata/sf0.001").count()


def test_dashboard_panels_and_registry_agree():
    import __spark_entry__ as entry
    from clickmart.plans.dashboard import PANELS

    keys = set(entry.queries())
    assert set(PANELS) <= keys
    assert {"event_stream_series_plain", "conversion_rate_latest_nullable"} <= keys
