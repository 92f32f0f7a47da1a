"""Property tests: the skew-safe session operators against a
plain Python brute force, and invariants of the marts."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickmart.functions import ntz_lit
from clickmart.operators import marts, sessions

BASE = dt.datetime(2024, 1, 1)
TYPES = ["PAGE_VIEW", "ADD_TO_CART", "PURCHASE", "LOGIN"]

events_strategy = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", "u3"]),
        st.integers(min_value=0, max_value=6 * 3600),        # seconds after BASE, spans several buckets
        st.sampled_from(TYPES),
        st.sampled_from(["/a", "/b"]),
        st.sampled_from(["s1", "s2", None]),
        st.sampled_from(["mobile", "desktop", None]),
    ),
    min_size=1, max_size=40,
)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    data = [(u, "/home", t, BASE + dt.timedelta(seconds=s), sess, d, "r1", p, 0) for u, s, t, p, sess, d in rows]
    return spark.createDataFrame(
        data, "user_id string, referrer string, event_type string, timestamp timestamp_ntz, session_id string, "
              "device string, region string, page_url string, batch_id bigint")


def _brute_sessions(rows, gap):
    out = {}
    for u in {r[0] for r in rows}:
        times = sorted(r[1] for r in rows if r[0] == u)
        seq, prev = 0, None
        for t in times:
            if prev is None or t - prev > gap:
                seq += 1
            out[(u, t)] = seq
            prev = t
    return out


def _page_rows(e):
    """The stored page row from the four operators of its own, joined."""
    keys = ["batch_id", "page_url"]
    parts = [sessions.avg_time_on_page(e, True).select(*keys, "avg_time_on_page"),
             sessions.page_bounce_rate(e, True).select(*keys, "bounce_rate"),
             sessions.page_conversion_rate(e, True).select(*keys, "conversion_rate")]
    out = marts.page_metrics(e)
    for part in parts:
        same = F.lit(True)
        part = part.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in part.columns])
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"r_{k}"))
        out = out.join(part, same, "left").drop("r_batch_id", "r_page_url")
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(rows=st.lists(
    st.tuples(st.sampled_from(["u1", "u2", None]), st.one_of(st.none(), st.integers(0, 200)), st.sampled_from([*TYPES, None]),
              st.sampled_from(["/a", "/b", "/c", None]), st.sampled_from(["s1", "s2", None]), st.sampled_from([0, 1])),
    min_size=1, max_size=40))
def test_page_row_of_one_scan_equals_its_four_operators(spark, rows):
    data = [(u, t, None if s is None else BASE + dt.timedelta(seconds=s), sess, p, b) for u, s, t, p, sess, b in rows]
    e = spark.createDataFrame(data * 2, "user_id string, event_type string, timestamp timestamp_ntz, session_id string, page_url string, batch_id bigint")
    assert _rows(marts.page_metrics_full(e)) == _rows(_page_rows(e))


def test_page_row_and_funnel_of_a_hot_session_in_one_hour(spark):
    n = 20_000  # most rows are one session's, of many pages, in one hour; ties on purpose
    e = spark.range(n).select(
        F.lit("u").alias("user_id"), F.element_at(F.array(*map(F.lit, TYPES)), (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        F.timestamp_add("SECOND", (F.col("id") % 3600).cast("int"), ntz_lit(BASE)).alias("timestamp"), F.lit("hot").alias("session_id"),
        F.concat(F.lit("/"), (F.col("id") % 997).cast("string")).alias("page_url"), F.lit(0).cast("bigint").alias("batch_id"))
    alone = e.limit(1).withColumn("session_id", F.lit("alone"))
    e = e.unionByName(alone).unionByName(e.limit(50).withColumn("session_id", F.lit(None).cast("string")))
    assert _rows(marts.page_metrics_full(e)) == _rows(_page_rows(e))
    assert [r.sessions for r in sessions.session_funnel(e).collect()] == [2, 1, 1]
    assert [r.sessions for r in sessions.session_funnel(e.limit(0)).collect()] == [0, 0, 0]


@SETTINGS
@given(rows=events_strategy, gap=st.sampled_from([60, 900, 1800, 7200]))
def test_sessionize_matches_brute_force(spark, rows, gap):
    got = sessions.sessionize(_frame(spark, rows), gap_seconds=gap, bucket_micros=1_800_000_000).select(
        "user_id", "timestamp", "session_seq").collect()
    expect = _brute_sessions(rows, gap)
    assert len(got) == len(rows)
    for r in got:
        assert r.session_seq == expect[(r.user_id, int((r.timestamp - BASE).total_seconds()))]


@SETTINGS
@given(rows=events_strategy)
def test_next_time_matches_brute_force(spark, rows):
    df = _frame(spark, rows).filter(F.col("session_id").isNotNull())
    got = sessions.with_next_time(df, ["session_id"], bucket_micros=600_000_000).select(
        "session_id", "timestamp", "event_type", "page_url", "next_ts").collect()
    keyed = sorted(((r[4], r[1], r[2], r[3]) for r in rows if r[4] is not None))
    expect = []
    for i, (s, t, et, p) in enumerate(keyed):
        nxt = keyed[i + 1][1] if i + 1 < len(keyed) and keyed[i + 1][0] == s else None
        expect.append((s, t, et, p, nxt))
    have = [(r.session_id, int((r.timestamp - BASE).total_seconds()), r.event_type, r.page_url,
             None if r.next_ts is None else int((r.next_ts - BASE).total_seconds())) for r in got]
    nulls_first = lambda t: (*t[:4], -1 if t[4] is None else t[4])
    assert sorted(have, key=nulls_first) == sorted(expect, key=nulls_first)


@SETTINGS
@given(rows=events_strategy)
def test_mart_invariants(spark, rows):
    e = _frame(spark, rows)
    rm = marts.realtime_metrics(e, ntz_lit(BASE)).first()
    assert 0.0 <= rm.bounce_rate <= 100.0
    assert rm.total_events == len(rows)
    da = marts.device_analytics(e).filter("dimension_type = 'device'").agg(F.sum("event_count")).first()[0]
    assert da == len(rows)
    funnel = [r.sessions for r in sorted(sessions.session_funnel(e).collect(), key=lambda r: r.stage_order)]
    assert funnel[0] >= funnel[1] >= funnel[2]


def test_hot_user_sessions_match_sql_brute_force(spark):
    """One user holds most rows (the skew the bucketed plan is built for);
    sessions must equal a plain window-function derivation in DuckDB."""
    import random

    import duckdb
    import pandas as pd

    rnd = random.Random(7)
    rows, t = [], 0
    for _ in range(18_000):                       # hot user: bursts with occasional long pauses
        t += rnd.choice([1, 5, 30, 120, 600, 1800, 1801, 5400])
        rows.append(("hot", BASE + dt.timedelta(seconds=t)))
    for u in range(200):                          # the long tail
        for _ in range(10):
            rows.append((f"u{u}", BASE + dt.timedelta(seconds=rnd.randint(0, 2 * 86400))))
    pdf = pd.DataFrame(rows, columns=["user_id", "timestamp"])
    df = spark.createDataFrame(pdf, "user_id string, timestamp timestamp_ntz")

    got = sessions.derived_sessions(df, gap_seconds=1800).select(
        "user_id", "session_seq", "session_start", "session_end", "events").toPandas()
    want = duckdb.sql("""
        WITH g AS (SELECT *, CASE WHEN lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp")
                   + INTERVAL 1800 SECOND >= "timestamp" THEN 0 ELSE 1 END AS brk FROM pdf),
             s AS (SELECT *, SUM(brk) OVER (PARTITION BY user_id ORDER BY "timestamp"
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_seq FROM g)
        SELECT user_id, CAST(session_seq AS BIGINT) AS session_seq, MIN("timestamp") AS session_start,
               MAX("timestamp") AS session_end, COUNT(*) AS events FROM s GROUP BY 1, 2""").df()
    key = ["user_id", "session_seq"]
    got = got.sort_values(key).reset_index(drop=True)
    want = want.sort_values(key).reset_index(drop=True)
    assert len(got) == len(want) and (got["user_id"] == "hot").sum() > 100
    assert (got[key].values == want[key].values).all()
    assert (got["events"].values == want["events"].values).all()
    assert (pd.to_datetime(got["session_start"]).values == pd.to_datetime(want["session_start"]).values).all()
    assert (pd.to_datetime(got["session_end"]).values == pd.to_datetime(want["session_end"]).values).all()


def test_hot_session_time_on_page_matches_sql(spark):
    """One session holds most rows across many hour buckets (with ties and
    bucket-boundary times); M2 must equal a plain ``lead`` derivation."""
    import random

    import duckdb
    import pandas as pd

    rnd = random.Random(11)
    rows, t = [], 0
    for _ in range(20_000):
        t += rnd.choice([0, 0, 1, 7, 60, 3599, 3600])
        rows.append(("hot", BASE + dt.timedelta(seconds=t), rnd.choice(TYPES), rnd.choice(["/a", "/b", "/c"])))
    for s in range(300):
        for _ in range(5):
            rows.append((f"s{s}", BASE + dt.timedelta(seconds=rnd.randint(0, 86400)), rnd.choice(TYPES), "/a"))
    pdf = pd.DataFrame(rows, columns=["session_id", "timestamp", "event_type", "page_url"])
    df = spark.createDataFrame(pdf, "session_id string, timestamp timestamp_ntz, event_type string, page_url string")
    got = {r.page_url: (r.timed_views, r.avg_time_on_page) for r in sessions.avg_time_on_page(df).collect()}
    want = duckdb.sql("""
        WITH n AS (SELECT *, lead("timestamp") OVER (PARTITION BY session_id ORDER BY "timestamp", event_type, page_url) AS nxt
                   FROM pdf)
        SELECT page_url, COUNT(nxt) AS timed_views,
               CASE WHEN COUNT(nxt) > 0 THEN SUM(date_diff('microsecond', "timestamp", nxt)) // (COUNT(nxt) * 1000000) END AS avg
        FROM n WHERE event_type = 'PAGE_VIEW' GROUP BY page_url""").fetchall()
    assert got == {p: (int(n), None if a is None else int(a)) for p, n, a in want}


def _brute_funnel(rows):
    by_session = {}
    for _, s, t, _, sess, _ in rows:
        if sess is not None:
            by_session.setdefault(sess, []).append((s, t))
    counts = [0, 0, 0]
    for evs in by_session.values():
        views = [s for s, t in evs if t == "PAGE_VIEW"]
        if not views:
            continue
        v = min(views)
        counts[0] += 1
        carts = [s for s, t in evs if t == "ADD_TO_CART" and s >= v]
        counts[1] += bool(carts)
        buys = [s for s, t in evs if t == "PURCHASE"]
        counts[2] += any(p >= a for a in carts for p in buys)
    return counts


@SETTINGS
@given(rows=events_strategy)
def test_session_funnel_matches_brute_force(spark, rows):
    got = {r.stage_order: r.sessions for r in sessions.session_funnel(_frame(spark, rows)).collect()}
    want = _brute_funnel([(u, s, t, p, sess, d) for u, s, t, p, sess, d in rows])
    assert [got[1], got[2], got[3]] == want


@SETTINGS
@given(rows=events_strategy)
def test_page_bounce_and_conversion_match_brute_force(spark, rows):
    df = _frame(spark, rows)
    by_session = {}
    for _, s, t, p, sess, _ in rows:
        if sess is not None:
            by_session.setdefault(sess, []).append((s, t, p))
    landing, bounced, viewed, converted = {}, {}, {}, {}
    for evs in by_session.values():
        first = min(evs)                                   # order: time, type, page
        landing[first[2]] = landing.get(first[2], 0) + 1
        bounced[first[2]] = bounced.get(first[2], 0) + (len(evs) == 1)
        bought = any(t == "PURCHASE" for _, t, _ in evs)
        for page in {p for _, t, p in evs if t == "PAGE_VIEW"}:
            viewed[page] = viewed.get(page, 0) + 1
            converted[page] = converted.get(page, 0) + bought
    rate = lambda n, d: ((n * 20000 + d) // (2 * d)) / 100.0
    got_b = {r.page_url: (r.landing_sessions, r.bounced_sessions, r.bounce_rate)
             for r in sessions.page_bounce_rate(df).collect()}
    assert got_b == {p: (n, bounced[p], rate(bounced[p], n)) for p, n in landing.items()}
    got_c = {r.page_url: (r.sessions, r.converted_sessions, r.conversion_rate)
             for r in sessions.page_conversion_rate(df).collect()}
    assert got_c == {p: (n, converted[p], rate(converted[p], n)) for p, n in viewed.items()}


@SETTINGS
@given(rows=events_strategy)
def test_realtime_metrics_match_brute_force(spark, rows):
    r = marts.realtime_metrics(_frame(spark, rows), ntz_lit(BASE)).first()
    groups = {}
    for _, s, t, _, sess, _ in rows:
        groups.setdefault(sess, []).append(s)         # the NULL session is one group
    bounced = sum(len(v) == 1 for v in groups.values())
    spans = [max(v) - min(v) for k, v in groups.items() if k is not None]
    assert r.total_events == len(rows)
    assert r.unique_users == len({u for u, *_ in rows})
    assert r.unique_sessions == len([k for k in groups if k is not None])
    assert r.page_views == sum(t == "PAGE_VIEW" for _, _, t, *_ in rows)
    assert r.bounce_rate == ((bounced * 20000 + len(groups)) // (2 * len(groups))) / 100.0
    assert r.avg_session_duration == (sum(spans) // len(spans) if spans else 0)


@SETTINGS
@given(rows=events_strategy)
def test_user_and_dimension_marts_match_brute_force(spark, rows):
    df = _frame(spark, rows)
    users = {}
    for u, s, t, _, sess, _ in rows:
        d = users.setdefault(u, {"sessions": set(), "events": 0, "purchases": 0, "last": s})
        if sess is not None:
            d["sessions"].add(sess)
        d["events"] += 1
        d["purchases"] += t == "PURCHASE"
        d["last"] = max(d["last"], s)
    got = {r.user_id: (r.sessions, r.events, r.purchases, int((r.last_active - BASE).total_seconds()))
           for r in marts.user_behavior(df).collect()}
    assert got == {u: (len(d["sessions"]), d["events"], d["purchases"], d["last"]) for u, d in users.items()}

    dev = {}
    for u, _, t, _, _, device in rows:
        d = dev.setdefault(device, {"events": 0, "users": set(), "buyers": set()})
        d["events"] += 1
        d["users"].add(u)
        if t == "PURCHASE":
            d["buyers"].add(u)
    rate = lambda n, m: ((n * 20000 + m) // (2 * m)) / 100.0
    got = {r.dimension_value: (r.event_count, r.unique_users, r.conversion_rate)
           for r in marts.device_analytics(df).filter("dimension_type = 'device'").collect()}
    assert got == {k: (d["events"], len(d["users"]), rate(len(d["buyers"]), len(d["users"]))) for k, d in dev.items()}


@SETTINGS
@given(rows=events_strategy)
def test_windows_match_brute_force(spark, rows):
    from clickmart.operators import windows

    df = _frame(spark, rows)
    tumbling = {}
    for _, s, t, *_ in rows:
        start = s // 300 * 300
        tumbling[(start, t)] = tumbling.get((start, t), 0) + 1
    got = {(int((r.window_start - BASE).total_seconds()), r.event_type): r.events
           for r in windows.tumbling_event_counts(df, "5 minutes").collect()}
    assert got == tumbling

    sliding = {}
    for u, s, *_ in rows:
        first = s // 600 * 600 - 3000                # the six 1-hour windows sliding by 10 minutes
        for start in range(first, first + 3600, 600):
            if start <= s < start + 3600:
                sliding.setdefault(start, set()).add(u)
    got = {int((r.window_start - BASE).total_seconds()): r.active_users
           for r in windows.sliding_active_users(df, "1 hour", "10 minutes").collect()}
    assert got == {k: len(v) for k, v in sliding.items()}


@SETTINGS
@given(minutes=st.lists(st.integers(min_value=0, max_value=120), min_size=1, max_size=60),
       hold=st.integers(min_value=1, max_value=3), threshold=st.sampled_from([0.0, 1 / 300, 2 / 300]))
def test_error_alert_matches_brute_force(spark, minutes, hold, threshold):
    from clickmart.operators import windows

    df = spark.createDataFrame([(BASE + dt.timedelta(minutes=m), "error") for m in minutes],
                               "ts timestamp_ntz, event_type string")
    per = {}
    for m in minutes:
        per[m // 5 * 5] = per.get(m // 5 * 5, 0) + 1
    above = {w for w, n in per.items() if n / 300 > threshold}
    want = {w: (n, w in above, all(w - 5 * i in above for i in range(hold))) for w, n in per.items()}
    got = {int((r.window_start - BASE).total_seconds() // 60): (r.errors, r.above_threshold, r.firing)
           for r in windows.error_rate_alert(df, F.col("event_type") == "error", 300, threshold, hold).collect()}
    assert got == want


@SETTINGS
@given(rows=events_strategy, copies=st.lists(st.integers(0, 50), max_size=20))
def test_dedup_matches_brute_force(spark, rows, copies):
    from clickmart.operators import windows

    # Every row has an offset of its own but for every fifth, whose source is unknown.
    numbered = [(k if k % 5 else None, r) for k, r in enumerate(rows)]
    sent = numbered + [numbered[c % len(numbered)] for c in copies if numbered]
    df = spark.createDataFrame([("t", 0, o, r[0]) for o, r in sent], "topic string, partition int, offset long, user_id string")
    got = sorted(((r.offset, r.user_id) for r in windows.dedup_events(df).collect()), key=str)
    known = {(o, r[0]) for o, r in sent if o is not None}
    assert got == sorted([*known, *[(None, r[0]) for o, r in sent if o is None]], key=str)
