"""What the job keeps over batches: current tables (B4), corrected window counts
(K7), ranges of delivered offsets (K8), lag in time (N4)."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from clickmart.functions import ntz_lit
from clickmart.operators import bitmaps, marts, windows
from clickmart.schema import PURCHASE, RAW_EVENT_COLUMNS
from clickmart.sinks import files
from clickmart.sinks import tables as tb
from clickmart.streaming import current, ledger, observe
from clickmart.streaming.batch import BatchProcessor, ParquetSink
from clickmart.streaming.delivered import DeliveredOffsets, drop_delivered, islands, merged

DDL = "user_id string, page_url string, event_type string, timestamp timestamp_ntz, session_id string, device string, region string, referrer string"
START = dt.datetime(2024, 1, 1)


def made_events(seed, n=300, spread=7200):
    """Events of few users, sessions and devices, some without one, some without a time."""
    rng = random.Random(seed)
    one = lambda values: rng.choice([*values, None])
    rows = []
    for _ in range(n):
        ts = None if rng.random() < 0.05 else START + dt.timedelta(seconds=rng.randrange(spread), microseconds=rng.randrange(3))
        rows.append((f"u{min(rng.randrange(40), 12)}", "/p", rng.choice(["PAGE_VIEW", "ADD_TO_CART", PURCHASE, "LOGIN"]), ts,
                     one([f"s{k}" for k in range(30)]), one(["mobile", "desktop"]), one(["eu", "us"]), None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def same(a, b):
    assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


def test_current_tables_equal_the_whole(spark, scratch):
    """Batches out of order, each twice, one of them empty, folded on the way."""
    batches = {k: made_events(k, 80) for k in (4, 0, 3, 1)} | {2: []}
    for k, rows in batches.items():
        ev = frame(spark, rows)
        assert current.keep_users(ev, scratch, "s", k) and current.keep_dimensions(ev, scratch, "s", k)
        if k == 3:
            assert ledger.fold(spark, scratch, current.USERS) and ledger.fold(spark, scratch, current.DIMENSIONS)
        assert not current.keep_users(ev, scratch, "s", k) and not current.keep_dimensions(ev, scratch, "s", 4)
    # Another stream over the same tables has batch numbers of its own.
    other = made_events(9, 50)
    assert current.keep_users(frame(spark, other), scratch, "t", 0) and current.keep_dimensions(frame(spark, other), scratch, "t", 0)
    whole = frame(spark, [r for rows in (*batches.values(), other) for r in rows])
    same(current.read_users(spark, scratch), marts.user_behavior_current(whole))
    same(current.read_dimensions(spark, scratch), marts.device_analytics_current(whole))


def test_runs_without_a_commit_are_not_read(spark, scratch):
    ev = frame(spark, made_events(1, 60))
    assert current.keep_users(ev, scratch, "s", 0)
    home = f"{scratch}/_ledgers/{current.USERS.name}"
    state = ledger.read_state(spark, scratch, current.USERS)
    dead = frame(spark, made_events(2, 60))
    # A writer that dies before its commit: all files are there, no commit names them.
    lost = ledger.State(state.seq, state.runs, state.done, state.mark, state.replaced, state.since_fold)
    real, ledger._commit = ledger._commit, lambda *a: (_ for _ in ()).throw(RuntimeError("died"))
    try:
        with pytest.raises(RuntimeError, match="died"):
            current.keep_users(dead, scratch, "s", 1)
    finally:
        ledger._commit = real
    assert len(glob.glob(f"{home}/totals/run=*")) == 2 and ledger.read_state(spark, scratch, current.USERS) == lost
    same(current.read_users(spark, scratch), marts.user_behavior_current(ev))
    assert current.keep_users(dead, scratch, "s", 1)
    same(current.read_users(spark, scratch), marts.user_behavior_current(ev.unionAll(dead)))


def test_the_later_writer_computes_anew(spark, scratch):
    """Two writers with the same new pairs: the one whose number is taken sees the other's."""
    a, b = frame(spark, made_events(1, 60)), frame(spark, made_events(1, 60))
    real, stolen = ledger._commit, []

    def commit(*args):
        if not stolen:
            stolen.append(True)
            assert current.keep_users(b, scratch, "t", 0)  # takes the number meanwhile
        return real(*args)

    ledger._commit = commit
    try:
        assert current.keep_users(a, scratch, "s", 0)
    finally:
        ledger._commit = real
    same(current.read_users(spark, scratch), marts.user_behavior_current(a.unionAll(b)))


def test_a_batch_reads_only_its_buckets(spark, scratch):
    """Members in buckets that the batch does not touch are not even opened."""
    one = [("u1", "/p", "LOGIN", START, "s1", None, None, None)]
    many = [(f"x{k}", "/p", "LOGIN", START, f"s{k}", None, None, None) for k in range(200)]
    current.keep_users(frame(spark, many), scratch, "s", 0)
    own = frame(spark, one).select(F.col("user_id"), F.col("session_id").alias("member")).select(current.USERS.bucket().alias("b")).first().b
    for path in glob.glob(f"{scratch}/_ledgers/{current.USERS.name}/members/run=*/bucket=*/*.parquet"):
        if f"/bucket={own}/" not in path:
            with open(path, "wb") as f:
                f.write(b"not a table")
    assert current.keep_users(frame(spark, one), scratch, "s", 1)
    assert current.read_users(spark, scratch).count() == 201


def window_counts(ev, width="5 minutes"):
    return ev.filter("timestamp is not null").groupBy(F.window("timestamp", width).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "events", "users")


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_windows_after_any_arrival(spark, scratch, order):
    rows = sorted(made_events(5, 400), key=lambda r: r[3] or START)
    parts = {k: rows[100 * k:100 * k + 100] for k in range(4)}
    mark, late = None, []
    for n, k in enumerate(order):
        assert current.keep_windows(frame(spark, parts[k]), scratch, "s", n, batch_date=START.date())
        late += [r for r in parts[k] if mark and r[3] and r[3] - dt.timedelta(seconds=(r[3] - START).total_seconds() % 300) + dt.timedelta(minutes=5) <= mark]
        seen = [r[3] for r in parts[k] if r[3]]
        mark = max([m for m in (mark, max(seen) - dt.timedelta(minutes=10)) if m])
        if n == 2:
            assert ledger.fold(spark, scratch, current.window_ledger("5 minutes"), current.WINDOW_FOLDS)
        assert not current.keep_windows(frame(spark, parts[k]), scratch, "s", n)
    got = current.read_windows(spark, scratch)
    want = window_counts(frame(spark, rows)).filter(F.col("window_end") <= ntz_lit(mark))
    same(got.drop("version"), want)
    stored = current.read_late(spark, scratch)
    assert sorted(map(str, stored.select(*RAW_EVENT_COLUMNS).collect())) == sorted(map(str, frame(spark, late).select(*RAW_EVENT_COLUMNS).collect()))
    assert (len(late) > 0) == (order != (0, 1, 2, 3)) and (got.select("version").distinct().count() > 1)


def test_windows_without_times_or_rows(spark, scratch):
    assert current.keep_windows(frame(spark, []), scratch, "s", 0)
    assert current.keep_windows(frame(spark, [("u", "/p", "LOGIN", None, None, None, None, None)]), scratch, "s", 1)
    assert current.read_windows(spark, scratch).count() == 0 and current.read_late(spark, scratch).count() == 0
    with pytest.raises(ValueError):
        current.keep_windows(frame(spark, []), scratch, "s", 2, delay="soon")


def wire(k, n, user="u"):
    t = START + dt.timedelta(minutes=7 * k)
    return f'{{"userId":"{user}{n % 5}","sessionId":"s{n % 9}","eventType":"{PURCHASE if n % 4 == 0 else "PAGE_VIEW"}","eventTime":"{t.isoformat()}","page":"/p","device":"mobile","region":"eu"}}'


def test_the_job_keeps_all_of_it(spark, scratch):
    """Through the batch processor, replayed, with offsets delivered again in later batches."""
    sink = ParquetSink(scratch, keep=True)
    proc = BatchProcessor(sink, clock=lambda: START, stream_id="s", delivered=DeliveredOffsets(scratch))
    sink.prepare(spark)
    records = [("clicks", n % 2, n // 2, wire(n // 20, n)) for n in range(120)]
    raw = lambda rows: spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    batches = [records[:50], records[30:90] + records[30:40], records[:120]]
    for k, rows in enumerate(batches):
        assert not proc(raw(rows), k).failures
    proc(raw(batches[1]), 1)                   # a replay of a batch in the middle
    again = BatchProcessor(sink, clock=lambda: START, stream_id="s", delivered=DeliveredOffsets(scratch))
    again(raw(records[100:]), 3)               # a restart, nothing new
    stored = tb.read_table(spark, scratch, "clickstream_events")
    assert stored.count() == 120 and stored.select("topic", "partition", "offset").distinct().count() == 120
    same(current.read_users(spark, scratch), marts.user_behavior_current(stored))
    same(current.read_dimensions(spark, scratch), marts.device_analytics_current(stored))
    newest = stored.agg(F.max("timestamp")).first()[0] - dt.timedelta(minutes=10)
    same(current.read_windows(spark, scratch).drop("version"), window_counts(stored).filter(F.col("window_end") <= ntz_lit(newest)))
    # A new checkpoint that starts over stores nothing twice.
    fresh = BatchProcessor(sink, clock=lambda: START, stream_id="t", delivered=DeliveredOffsets(scratch))
    assert fresh(raw(records), 0).empty
    states = files.glob(spark, f"{scratch}/_delivered/stream_id=s/*")
    assert len(files.read_text(spark, max(states))) < 200  # two partitions without a gap


def test_ranges_of_offsets(spark):
    rng = random.Random(3)
    seen = sorted(rng.sample(range(200_000), 2000))
    df = spark.createDataFrame([("a", 0, o) for o in seen] + [("a", 1, o) for o in range(65_000, 66_000)] + [("b", None, 1), (None, 0, 1)], "topic string, partition int, offset bigint")
    ranges = {}
    for r in islands(df.unionAll(df)).collect():
        ranges.setdefault((r.topic, r.partition), []).append([r.lo, r.hi])
    ranges = merged(ranges)
    assert ranges[("a", 1)] == [[65_000, 65_999]]  # joined where two spans touch
    assert sorted(o for lo, hi in ranges[("a", 0)] for o in range(lo, hi + 1)) == seen
    probe = spark.createDataFrame([("a", 0, o) for o in range(0, 200_000, 7)] + [("a", 0, 7), ("a", 2, 65_000), ("a", None, 65_000), ("a", None, 65_000)], df.schema)
    left = drop_delivered(probe, ranges)
    want = {o for o in range(0, 200_000, 7)} - set(seen)
    assert left.filter("partition = 0").count() == len(want) and left.filter("partition is null").count() == 2 and left.filter("partition = 2").count() == 1
    assert drop_delivered(probe, {}).filter("partition = 0").count() == len(range(0, 200_000, 7))


def test_lag_in_seconds(spark):
    rows = [("t", p, o, START + dt.timedelta(seconds=10 * o + p)) for p in range(3) for o in range(100)] + [("t", 0, 100, None), ("u", 0, 5, START)]
    records = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp_ntz")
    committed = spark.createDataFrame([("t", 0, 40), ("t", 1, 100), ("t", 1, 7), ("t", 9, 4)], "topic string, partition int, offset bigint")
    got = {(r.topic, r.partition): (r.offsets_behind, r.seconds_behind) for r in observe.lag_in_time(records, committed).collect()}
    assert got == {("t", 0): (60, 600), ("t", 1): (0, 0), ("t", 2): (100, 990), ("u", 0): (6, 0)}
    progress = {"sources": [{"endOffset": {"t": {"0": 40, "1": 100}}}, {"endOffset": '{"u":{"2":7}}'}, {"endOffset": 3}, {"endOffset": '{"logOffset":1}'}]}
    assert observe.committed_offsets(progress) == [("t", 0, 40), ("t", 1, 100), ("u", 2, 7)]


@pytest.mark.parametrize(("width", "slide"), [("1 hour", "10 minutes"), ("5 minutes", "5 minutes"), ("2 hours", "1 minute")])
def test_sliding_users_by_intervals(spark, width, slide):
    rows = made_events(6, 250, 40_000) + [(None, "/p", "LOGIN", START - dt.timedelta(days=20_000), None, None, None, None), ("old", "/p", "LOGIN", dt.datetime(1969, 12, 31, 23, 59), None, None, None, None)]
    ev = frame(spark, rows)
    w = F.window("timestamp", width, slide)
    want = ev.filter("timestamp is not null").groupBy(w.alias("w")).agg(F.count_distinct("user_id").alias("active_users")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "active_users")
    got = windows.sliding_active_users(ev, width, slide)
    same(got, want)
    zoned = ev.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        assert windows.sliding_active_users(zoned, width, slide).count() == want.count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert "Expand" not in got._jdf.queryExecution().toString()


def test_processor_files_are_there(spark, scratch):
    """Without ``keep`` nothing of it is written."""
    proc = BatchProcessor(ParquetSink(scratch), clock=lambda: START, stream_id="s")
    proc.sink.prepare(spark)
    proc(spark.createDataFrame([(wire(0, n),) for n in range(5)], "value string"), 0)
    assert not os.path.exists(f"{scratch}/_ledgers")


def test_bitmaps_of_any_batches(spark):
    rows = [(*r, k % 5) for k, r in enumerate(made_events(8, 600))] + [(f"v{k}", "/q", "PAGE_VIEW", START, "s", None, None, None, 6) for k in range(3000)]
    ev = spark.createDataFrame(rows + rows[-3000:], DDL + ", batch_id bigint")
    early = bitmaps.user_numbers(ev.filter("batch_id < 2"))
    taken = early.select(((F.col("number") - 1) % bitmaps.NUMBER_BUCKETS).cast("int").alias("bucket"), (F.floor((F.col("number") - 1) / bitmaps.NUMBER_BUCKETS) + 1).alias("used"))
    late = bitmaps.user_numbers(ev.join(early, "user_id", "left_anti"), taken)
    numbers = early.unionByName(late)
    assert numbers.count() == numbers.select("number").distinct().count() == ev.select("user_id").distinct().count() and numbers.agg(F.min("number")).first()[0] >= 1
    for chosen in ((0, 1, 2, 3, 4, 6), (1, 3), (6,)):
        some = ev.filter(F.col("batch_id").isin(*chosen) & (F.col("event_type") == "PAGE_VIEW"))
        want = some.groupBy("page_url").agg(F.count(F.lit(1)).alias("total_views"), F.count_distinct("user_id").alias("unique_visitors"))
        got = bitmaps.top_pages_unique(bitmaps.page_bitmaps(ev, numbers).filter(F.col("batch_id").isin(*chosen)))
        same(got, want)


def test_histogram_of_processing_times(spark):
    rows = [("q", k, None, 5, 1.0, 1.0, ms, 0, {}) for k, ms in enumerate([50, 100, 101, 900, 70_000])] + [("r", 0, None, 5, 1.0, 1.0, 10, 0, {})]
    found = observe.processing_histogram(spark.createDataFrame(rows, observe.PROGRESS_SCHEMA), (100, 1000, 10_000)).collect()
    assert {(r.query_name, r.le_ms): r.batches for r in found} == {
        ("q", 100): 2, ("q", 1000): 4, ("q", 10_000): 4, ("q", None): 5, ("r", 100): 1, ("r", 1000): 1, ("r", 10_000): 1, ("r", None): 1}
