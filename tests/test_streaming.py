"""Streaming: batch/stream equivalence, replay, restart, late data, graceful
stop, progress rows and the failure policy (SURVEY 5.3, 5.4)."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from clickmart.operators import marts
from clickmart.sinks import tables as tb
from clickmart.sources import decode, streams
from clickmart.sources import fixture as fx
from clickmart.streaming import observe, pipeline
from clickmart.streaming.batch import BatchProcessor, ParquetSink

SMOKE = "/root/testdata/sf0.001"
CLOCK = lambda: dt.datetime(2024, 2, 1)


def _write_chunks(spark, src, path, chunks=3):
    """Wire records of ``src`` as ``chunks`` JSON-lines files, written one after another."""
    wire = fx.wire_records(spark, src)
    days = 30 // chunks
    for i in range(chunks):
        part = wire.filter((F.col("batch_id") >= i * days) & (F.col("batch_id") < (i + 1) * days))
        streams.write_wire_files(part.coalesce(1), path)
        time.sleep(1.1)  # distinct modification times keep the file order
    return wire


def _run(spark, raw_dir, root, ckpt, name, processor=None):
    processor = processor or BatchProcessor(ParquetSink(root), clock=CLOCK)
    raw = streams.file_events(spark, raw_dir, max_files_per_trigger=1)
    q = pipeline.start_pipeline(spark, raw, processor, name=name, checkpoint=ckpt, available_now=True)
    q.awaitTermination(300)
    return q, processor


def test_stream_equals_batch_and_replay_is_idempotent(spark, scratch):
    raw_dir, root, ckpt = (os.path.join(scratch, d) for d in ("raw", "tables", "ckpt"))
    _write_chunks(spark, SMOKE, raw_dir)
    q, proc = _run(spark, raw_dir, root, ckpt, "equiv")
    assert [r.batch_id for r in proc.reports if not r.empty] == [0, 1, 2]
    assert all(not r.failures for r in proc.reports)

    stored = tb.read_table(spark, root, "clickstream_events")
    cols = ["user_id", "page_url", "event_type", "timestamp", "session_id", "device", "region", "referrer"]
    expect = fx.clicks(spark, SMOKE).select(*cols)
    assert stored.count() == expect.count()
    assert stored.select(*cols).exceptAll(expect).count() == 0

    # Per-batch metrics add up; exact per-user figures equal the batch derivation.
    rm = tb.read_table(spark, root, "realtime_metrics")
    assert rm.agg(F.sum("total_events")).first()[0] == expect.count()
    cur_stream = marts.user_behavior_current(stored)
    cur_batch = marts.user_behavior_current(fx.clicks(spark, SMOKE))
    assert cur_stream.exceptAll(cur_batch).count() == 0 and cur_batch.exceptAll(cur_stream).count() == 0

    # Quarantine keeps what the decoder dropped.
    quarantined = spark.read.parquet(os.path.join(root, "quarantine_events"))
    assert quarantined.count() == fx.wire_records(spark, SMOKE).count() - expect.count()

    # Replaying a batch id leaves every table unchanged.
    before = {n: tb.read_table(spark, root, n).count() for n in tb.REQUIRED_TABLES}
    files = [os.path.join(raw_dir, f) for f in os.listdir(raw_dir) if f.endswith(".txt")]
    first_file = min(files, key=os.path.getmtime)  # the file batch 0 read
    one = spark.read.text(first_file)
    proc(one, 0)  # under the stream's id, which the pipeline has told the processor
    proc(one, 0)
    after = {n: tb.read_table(spark, root, n).count() for n in tb.REQUIRED_TABLES}
    assert before == after


def test_restart_resumes_from_checkpoint(spark, scratch):
    raw_dir, root, ckpt = (os.path.join(scratch, d) for d in ("raw", "tables", "ckpt"))
    _write_chunks(spark, SMOKE, raw_dir, chunks=2)
    _, first = _run(spark, raw_dir, root, ckpt, "restart")
    n_first = tb.read_table(spark, root, "clickstream_events").count()
    extra = fx.wire_records(spark, SMOKE).limit(5)
    streams.write_wire_files(extra.coalesce(1), raw_dir)
    _, second = _run(spark, raw_dir, root, ckpt, "restart")
    assert [r.batch_id for r in second.reports if not r.empty] == [2]
    assert tb.read_table(spark, root, "clickstream_events").count() > n_first


def test_late_rows_leave_window_counts(spark, scratch):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        raw_dir, out, ckpt = (os.path.join(scratch, d) for d in ("raw", "out", "ckpt"))
        mk = lambda t: f'{{"userId":"u1","sessionId":"s","eventType":"PAGE_VIEW","eventTime":"{t}"}}'
        first = [mk(f"2024-01-01T0{h}:00:00") for h in range(0, 4)]
        # Spark drops a row as late against the watermark of the batch before,
        # so the late row comes two files after the window it belongs to.
        files = (first, [mk("2024-01-01T05:00:00")], [mk("2024-01-01T00:01:00")])
        for lines in files:
            spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(raw_dir)
            time.sleep(1.1)
        raw = streams.file_events(spark, raw_dir, max_files_per_trigger=1)
        q = pipeline.start_window_counts(spark, raw, out, width="5 minutes", watermark="10 minutes",
                                         checkpoint=ckpt, available_now=True, name="late")
        q.awaitTermination(300)
        dropped = sum(observe.late_rows(p) for p in q.recentProgress)
        assert dropped == 1
        counts = spark.read.parquet(out)
        assert counts.filter(F.col("window_start") == F.lit("2024-01-01 00:00:00").cast("timestamp")).first().events == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_graceful_stop_and_progress_rows(spark, scratch):
    raw_dir, root, ckpt = (os.path.join(scratch, d) for d in ("raw", "tables", "ckpt"))
    _write_chunks(spark, SMOKE, raw_dir, chunks=1)
    rec = observe.ProgressRecorder()
    spark.streams.addListener(rec)
    try:
        raw = streams.file_events(spark, raw_dir)
        q = pipeline.start_pipeline(spark, raw, BatchProcessor(ParquetSink(root), clock=CLOCK),
                                    name="graceful", checkpoint=ckpt, trigger="1 second")
        deadline = time.time() + 120
        while time.time() < deadline and not any(p.get("numInputRows", 0) for p in map(observe._as_dict, q.recentProgress)):
            time.sleep(0.5)
        pipeline.stop_gracefully(q)
        assert not q.isActive
        time.sleep(1)
        frame = rec.to_frame(spark)
        row = frame.filter("input_rows > 0").first()
        assert row is not None and row.observed["ingest.records"] == str(row.input_rows)
        observe.write_progress(frame, root)
        observe.write_progress(frame, root)  # again: read once
        stored = observe.read_progress(spark, root)
        assert stored.count() == frame.count() and stored.filter("query = 'graceful'").count() > 0
        status = observe.pipeline_status(frame).filter("query_name = 'graceful'").first()
        assert status.input_rows == frame.filter("query_name = 'graceful'").agg(F.sum("input_rows")).first()[0]
        assert status.last_batch_id >= 0 and status.batches >= 1
        assert observe.consumer_lag(q.recentProgress[-1])[0]["avg_offsets_behind"] is None
    finally:
        spark.streams.removeListener(rec)


class _FailingSink(ParquetSink):
    def write(self, df, name, batch_id, *where):
        if name == "page_metrics":
            raise IOError("disk full" + "!" * 5000)
        super().write(df, name, batch_id, *where)


def test_failure_policy(spark, scratch):
    one = decode.quarantine_events  # noqa: F841  (import check)
    wire = fx.wire_records(spark, SMOKE).select("value").limit(50)
    lenient = BatchProcessor(_FailingSink(scratch), strict=False, clock=CLOCK, parallel=False)
    report = lenient(wire, 3)
    assert "page_metrics" in report.failures and "realtime_metrics" in report.written
    failures = spark.read.parquet(os.path.join(scratch, "sink_failures")).collect()
    assert [(r.batch_id, r.sink) for r in failures] == [(3, "page_metrics")]
    assert failures[0].error.endswith("!" * 5000)  # in full
    strict = BatchProcessor(_FailingSink(scratch), strict=True, clock=CLOCK)
    with pytest.raises(RuntimeError, match="page_metrics"):
        strict(wire, 4)


def test_empty_batch_writes_nothing(spark, scratch):
    proc = BatchProcessor(ParquetSink(scratch), clock=CLOCK)
    report = proc(spark.createDataFrame([], "value string"), 9)
    assert report.empty and not os.listdir(scratch)


def _wire(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, value string")


def _event(user="u1", device="phone", time="not-a-time", kind="PAGE_VIEW", **more):
    import json

    return json.dumps({"userId": user, "sessionId": "s", "eventType": kind, "eventTime": time, "page": "/p", "device": device, **more})


def test_no_event_is_lost(spark, scratch):
    rows = [("t", 0, 0, _event(device="a")), ("t", 0, 1, _event(device="b")), ("t", 1, 0, _event(device="b")),
            ("t", 0, 2, _event(time="2024-01-01T00:00:00")), ("t", 0, 3, _event(time="2024-01-01T00:00:00", device="tv"))]
    proc = BatchProcessor(ParquetSink(scratch), clock=CLOCK)
    proc(_wire(spark, rows), 0)
    stored = tb.read_table(spark, scratch, "clickstream_events")
    assert stored.count() == 5
    assert {(r.partition, r.offset) for r in stored.collect()} == {(0, 0), (0, 1), (1, 0), (0, 2), (0, 3)}
    # Redeliveries go on request, by identity only.
    again = BatchProcessor(ParquetSink(scratch), clock=CLOCK, dedupe=True, stream_id="again")
    again(_wire(spark, rows + rows[:2]), 0)
    assert tb.read_table(spark, scratch, "clickstream_events").filter("stream_id = 'again'").count() == 5


def test_amounts_reach_the_stored_table(spark, scratch):
    from clickmart.plans import panels

    rows = [("t", 0, 0, _event(kind="PURCHASE", amount=12.5)), ("t", 0, 1, _event(kind="PURCHASE", amount="7.25")),
            ("t", 0, 2, _event(kind="PURCHASE")), ("t", 0, 3, _event(kind="PURCHASE", amount="much"))]
    BatchProcessor(ParquetSink(scratch), clock=CLOCK)(_wire(spark, rows), 0)
    T = tb.read_tables(spark, scratch)
    assert panels.top_users_by_page_views(T).first().lifetime_value == 19.75


def test_two_streams_keep_their_batches(spark, scratch):
    for stream, user in (("one", "u1"), ("two", "u2")):
        BatchProcessor(ParquetSink(scratch), clock=CLOCK, stream_id=stream)(_wire(spark, [("t", 0, 0, _event(user))]), 0)
    assert sorted(r.user_id for r in tb.read_table(spark, scratch, "clickstream_events").collect()) == ["u1", "u2"]


def test_two_checkpoints_on_one_root(spark, scratch):
    raw_dir, root = os.path.join(scratch, "raw"), os.path.join(scratch, "tables")
    _write_chunks(spark, SMOKE, raw_dir, chunks=1)
    for ckpt in ("a", "b"):
        _run(spark, raw_dir, root, os.path.join(scratch, ckpt), f"two_{ckpt}")
    ev = tb.read_table(spark, root, "clickstream_events")
    assert ev.select("stream_id").distinct().count() == 2
    assert ev.count() == 2 * fx.clicks(spark, SMOKE).count()


def test_replay_clears_what_is_no_longer_there(spark, scratch):
    clock = iter([dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)])
    proc = BatchProcessor(ParquetSink(scratch), clock=lambda: next(clock))
    day = "2024-01-01T00:00:00"
    proc(_wire(spark, [("t", 0, 0, _event(time=day)), ("t", 0, 1, _event(time=day, kind="LOGIN"))]), 5)
    assert tb.read_table(spark, scratch, "page_metrics").count() == 1
    proc(_wire(spark, [("t", 0, 1, _event(time="2024-01-02T00:00:00", kind="LOGIN"))]), 5)
    assert tb.read_table(spark, scratch, "page_metrics").count() == 0
    assert tb.read_table(spark, scratch, "clickstream_events").count() == 1
    metrics = tb.read_table(spark, scratch, "realtime_metrics").collect()
    assert [m.metric_timestamp for m in metrics] == [dt.datetime(2024, 2, 1)]  # the batch's time stays


def test_writers_run_in_the_query_s_job_group(spark, scratch):
    seen = []

    class Sink(ParquetSink):
        def write(self, df, *a):
            seen.append(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))

    spark.sparkContext.setJobGroup("the-query", "test")
    try:
        BatchProcessor(Sink(scratch), clock=CLOCK)(_wire(spark, [("t", 0, 0, _event())]), 0)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen and set(seen) == {"the-query"}


def test_stop_that_cannot_wait(spark, scratch):
    class Busy:
        isActive, status, name, stopped = True, {"isTriggerActive": True}, "busy", False

        def stop(self):
            self.stopped = True

    q = Busy()
    with pytest.raises(TimeoutError):
        pipeline.stop_gracefully(q, 0.3)
    assert not q.stopped
    pipeline.stop_gracefully(q, 0.3, force=True)
    assert q.stopped


def test_recorder_writes_its_tables(spark, scratch):
    rec = observe.ProgressRecorder(spark, scratch, flush_every=1)
    raw_dir = os.path.join(scratch, "raw")
    _write_chunks(spark, SMOKE, raw_dir, chunks=1)
    spark.streams.addListener(rec)
    try:
        _run(spark, raw_dir, os.path.join(scratch, "tables"), os.path.join(scratch, "ckpt"), "recorded")
        deadline = time.time() + 60
        while time.time() < deadline and not os.path.isdir(os.path.join(scratch, observe.LAG_TABLE)):
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(rec)
    rec.flush()
    assert observe.read_progress(spark, scratch).filter("query = 'recorded' and input_rows > 0").count() >= 1
    assert observe.read_lag(spark, scratch).filter("query = 'recorded'").count() >= 1 and rec.rows() == []


def _stream_events(spark, scratch):
    raw_dir = os.path.join(scratch, "raw")
    _write_chunks(spark, SMOKE, raw_dir, chunks=2)
    raw = streams.file_events(spark, raw_dir, max_files_per_trigger=1)
    return decode.to_click_events(decode.parse_events(raw), zoned=True).filter(F.col("timestamp").isNotNull())


def _drain(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return q


def test_window_operators_on_a_stream_match_batch(spark, scratch):
    from clickmart.operators import windows

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        batch = fx.clicks(spark, SMOKE).filter(F.col("timestamp").isNotNull())
        ev = _stream_events(spark, scratch)
        as_ntz = lambda df: df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
            "window_end", F.col("window_end").cast("timestamp_ntz"))

        _drain(windows.tumbling_event_counts(ev, "5 minutes", watermark="10 minutes"), "s_tumbling", "complete")
        got = as_ntz(spark.table("s_tumbling"))
        want = windows.tumbling_event_counts(batch, "5 minutes")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

        _drain(windows.sliding_active_users(ev, watermark="10 minutes", approx=True), "s_sliding", "complete")
        got = {(r.window_start, r.active_users) for r in as_ntz(spark.table("s_sliding")).collect()}
        want = {(r.window_start, r.active_users) for r in windows.sliding_active_users(batch).collect()}
        assert {w for w, _ in got} == {w for w, _ in want}
        exact = dict(want)
        assert all(abs(n - exact[w]) <= max(1, 0.1 * exact[w]) for w, n in got)

        _drain(windows.approx_uniques_windowed(ev, watermark="10 minutes"), "s_uniques", "complete")
        assert spark.table("s_uniques").agg(F.sum("events")).first()[0] == batch.count()

        _drain(windows.active_sessions(ev, watermark="10 minutes", approx=True), "s_sessions", "complete")
        assert spark.table("s_sessions").count() == windows.active_sessions(batch).count()

        keys = ["user_id", "session_id", "event_type", "timestamp", "page_url"]
        dup = ev.unionByName(ev.filter(F.col("event_type") == "PURCHASE"))
        _drain(windows.dedup_events(dup, keys, watermark="10 minutes").select(*keys), "s_dedup", "append")
        assert spark.table("s_dedup").count() == batch.select(*keys).distinct().count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_session_windows_on_a_stream(spark, scratch):
    from clickmart.operators import sessions

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        ev = _stream_events(spark, scratch)
        q = _drain(sessions.session_windows(ev, gap_seconds=3600, watermark="1 hour"), "s_sessions_k4", "append")
        got = spark.table("s_sessions_k4").withColumn("session_start", F.col("session_start").cast("timestamp_ntz")) \
            .withColumn("session_end", F.col("session_end").cast("timestamp_ntz"))
        batch = sessions.derived_sessions(fx.clicks(spark, SMOKE), gap_seconds=3600).drop("session_seq")
        # Append mode emits the sessions the final watermark has closed.
        wm = observe._as_dict(q.lastProgress)["eventTime"]["watermark"]
        closed = batch.filter(F.col("session_end") + F.expr("INTERVAL 1 HOUR") <= F.lit(wm[:19].replace("T", " ")).cast("timestamp_ntz"))
        assert got.count() > 0
        assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_job_command_and_dashboard(spark, scratch):
    from clickmart.plans import dashboard
    from clickmart.streaming import job

    raw_dir, root, ckpt = (os.path.join(scratch, d) for d in ("raw", "tables", "ckpt"))
    _write_chunks(spark, SMOKE, raw_dir, chunks=1)
    args = job.parse_args(["--files", raw_dir, "--tables", root, "--available-now", "--checkpoint", ckpt,
                           "--name", "jobcli"])
    job.run(spark, args).awaitTermination(300)
    now, rng = fx.NOW, (fx.TIME_FROM, fx.TIME_TO)
    count = dashboard.run_panel(spark, root, "event_count_check", now, rng).first().event_count
    assert count == fx.clicks(spark, SMOKE).count()
    assert dashboard.run_panel(spark, root, "top_pages", now, rng).count() == 10
    assert dashboard.run_panel(spark, root, "hourly_activity", now, rng).count() > 0


def test_retry_in_a_later_batch_is_dropped(spark, scratch):
    raw_dir, root, ckpt = (os.path.join(scratch, d) for d in ("raw", "tables", "ckpt"))
    mk = lambda u, t: f'{{"userId":"{u}","sessionId":"s","eventType":"PAGE_VIEW","eventTime":"{t}","page":"/p"}}'
    first = [(mk("u1", "2024-01-01T00:00:00"), "2024-01-01 00:00:01"), (mk("u2", "2024-01-01T00:00:05"), "2024-01-01 00:00:06")]
    retry = [(mk("u1", "2024-01-01T00:00:00"), "2024-01-01 00:00:30"), (mk("u3", "2024-01-01T00:00:40"), "2024-01-01 00:00:41")]
    for rows in (first, retry):
        spark.createDataFrame(rows, "value string, ts string").selectExpr(
            "value", "CAST(ts AS TIMESTAMP) AS timestamp").coalesce(1).write.mode("append").json(raw_dir)
        time.sleep(1.1)
    raw = spark.readStream.schema("value string, timestamp timestamp").option("maxFilesPerTrigger", 1).json(raw_dir)
    proc = BatchProcessor(ParquetSink(root), clock=CLOCK)
    q = pipeline.start_pipeline(spark, raw, proc, name="retry", checkpoint=ckpt, available_now=True,
                                dedup_within="10 minutes")
    q.awaitTermination(300)
    users = sorted(r.user_id for r in tb.read_table(spark, root, "clickstream_events").collect())
    assert users == ["u1", "u2", "u3"]
    assert len([r for r in proc.reports if not r.empty]) == 2
