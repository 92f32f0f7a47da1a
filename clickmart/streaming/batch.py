"""B2: the micro-batch callback -- one bounded DataFrame in, five tables out.

``BatchProcessor`` is what ``foreachBatch`` calls.  It decodes the batch
once, keeps it persisted for the derivations, writes every table
idempotently (replacing what the same batch of the same stream left), and
never swallows a failure silently: in strict mode (default) a failed sink
fails the batch and thereby ends the query, and a restart replays the batch
from the same offsets; in lenient mode the error is recorded as a row of
``sink_failures`` (N5) and the other sinks go on.

Every usable record is kept.  Repeated deliveries are dropped only on request
and only by the record's identity (topic, partition, offset).
"""

from __future__ import annotations

import datetime as dt
import logging
import threading
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions import ntz_lit
from clickmart.operators.marts import build_marts
from clickmart.operators.windows import dedup_events
from clickmart.schema import AMOUNT, IDENTITY
from clickmart.sinks import jdbc as jdbc_sink
from clickmart.sinks.tables import DEFAULT_STREAM, batch_time, create_tables, replace_batch, require_tables, write_batch_idempotent
from clickmart.sources.decode import decode_records, events_of, identity_of, rejects_of, to_click_events
from clickmart.streaming import current
from clickmart.streaming.delivered import DeliveredOffsets, drop_delivered, islands

log = logging.getLogger(__name__)

FAILURES_TABLE = "sink_failures"
QUARANTINE_TABLE = "quarantine_events"
FAILURE_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("sink", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
    T.StructField("failed_at", T.TimestampNTZType(), False),
])


class ParquetSink:
    """Tables as Parquet directories under ``root`` (see :mod:`clickmart.sinks.tables`).

    With ``keep`` the job also keeps the current tables and the window counts of
    ``window`` with corrections for events later than ``delay`` (see
    :mod:`clickmart.streaming.current`)."""

    def __init__(self, root: str, keep: bool = False, window: str = "5 minutes", delay: str = "10 minutes"):
        self.root = root.rstrip("/")
        self.keep, self.window, self.delay = keep, window, delay

    def keepers(self, ev: DataFrame, batch_id: int, stream_id: str, batch_date: dt.date | None, region_label: str) -> dict[str, Callable[[], object]]:
        """What is kept over all batches: a step for each, to be run for this one."""
        if not self.keep:
            return {}
        return {
            current.USERS.name: lambda: current.keep_users(ev, self.root, stream_id, batch_id),
            current.DIMENSIONS.name: lambda: current.keep_dimensions(ev, self.root, stream_id, batch_id, region_label),
            current.window_ledger(self.window).name: lambda: current.keep_windows(ev, self.root, stream_id, batch_id, self.window, self.delay, batch_date),
        }

    def prepare(self, spark) -> None:
        """Start-up check: create missing tables, then require all five with
        their declared columns (fails naming the first bad one)."""
        create_tables(spark, self.root)
        require_tables(spark, self.root)

    def batch_time(self, spark, stream_id: str, batch_id: int, now: dt.datetime) -> dt.datetime:
        return batch_time(spark, self.root, stream_id, batch_id, now)

    def write(self, df: DataFrame, name: str, batch_id: int, stream_id: str = DEFAULT_STREAM, batch_date: dt.date | None = None) -> None:
        if name in (FAILURES_TABLE, QUARANTINE_TABLE):
            out = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).withColumn("stream_id", F.lit(stream_id))
            out = out.withColumn("batch_date", F.lit(batch_date).cast("date"))
            replace_batch(out, self.root, name, ("batch_date", "stream_id", "batch_id"), stream_id, batch_id)
        else:
            write_batch_idempotent(df, self.root, name, batch_id, stream_id, batch_date)


class JdbcSink:
    """Tables in a database reached by JDBC; a replayed batch replaces its rows."""

    def __init__(self, conf: Mapping[str, str]):
        self.conf = dict(conf)

    def prepare(self, spark) -> None:
        """Start-up check by JDBC: create missing tables, then require the columns."""
        jdbc_sink.create_tables(spark, self.conf)
        jdbc_sink.require_tables(spark, self.conf)

    def batch_time(self, spark, stream_id: str, batch_id: int, now: dt.datetime) -> dt.datetime:
        return jdbc_sink.batch_time(spark, self.conf, stream_id, batch_id, now)

    def write(self, df: DataFrame, name: str, batch_id: int, stream_id: str = DEFAULT_STREAM, batch_date: dt.date | None = None) -> None:
        if name in (FAILURES_TABLE, QUARANTINE_TABLE):
            out = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).withColumn("stream_id", F.lit(stream_id))
            jdbc_sink.replace_batch(out, self.conf, name, batch_id, stream_id)
        else:
            jdbc_sink.write_jdbc_idempotent(df, self.conf, name, batch_id, stream_id=stream_id, batch_date=batch_date)


@dataclass
class BatchReport:
    batch_id: int
    empty: bool
    written: list[str] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)


class BatchProcessor:
    """``foreachBatch`` callback over raw wire records (a ``value`` column).

    Parameters: ``sink`` (``ParquetSink``/``JdbcSink``), ``strict`` failure
    policy, ``clock`` giving the time of a batch when it is first seen (its
    ``metric_timestamp``; a replay gets the same), ``region_label`` of the
    dimension table, ``dedupe`` to drop repeated deliveries by the records'
    identity: inside a batch, and with ``delivered`` (ranges of the offsets stored
    before) in all later batches too, ``parallel`` to run the table writes as concurrent
    Spark jobs over the one persisted batch, ``stream_id`` under which the
    batches are stored (``start_pipeline`` sets the streaming query's id).
    ``reports`` holds a small entry per batch since the start.
    """

    def __init__(self, sink, strict: bool = True, clock: Callable[[], dt.datetime] | None = None,
                 region_label: str = "region", dedupe: bool = False, parallel: bool = True,
                 quarantine: bool = True, stream_id: str | None = None, delivered: DeliveredOffsets | None = None):
        self.sink = sink
        self.strict = strict
        self.clock = clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.region_label = region_label
        self.dedupe = dedupe or delivered is not None
        self.delivered = delivered
        self.parallel = parallel
        self.quarantine = quarantine
        self.stream_id = stream_id
        self._named = threading.Event()
        self._named.set()
        self.reports: list[BatchReport] = []

    def expect_name(self) -> None:
        """Let batches wait until :meth:`name` tells under which id to store them."""
        self._named.clear()

    def name(self, stream_id: str) -> None:
        self.stream_id = stream_id
        self._named.set()

    def events(self, decoded: DataFrame, batch_id: int) -> DataFrame:
        keep = [c for c in IDENTITY if c in decoded.columns]
        ev = to_click_events(events_of(decoded, [*keep, AMOUNT]))
        if self.dedupe and self.delivered is None and len(keep) == len(IDENTITY):
            ev = dedup_events(ev)
        return ev.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))

    def __call__(self, raw: DataFrame, batch_id: int) -> BatchReport:
        # Each record is JSON-decoded once; the decoded batch is persisted and
        # both the events and the quarantine are cut from it.
        if not self._named.wait(120):
            raise RuntimeError("no stream id for this batch")
        raw = self._undelivered(raw, int(batch_id))
        decoded = decode_records(raw, identity_of(raw)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            report = self._process(decoded, int(batch_id))
        finally:
            decoded.unpersist()
        self.reports.append(report)
        return report

    def _undelivered(self, raw: DataFrame, batch_id: int) -> DataFrame:
        """The records that no earlier batch stored."""
        if self.delivered is None or len(identity_of(raw)) < len(IDENTITY):
            return raw
        ranges = self.delivered.before(raw.sparkSession, self.stream_id or DEFAULT_STREAM, batch_id)
        return drop_delivered(raw, ranges)

    def _process(self, decoded: DataFrame, batch_id: int) -> BatchReport:
        # One pass fills the persisted batch and answers "is it empty"; the
        # events are then materialised once, before the table writes run side
        # by side over them.
        if decoded.count() == 0:
            log.info("empty batch %s", batch_id)
            return BatchReport(batch_id, empty=True)
        ev = self.events(decoded, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ev.count()
            spark = decoded.sparkSession
            stream = self.stream_id or DEFAULT_STREAM
            when = self.sink.batch_time(spark, stream, batch_id, self.clock())
            outputs = dict(build_marts(ev, metric_ts=ntz_lit(when), region_label=self.region_label))
            if self.quarantine:
                outputs[QUARANTINE_TABLE] = rejects_of(decoded, [c for c in IDENTITY if c in decoded.columns])
            report = BatchReport(batch_id, empty=False)
            steps = {n: (lambda n=n, df=df: self.sink.write(df, n, batch_id, stream, when.date())) for n, df in outputs.items()}
            if hasattr(self.sink, "keepers"):
                steps |= self.sink.keepers(ev, batch_id, stream, when.date(), self.region_label)
            self._run_all(spark, steps, report)
        finally:
            ev.unpersist()
        if self.delivered is not None and not report.failures and all(c in decoded.columns for c in IDENTITY):
            stored = islands(decoded).collect()  # a row per partition and gap, and per span
            self.delivered.add(spark, stream, batch_id, [tuple(r) for r in stored])
        if report.failures:
            self._record_failures(decoded, batch_id, report.failures, stream, when)
            if self.strict:
                raise RuntimeError(f"batch {batch_id}: sinks failed: {sorted(report.failures)}")
        return report

    @staticmethod
    def _run_one(name: str, step: Callable[[], object], batch_id: int) -> str | None:
        try:
            step()
            return None
        except Exception as e:  # collected; strict mode re-raises after all sinks ran
            log.error("batch %s: writing %s failed: %s", batch_id, name, e)
            return f"{type(e).__name__}: {e}"

    def _run_all(self, spark, steps: Mapping[str, Callable[[], object]], report: BatchReport) -> None:
        one = lambda n: self._run_one(n, steps[n], report.batch_id)
        if self.parallel and len(steps) > 1:
            # The pool's threads take over the query's job group, so stopping the
            # query cancels their jobs too.
            with ThreadPoolExecutor(max_workers=len(steps)) as pool:
                pending = {n: pool.submit(inheritable_thread_target(spark)(one), n) for n in steps}
                results = {n: f.result() for n, f in pending.items()}
        else:
            results = {n: one(n) for n in steps}
        for name, err in results.items():
            if err:
                report.failures[name] = err
            else:
                report.written.append(name)

    def _record_failures(self, raw: DataFrame, batch_id: int, failures: Mapping[str, str], stream: str, now: dt.datetime) -> None:
        rows = [(batch_id, name, err, now) for name, err in sorted(failures.items())]
        try:
            self.sink.write(raw.sparkSession.createDataFrame(rows, FAILURE_SCHEMA), FAILURES_TABLE, batch_id, stream, now.date())
        except Exception as e:  # the failure table itself is unavailable: keep the log line
            log.error("batch %s: could not record sink failures: %s", batch_id, e)
