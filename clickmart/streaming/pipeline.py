"""The streaming job -- source -> per-batch tables -- plus the windowed
event-time job (K5-K7) and a graceful stop (K9).

Each query has a fixed name and a checkpoint under the shared
``spark.checkpoint.dir`` (``<root>/streams/<name>``), so a restart resumes
from the committed offsets instead of starting over in a fresh random
directory.  Stored batches carry the query's id, which lives in its
checkpoint: batch numbers start anew with a new checkpoint, and then do not
replace what an earlier one stored.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmart.operators.windows import tumbling_event_counts
from clickmart.sinks.tables import checkpoint_root
from clickmart.sources.decode import parse_events, to_click_events
from clickmart.streaming.batch import BatchProcessor

DEFAULT_TRIGGER = "30 seconds"


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/streams/{name}"


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or DEFAULT_TRIGGER)


def start_pipeline(
    spark: SparkSession,
    raw: DataFrame,
    processor: BatchProcessor,
    name: str = "clickstream",
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    dedup_within: str | None = None,
    ingest_time: str = "timestamp",
) -> StreamingQuery:
    """Run ``processor`` on every micro-batch of the raw wire stream ``raw``
    (A1 or A5) in append mode.  ``observe`` publishes per-batch input
    figures in the query progress (N1).  The sink's tables are checked
    before the query starts (A7).

    ``dedup_within`` (e.g. ``"10 minutes"``) drops repeated deliveries of
    the same record across micro-batches -- a producer retry resends the
    same bytes, possibly into a later batch -- with Spark's stateful
    ``dropDuplicatesWithinWatermark`` on the record value, watermarked on
    the source's ingest time column (Kafka's ``timestamp``); the state is
    bounded by the watermark.  Without it every delivered record is kept."""
    prepare = getattr(processor.sink, "prepare", None)
    if prepare is not None:
        prepare(spark)
    if dedup_within:
        if ingest_time not in raw.columns:
            raise ValueError(f"dedup_within needs an ingest time column {ingest_time!r} on the source")
        raw = raw.withWatermark(ingest_time, dedup_within).dropDuplicatesWithinWatermark(["value"])
    observed = raw.observe(
        "ingest",
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("value").isNull()).alias("null_values"),
    )
    writer = (observed.writeStream.queryName(name).outputMode("append").foreachBatch(processor)
              .option("checkpointLocation", checkpoint or checkpoint_for(spark, name)))
    given = processor.stream_id
    if given is None:
        processor.expect_name()
    query = _trigger(writer, trigger, available_now).start()
    if given is None:
        processor.name(str(query.id))
    return query


def start_window_counts(
    spark: SparkSession,
    raw: DataFrame,
    path: str,
    width: str = "5 minutes",
    watermark: str = "10 minutes",
    name: str = "event_window_counts",
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """K5/K7: event counts per type and tumbling window, appended to Parquet
    at ``path`` once the watermark closes a window.  Events older than the
    watermark are left out of the counts (they still reach the raw table
    through the batch pipeline); their number is in the progress as
    ``numRowsDroppedByWatermark`` (see :func:`clickmart.streaming.observe.late_rows`)."""
    ev = to_click_events(parse_events(raw), zoned=True).filter(F.col("timestamp").isNotNull())
    counts = tumbling_event_counts(ev, width, watermark=watermark)
    writer = (counts.writeStream.queryName(name).outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint or checkpoint_for(spark, name)))
    return _trigger(writer, trigger, available_now).start()


def stop_gracefully(query: StreamingQuery, timeout_seconds: float = 120.0, poll_seconds: float = 0.2, force: bool = False) -> None:
    """K9: wait until the running micro-batch (if any) has finished, then stop.

    If it takes longer than ``timeout_seconds``, raise TimeoutError and leave the
    query running, or with ``force`` stop it in the middle of the batch, which a
    restart replays."""
    deadline = time.monotonic() + timeout_seconds
    while query.isActive and query.status.get("isTriggerActive"):
        if time.monotonic() >= deadline:
            if force:
                break
            raise TimeoutError(f"query {query.name} is still in a batch after {timeout_seconds} s")
        time.sleep(poll_seconds)
    query.stop()
