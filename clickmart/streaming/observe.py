"""Observability as table rows (N1, N4, N5 helpers, K7 counter).

``ProgressRecorder`` is a ``StreamingQueryListener``: one small row per
finished micro-batch for the ``batch_progress`` table and one per source for
``consumer_lag``.  With a ``root`` it appends them there as they gather and at
the end of a query; without one it holds them all.  The other helpers read the
progress JSON Spark already produces.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from clickmart.functions import idiv, micros_between
from clickmart.sinks.files import path_exists

PROGRESS_SCHEMA = T.StructType([
    T.StructField("query_name", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("batch_time", T.StringType(), True),
    T.StructField("input_rows", T.LongType(), True),
    T.StructField("input_rows_per_second", T.DoubleType(), True),
    T.StructField("processed_rows_per_second", T.DoubleType(), True),
    T.StructField("trigger_ms", T.LongType(), True),
    T.StructField("late_rows", T.LongType(), True),
    T.StructField("observed", T.MapType(T.StringType(), T.StringType()), True),
])


def _as_dict(progress) -> dict:
    """A progress report as plain JSON data (PySpark's progress object is a
    dict whose nested values are Rows; its ``json`` text is not)."""
    if isinstance(getattr(progress, "json", None), str):
        return json.loads(progress.json)
    if isinstance(progress, Mapping):
        return dict(progress)
    return json.loads(str(progress))


def late_rows(progress) -> int:
    """K7: rows dropped by the watermark in one progress report."""
    p = _as_dict(progress)
    return int(sum(int(s.get("numRowsDroppedByWatermark", 0) or 0) for s in p.get("stateOperators", [])))


def consumer_lag(progress) -> list[dict]:
    """Per source, how far the query is behind the latest offsets (Kafka
    sources report ``avg/min/maxOffsetsBehindLatest``; others report none)."""
    out = []
    for s in _as_dict(progress).get("sources", []):
        metrics = s.get("metrics") or {}
        out.append({
            "source": s.get("description"),
            "avg_offsets_behind": float(metrics["avgOffsetsBehindLatest"]) if "avgOffsetsBehindLatest" in metrics else None,
            "max_offsets_behind": int(float(metrics["maxOffsetsBehindLatest"])) if "maxOffsetsBehindLatest" in metrics else None,
            "min_offsets_behind": int(float(metrics["minOffsetsBehindLatest"])) if "minOffsetsBehindLatest" in metrics else None,
        })
    return out


def committed_offsets(progress) -> list[tuple[str, int, int]]:
    """(topic, partition, offset) up to which each source partition is read after
    the batch, from one progress report; sources without offsets give none."""
    out = []
    for s in _as_dict(progress).get("sources", []):
        end = s.get("endOffset")
        if isinstance(end, str):
            try:
                end = json.loads(end)
            except ValueError:
                continue
        for topic, partitions in (end if isinstance(end, Mapping) else {}).items():
            if isinstance(partitions, Mapping):
                out += [(topic, int(p), int(o)) for p, o in partitions.items()]
    return sorted(out)


def lag_in_time(records: DataFrame, committed: DataFrame, time: str = "timestamp") -> DataFrame:
    """N4 in seconds: per topic and partition, how far the time of the newest record
    lies ahead of the time of the last record read.

    ``records`` has topic, partition, offset and a time (the source's records, or
    the stored events); ``committed`` has topic, partition and the offset read up
    to (exclusive), one row per partition.  The record as of the committed offset
    is found by an aggregate, the greatest offset below it, so a partition with
    many records is reduced where they lie and no window sorts them.  A partition
    of which nothing is read counts from its oldest record; one without a
    committed offset as such too.  Records without a time do not count."""
    read_to = committed.groupBy("topic", "partition").agg(F.max("offset").alias("committed_offset"))
    timed = records.filter(F.col(time).isNotNull()).select("topic", "partition", "offset", F.col(time).alias("_t"))
    timed = timed.join(read_to, ["topic", "partition"], "left").withColumn("committed_offset", F.coalesce("committed_offset", F.lit(0).cast("bigint")))
    done = F.col("offset") < F.col("committed_offset")
    figures = timed.groupBy("topic", "partition").agg(
        F.max("committed_offset").alias("committed_offset"), F.max("offset").alias("newest_offset"), F.max_by("_t", "offset").alias("newest_time"),
        F.max_by("_t", F.when(done, F.col("offset"))).alias("_read"), F.min_by("_t", "offset").alias("_oldest"))
    figures = figures.withColumn("read_time", F.coalesce("_read", "_oldest"))
    behind = idiv(micros_between("read_time", "newest_time", records.schema[time].dataType), F.lit(1_000_000))
    return figures.select(
        "topic", "partition", "committed_offset", "newest_offset", F.greatest(F.col("newest_offset") + 1 - F.col("committed_offset"), F.lit(0)).alias("offsets_behind"),
        "read_time", "newest_time", F.greatest(behind, F.lit(0).cast("bigint")).alias("seconds_behind"))


def progress_row(progress) -> tuple:
    p = _as_dict(progress)
    observed = {}
    for name, row in (p.get("observedMetrics") or {}).items():
        for k, v in (row or {}).items():
            observed[f"{name}.{k}"] = str(v)
    return (
        p.get("name"),
        int(p.get("batchId", -1)),
        p.get("timestamp"),
        int(p.get("numInputRows", 0) or 0),
        float(p.get("inputRowsPerSecond", 0.0) or 0.0),
        float(p.get("processedRowsPerSecond", 0.0) or 0.0),
        int((p.get("durationMs") or {}).get("triggerExecution", 0) or 0),
        late_rows(p),
        observed,
    )


LAG_SCHEMA = T.StructType([
    T.StructField("query_name", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("batch_time", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("avg_offsets_behind", T.DoubleType(), True),
    T.StructField("max_offsets_behind", T.LongType(), True),
    T.StructField("min_offsets_behind", T.LongType(), True),
])


def lag_rows(progress) -> list[tuple]:
    """N4 as rows of the ``consumer_lag`` table."""
    p = _as_dict(progress)
    head = (p.get("name"), int(p.get("batchId", -1)), p.get("timestamp"))
    return [(*head, r["source"], r["avg_offsets_behind"], r["max_offsets_behind"], r["min_offsets_behind"]) for r in consumer_lag(p)]


class ProgressRecorder(StreamingQueryListener):
    """A row per micro-batch of every query in the session.

    With ``spark`` and ``root`` the rows go to the tables under ``root`` each time
    ``flush_every`` of them have gathered and when a query ends; ``rows`` then
    holds those not yet written.
    """

    def __init__(self, spark: SparkSession | None = None, root: str | None = None, flush_every: int = 100):
        self._rows: list[tuple] = []
        self._lag: list[tuple] = []
        self._lock = threading.Lock()
        self._writing = threading.Lock()
        self._spark, self._root, self._flush_every = spark, root, flush_every

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        with self._lock:
            self._rows.append(progress_row(event.progress))
            self._lag += lag_rows(event.progress)
            full = self._root is not None and len(self._rows) >= self._flush_every
        if full:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if self._root is not None:
            self.flush()

    def rows(self) -> list[tuple]:
        with self._lock:
            return list(self._rows)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), PROGRESS_SCHEMA)

    def flush(self) -> None:
        """Append the gathered rows to the tables; they stay here if that fails.
        When it returns, all rows gathered before are written, by whomever."""
        with self._writing:
            with self._lock:
                rows, lag = list(self._rows), list(self._lag)
            if rows:
                write_progress(self._spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1), self._root)
                with self._lock:
                    del self._rows[:len(rows)]
            if lag:
                write_progress(self._spark.createDataFrame(lag, LAG_SCHEMA).coalesce(1), self._root, LAG_TABLE)
                with self._lock:
                    del self._lag[:len(lag)]


PROGRESS_TABLE = "batch_progress"
LAG_TABLE = "consumer_lag"


def write_progress(frame: DataFrame, root: str, table: str = PROGRESS_TABLE) -> None:
    """Append progress (or lag) rows under ``root``, partitioned by the day of
    the batch and the query -- folders by the day, not by the batch."""
    (frame.withColumn("progress_date", F.to_date(F.substring("batch_time", 1, 10)))
     .withColumn("query", F.coalesce(F.col("query_name"), F.lit("unnamed")))
     .write.mode("append").partitionBy("progress_date", "query").parquet(f"{root.rstrip('/')}/{table}"))


def _stored(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Stored rows with the declared schema; none where the table is not there yet."""
    schema = T.StructType([*schema.fields, T.StructField("progress_date", T.DateType()), T.StructField("query", T.StringType())])
    path = f"{root.rstrip('/')}/{table}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """The stored progress rows, each once even if it was written twice."""
    return _stored(spark, root, PROGRESS_TABLE, PROGRESS_SCHEMA).dropDuplicates(["query", "batch_id", "batch_time"])


def read_lag(spark: SparkSession, root: str) -> DataFrame:
    """The stored lag rows, each once even if it was written twice."""
    return _stored(spark, root, LAG_TABLE, LAG_SCHEMA).dropDuplicates(["query", "batch_id", "batch_time", "source"])


def pipeline_status(progress: DataFrame) -> DataFrame:
    """Pipeline status panel over ``batch_progress`` rows: per query the
    newest batch and its time, input rows in total, mean processing rate,
    late rows, and the slowest trigger.  One aggregation; ``max_by`` picks
    the newest batch's time without a sort."""
    return progress.groupBy("query_name").agg(
        F.max("batch_id").alias("last_batch_id"),
        F.max_by("batch_time", "batch_id").alias("last_batch_time"),
        F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.avg("processed_rows_per_second").alias("mean_rows_per_second"),
        F.sum("late_rows").alias("late_rows"),
        F.max("trigger_ms").alias("max_trigger_ms"),
    )


HISTOGRAM_MS = (100, 500, 1000, 5000, 10_000, 30_000, 60_000)


def processing_histogram(progress: DataFrame, bounds_ms: Iterable[int] = HISTOGRAM_MS) -> DataFrame:
    """Cumulative histogram of batch processing times over ``batch_progress`` rows:
    per query and upper bound ``le_ms`` (NULL: none) the number of batches that
    took no longer.  One aggregation, the bounds as columns of it."""
    bounds = sorted(set(bounds_ms))
    counts = progress.groupBy("query_name").agg(*[F.count_if(F.col("trigger_ms") <= b).alias(f"_{b}") for b in bounds], F.count(F.lit(1)).alias("_all"))
    rows = [F.struct(F.lit(b).cast("bigint").alias("le_ms"), F.col(f"_{b}").alias("batches")) for b in bounds]
    rows.append(F.struct(F.lit(None).cast("bigint").alias("le_ms"), F.col("_all").alias("batches")))
    return counts.select("query_name", F.inline(F.array(*rows)))


def progress_frame(spark: SparkSession, reports: Iterable) -> DataFrame:
    """Progress reports (e.g. ``query.recentProgress``) as ``batch_progress`` rows."""
    return spark.createDataFrame([progress_row(p) for p in reports], PROGRESS_SCHEMA)
