"""Stored tables as Parquet directories partitioned by date, stream and batch.

A table is ``<root>/<name>``, where ``root`` is a shared location (a
distributed file system or object store on a cluster).  The outermost
partition is a date -- the event's for raw events, the batch's for the marts --
so that a time range opens only the folders of its days; below it come the
stream (a checkpoint's identity: batch numbers restart with each checkpoint)
and the batch.  A batch is written in full beside the table, out of readers'
sight, and its folders are then moved to their places, those that the same
batch left before giving way.  So a replayed micro-batch -- after a crash between
the sink write and the offset commit -- leaves the tables as they were, also
where its new output is empty, and readers find the old rows until the new ones
are complete; between the two lies one deletion and one move per folder, not a
job.
"""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schema import PARTITIONS, REQUIRED_TABLES, TABLE_EVENTS, TABLE_METRICS, TABLE_SCHEMAS, WRITE_TIME_COLUMN
from clickmart.sinks import files
from clickmart.sinks.files import path_exists

# Columns each table is sorted by inside its files.
SORT_WITHIN_FILES = {"clickstream_events": ("timestamp",), "realtime_metrics": ("metric_timestamp",)}
DEFAULT_STREAM = "default"
# Tasks that share one partition's rows when many batches are written at once.
SPREAD = 4
# Tasks of one compaction at most.
MOST_TASKS = 10_000


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints and tables")
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder; a temporary one where none is named and all of Spark is
    this one machine, as in tests."""
    try:
        return checkpoint_root(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
    root = tempfile.mkdtemp(prefix="clickmart-scratch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def conform(df: DataFrame, name: str, stream_id: str = DEFAULT_STREAM, batch_date: dt.date | None = None) -> DataFrame:
    """Select and cast ``df`` to the stored schema of table ``name``; the
    write-time column is filled with the current time, missing optional
    columns with NULL.

    The date partition comes from the row: the event's date, or the batch's
    (a ``batch_date`` column, the date of ``metric_timestamp``, or the given
    ``batch_date``)."""
    schema = TABLE_SCHEMAS[name]
    if "stream_id" not in df.columns:
        df = df.withColumn("stream_id", F.lit(stream_id))
    if name == TABLE_EVENTS:
        df = df.withColumn("event_date", F.to_date("timestamp"))
    elif "batch_date" not in df.columns:
        own = F.to_date("metric_timestamp") if name == TABLE_METRICS else F.lit(None)
        df = df.withColumn("batch_date", own if batch_date is None else F.lit(batch_date))
    cols = []
    for f in schema.fields:
        if f.name == WRITE_TIME_COLUMN[name]:
            cols.append(F.current_timestamp().cast(f.dataType).alias(f.name))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def create_tables(spark: SparkSession, root: str, names: Iterable[str] = REQUIRED_TABLES, drop: bool = False) -> None:
    """Create the empty tables (``drop`` replaces existing ones)."""
    for name in names:
        empty = spark.createDataFrame([], TABLE_SCHEMAS[name])
        mode = "overwrite" if drop else "ignore"
        empty.write.mode(mode).partitionBy(*PARTITIONS[name]).parquet(table_path(root, name))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table with its declared schema (no footer inference)."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(table_path(root, name))


def read_tables(spark: SparkSession, root: str, names: Iterable[str] = REQUIRED_TABLES) -> dict[str, DataFrame]:
    """The ``T`` mapping the dashboard queries take, over stored tables."""
    return {n: read_table(spark, root, n) for n in names}


def stored_dates(df: DataFrame, column: str) -> list[dt.date] | None:
    """The dates of a stored table's folders, newest first, from the file listing
    alone; None if ``df`` is not such a table as it was read."""
    found = set()
    for path in df.inputFiles():
        m = re.search(rf"/{column}=([^/]+)/", path)
        if not m:
            return None
        if not m[1].startswith("__"):
            found.add(dt.date.fromisoformat(m[1]))
    return sorted(found, reverse=True) or None


def _places(root: str, name: str, stream_id: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/_places/{name}/stream_id={stream_id}/batch_id={int(batch_id)}"


def replace_batch(out: DataFrame, root: str, name: str, parts: Sequence[str], stream_id: str, batch_id: int) -> list[str]:
    """Put the rows ``out`` of one batch in the place of all that the same batch of
    the same stream has in a table partitioned by ``parts``; returns the folders.

    Which folders a batch has is kept in a file beside the table, written before
    any of them is touched, so a later attempt finds them all without listing the
    table."""
    spark, table = out.sparkSession, table_path(root, name)
    beside = f"{table}/_staging/{stream_id}-{int(batch_id)}-{uuid.uuid4().hex}"
    out.write.partitionBy(*parts).parquet(beside)
    new = sorted(path[path.index("/_staging/") + 10:].split("/", 1)[1] for path in files.glob(spark, beside + "/*" * len(parts)))
    places = _places(root, name, stream_id, batch_id)
    old = files.read_text(spark, places).split("\n") if files.path_exists(spark, places) else []
    old = [p for p in old if p]
    if new or old:
        files.write_text(spark, places, "\n".join(sorted({*old, *new})))
    for place in old:
        if place not in new:
            files.delete(spark, f"{table}/{place}")
    for place in new:
        if place in old:
            files.delete(spark, f"{table}/{place}")
        files.rename(spark, f"{beside}/{place}", f"{table}/{place}")
    files.delete(spark, beside)
    return new


def batch_time(spark: SparkSession, root: str, stream_id: str, batch_id: int, now: dt.datetime) -> dt.datetime:
    """The time of a batch: ``now`` when it is first seen, the same on a replay."""
    path = f"{root.rstrip('/')}/_batches/stream_id={stream_id}/batch_id={int(batch_id)}"
    return dt.datetime.fromisoformat(files.write_once(spark, path, now.isoformat()))


def write_batch_idempotent(df: DataFrame, root: str, name: str, batch_id: int | None = None, stream_id: str = DEFAULT_STREAM,
                           batch_date: dt.date | None = None) -> None:
    """Write the rows of one batch, replacing all that the same batch of the
    same stream has stored before, or (without ``batch_id``) of many batches,
    replacing the partitions they fall in.

    For many batches the rows are first brought together by partition, spread
    over a few tasks each, so that not every task writes into every batch."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", stream_id):
        raise ValueError(f"stream id {stream_id!r} is not fit for a folder name")
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
    out = conform(df, name, stream_id, batch_date)
    parts = PARTITIONS[name]
    if batch_id is None:
        out = out.repartition(*parts, F.pmod(F.xxhash64(*[c for c in out.columns if c not in parts]), F.lit(SPREAD)))
    if name in SORT_WITHIN_FILES:
        # Row groups then cover narrow time spans, so time-range filters skip
        # most of them from Parquet min/max statistics (the stand-in for the
        # timestamp index of the original tables).  A per-task sort, no shuffle.
        out = out.sortWithinPartitions(*parts, *SORT_WITHIN_FILES[name])
    if batch_id is None:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(table_path(root, name)))
    else:
        replace_batch(out, root, name, parts, stream_id, batch_id)


def compact(spark: SparkSession, root: str, name: str, first_batch: int, last_batch: int, files_per_batch: int = 1) -> int:
    """Rewrite the partitions ``first_batch..last_batch`` of table ``name`` into at
    most ``files_per_batch`` files each (every micro-batch leaves small files; a
    year of 30-second batches is millions of them).

    The rows are first copied into the shared checkpoint folder, so the overwrite
    never reads the files it replaces and a retried task finds its input intact;
    then exactly those partitions are replaced (dynamic overwrite), in parallel
    by partition and by a salt below ``files_per_batch``, and the copy goes.
    Returns the rows rewritten.
    """
    parts = PARTITIONS[name]
    part = read_table(spark, root, name).filter(F.col("batch_id").between(int(first_batch), int(last_batch)))
    copy_path = f"{checkpoint_root(spark)}/compact-{uuid.uuid4().hex}"
    part.write.parquet(copy_path)
    copy = spark.read.schema(part.schema).parquet(copy_path)
    n = copy.count()
    if n:
        salt = F.pmod(F.xxhash64(*[c for c in part.columns if c not in parts]), F.lit(max(1, int(files_per_batch))))
        tasks = copy.select(*parts).distinct().count() * max(1, int(files_per_batch))
        out = copy.repartition(min(tasks, MOST_TASKS), *parts, salt)
        if name in SORT_WITHIN_FILES:
            out = out.sortWithinPartitions(*parts, *SORT_WITHIN_FILES[name])
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(table_path(root, name)))
    files.delete(spark, copy_path)
    return n


def verify_tables(spark: SparkSession, root: str, required: Iterable[str] = REQUIRED_TABLES) -> DataFrame:
    """One row per required table: present and complete or not, and the
    declared columns it lacks.  Only metadata is read (no data scan): the
    table folder must exist, and when it holds data files their schema must
    carry every declared column (an empty, just created table passes)."""
    rows = []
    for name in required:
        expected = [f.name for f in TABLE_SCHEMAS[name].fields]
        path = table_path(root, name)
        if not path_exists(spark, path):
            rows.append((name, False, expected))
            continue
        try:
            present = spark.read.parquet(path).columns
        except Exception as e:  # no data file yet: the schema is the declared one
            if "UNABLE_TO_INFER_SCHEMA" not in str(e) and "Unable to infer schema" not in str(e):
                rows.append((name, False, expected))
                continue
            present = expected
        missing = [c for c in expected if c not in present]
        rows.append((name, not missing, missing))
    schema = T.StructType([
        T.StructField("table_name", T.StringType(), False),
        T.StructField("ok", T.BooleanType(), False),
        T.StructField("missing_columns", T.ArrayType(T.StringType()), False),
    ])
    return spark.createDataFrame(rows, schema)


def require_tables(spark: SparkSession, root: str, required: Iterable[str] = REQUIRED_TABLES) -> None:
    """Fail with the name of the first missing or incomplete table."""
    for r in verify_tables(spark, root, required).collect():
        if not r.ok:
            raise RuntimeError(f"required table {r.table_name} is missing or lacks columns {list(r.missing_columns)}")
