"""Session settings for running the library on a large cluster.

Nothing in the library sets session configuration by itself; a job applies
these when it builds its session::

    spark = clickmart.config.cluster_builder(SparkSession.builder, "clicks").getOrCreate()

Reasoning for ~100 TB of events on ~1000 executors:

* Shuffle sizing is left to AQE: a high initial partition count (so no
  reducer task has to hold a huge slice before AQE sees the map outputs),
  then coalescing to ~256 MB per partition.  With map-side partial
  aggregation most shuffles here carry far less than the input.
* Skew: AQE splits skewed sort-merge-join partitions (a session holding a
  third of all rows in M6's join); the operators themselves never group raw
  rows by a bare user or session (see ``operators.sessions``).
* Scans: 512 MB splits keep the task count in the hundreds of thousands,
  not millions; Parquet filter pushdown and vectorised reads are defaults.
* Streams: RocksDB keeps dedup, session and window state off the JVM heap
  and checkpoints it incrementally; UTC is the session zone because
  watermarks need zoned timestamps.
* The checkpoint folder must be shared storage (``spark.checkpoint.dir``);
  it is never set here -- the cluster names it.
"""

from __future__ import annotations

from collections.abc import Mapping

CLUSTER_CONF: Mapping[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    # Coalesce to the advisory size rather than keeping default parallelism
    # (Spark's advice for busy clusters; measured no gain on tiny local data).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "4096",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


# A micro-batch is small and has to be done before the next: few, warm tasks and
# few state stores (their number is fixed by the first batch of a checkpoint).
STREAM_CONF: Mapping[str, str] = {
    **CLUSTER_CONF,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "256",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "256",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def stream_builder(builder, app_name: str = "clickmart", extra: Mapping[str, str] | None = None):
    """Apply :data:`STREAM_CONF` (plus ``extra``) to a ``SparkSession.builder``."""
    return cluster_builder(builder, app_name, {**STREAM_CONF, **(extra or {})})


def cluster_builder(builder, app_name: str = "clickmart", extra: Mapping[str, str] | None = None):
    """Apply :data:`CLUSTER_CONF` (plus ``extra``) to a ``SparkSession.builder``."""
    b = builder.appName(app_name)
    for k, v in {**CLUSTER_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    return b
