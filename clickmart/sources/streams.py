"""Event sources: Kafka (A1, A2) and replayable JSON-lines files (A5).

Both give a frame with a ``value`` column that :mod:`clickmart.sources.decode`
turns into events, so the same pipeline runs on either.  The Kafka connector
is not bundled with Spark; where its jar is missing ``load()`` fails with
Spark's "data source not found" error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "clickstream-events"


def kafka_options(servers: str, topic: str = TOPIC, starting: str = "latest", fail_on_data_loss: bool = False,
                  max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Reader options of the event topic.  ``maxOffsetsPerTrigger`` bounds a
    micro-batch after downtime, so catching up does not make one huge batch;
    ``minPartitions`` lets Spark split the offset range of a hot topic
    partition (one holding a large share of the events) over several tasks
    instead of reading it in one."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def kafka_events(spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest",
                 fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """A1: the event topic as a stream (key, value, topic, partition, offset, timestamp, ...)."""
    opts = kafka_options(servers, topic, starting, fail_on_data_loss, max_offsets_per_trigger, min_partitions)
    return spark.readStream.format("kafka").options(**opts).load()


def peek_events(spark: SparkSession, source: str, n: int = 5, servers: str | None = None) -> DataFrame:
    """A2: a bounded look at the first ``n`` records from the earliest offset
    (a topic when ``servers`` is given, else a JSON-lines path)."""
    if servers:
        opts = kafka_options(servers, source, starting="earliest")
        opts["endingOffsets"] = "latest"
        return spark.read.format("kafka").options(**opts).load().limit(int(n))
    return spark.read.text(source).limit(int(n))


def file_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A5: a directory of JSON-lines files as a replayable stream with the
    same ``value`` contract as the topic; new files are picked up in order
    of modification time, and the checkpoint remembers which were read."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def write_wire_files(records: DataFrame, path: str, by: str | None = None) -> None:
    """Write wire records (``value`` column) as JSON-lines text files, one
    directory per value of ``by`` when given (e.g. a batch id)."""
    out = records.select(F.col("value").cast("string").alias("value"), *([by] if by else []))
    w = out.write.mode("append")
    if by:
        w = w.partitionBy(by)
    w.text(path)
