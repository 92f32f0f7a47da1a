"""Events -> (key, value) records for a message topic.

The value is the JSON text of the event under its wire names and the key is
the session id, so one session stays in one topic partition.  Works on a
batch or a streaming frame; write it with ``format("kafka")`` where the
connector is on the classpath, or to files otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def event_json(ev: DataFrame) -> DataFrame:
    """Stored click events -> ``key`` (session id) and ``value`` (JSON text with
    every wire field; a missing value is written as ``null``, as a JSON
    serializer of the event record would)."""
    body = F.to_json(F.struct(
        F.col("user_id").alias("userId"), F.col("session_id").alias("sessionId"),
        F.col("event_type").alias("eventType"), F.date_format("timestamp", WIRE_TIME_FORMAT).alias("eventTime"),
        F.col("page_url").alias("page"), "referrer", "device", "region",
    ), {"ignoreNullFields": "false"})
    return ev.select(F.col("session_id").alias("key"), body.alias("value"))


def publish_events(ev: DataFrame) -> DataFrame:
    """Records for a topic sink: ``key`` (session id bytes), ``value`` (UTF-8 JSON)."""
    j = event_json(ev)
    return j.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def write_topic(records: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Send ``key``/``value`` records to a topic: a batch write, or -- for a
    streaming frame -- a started query (``checkpoint`` required there)."""
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    if records.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming topic sink needs a checkpoint location")
        return records.writeStream.format("kafka").options(**opts).option("checkpointLocation", checkpoint).start()
    records.write.format("kafka").options(**opts).save()
    return None
