"""Sinks and sources around the tables: JDBC on embedded in-process Derby (no
server, no port), table creation and checks, Kafka options, the publisher."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from clickmart.operators import marts
from clickmart.schema import REQUIRED_TABLES
from clickmart.sinks import jdbc, tables as tb
from clickmart.sinks.publish import publish_events
from clickmart.sources import decode, streams
from clickmart.sources import fixture as fx
from clickmart.streaming.batch import BatchProcessor, JdbcSink

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture()
def derby():
    return {"url": f"jdbc:derby:memory:cm{uuid.uuid4().hex[:8]};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _upper(df):
    return df.toDF(*[c.lower() for c in df.columns])


def test_jdbc_write_read_and_replay(spark, derby):
    ub = marts.user_behavior(fx.clicks(spark, SMOKE)).filter("batch_id < 3")
    for b in (0, 1, 2):
        jdbc.write_jdbc_idempotent(ub.filter(F.col("batch_id") == b), derby, "user_behavior", b)
    back = _upper(jdbc.read_table(spark, derby, "user_behavior"))
    assert back.count() == ub.count()
    jdbc.write_jdbc_idempotent(ub.filter("batch_id = 1"), derby, "user_behavior", 1)   # replay
    assert _upper(jdbc.read_table(spark, derby, "user_behavior")).count() == ub.count()
    cols = ["user_id", "sessions", "events", "purchases", "batch_id"]
    assert back.select(*cols).exceptAll(ub.select(*cols)).count() == 0


def test_batch_processor_on_jdbc(spark, derby):
    wire = fx.wire_records(spark, SMOKE).filter("batch_id = 0").select("value")
    sink = JdbcSink(derby)
    sink.prepare(spark)
    proc = BatchProcessor(sink, parallel=False)
    proc(wire, 0)
    proc(wire, 0)
    n = _upper(jdbc.read_table(spark, derby, "clickstream_events")).count()
    assert n == fx.clicks(spark, SMOKE).filter("batch_id = 0").count()
    quarantined = _upper(jdbc.read_table(spark, derby, "quarantine_events")).count()
    assert quarantined == wire.count() - n


def test_create_and_verify_tables(spark, scratch):
    root = os.path.join(scratch, "wh")
    report = {r.table_name: r.ok for r in tb.verify_tables(spark, root).collect()}
    assert report == {n: False for n in REQUIRED_TABLES}
    with pytest.raises(RuntimeError, match="clickstream_events"):
        tb.require_tables(spark, root)
    tb.create_tables(spark, root)
    assert all(r.ok for r in tb.verify_tables(spark, root).collect())
    tb.write_batch_idempotent(marts.realtime_metrics(fx.clicks(spark, SMOKE), fx.metric_ts()), root, "realtime_metrics")
    ok = {r.table_name: (r.ok, list(r.missing_columns)) for r in tb.verify_tables(spark, root).collect()}
    assert ok["realtime_metrics"] == (True, [])
    assert tb.read_table(spark, root, "realtime_metrics").count() == 30
    assert tb.read_table(spark, root, "page_metrics").count() == 0


def test_checkpoint_root_comes_from_session(spark):
    assert tb.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_kafka_source_options_and_missing_connector(spark):
    opts = streams.kafka_options("broker:9092", starting="latest", max_offsets_per_trigger=1000, min_partitions=64)
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "clickstream-events",
                    "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000",
                    "minPartitions": "64"}
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_events(spark, "localhost:1")


def test_peek_events_reads_first_records(spark, scratch):
    path = os.path.join(scratch, "wire")
    streams.write_wire_files(fx.wire_records(spark, SMOKE), path)
    assert streams.peek_events(spark, path, 5).count() == 5


def test_publish_then_parse_round_trip(spark):
    ev = fx.clicks(spark, SMOKE).filter(F.col("timestamp").isNotNull())
    back = decode.to_click_events(decode.parse_events(publish_events(ev)))
    cols = ["user_id", "page_url", "event_type", "timestamp", "session_id", "device", "region", "referrer"]
    assert back.select(*cols).exceptAll(ev.select(*cols)).count() == 0
    assert back.count() == ev.count()


def test_topic_sink_needs_the_connector(spark):
    from clickmart.sinks.publish import write_topic

    records = publish_events(fx.clicks(spark, SMOKE).limit(3))
    with pytest.raises(Exception, match="(?i)kafka"):
        write_topic(records, "localhost:1", "clickstream-events")


def test_compaction_keeps_rows_and_merges_files(spark, scratch):
    import glob

    root = os.path.join(scratch, "wh")
    ev = fx.clicks(spark, SMOKE).filter("batch_id < 4")
    for b in range(4):  # many small files per batch, as frequent micro-batches leave them
        tb.write_batch_idempotent(marts.raw_events(ev.filter(F.col("batch_id") == b), with_created_at=False)
                                  .repartition(6), root, "clickstream_events")
    files = lambda: glob.glob(os.path.join(root, "clickstream_events", "*", "*", "batch_id=*", "*.parquet"))
    from collections import Counter

    snapshot = lambda: Counter(tuple(r) for r in tb.read_table(spark, root, "clickstream_events").drop("created_at").collect())
    before = snapshot()
    assert len(files()) > 4
    assert tb.compact(spark, root, "clickstream_events", 0, 3) == ev.count()
    parts = {os.path.dirname(f) for f in files()}
    assert len(files()) == len(parts)  # one file for each date and batch
    assert snapshot() == before
    tb.compact(spark, root, "clickstream_events", 0, 3, files_per_batch=4)
    per = Counter(os.path.dirname(f) for f in files())
    assert max(per.values()) > 1 and max(per.values()) <= 4
    assert snapshot() == before
    assert not glob.glob(os.path.join(tb.checkpoint_root(spark), "compact-*"))


def test_jdbc_tables_are_created_checked_and_refused(spark, derby):
    assert jdbc.columns_of(spark, derby, "realtime_metrics") is None
    with pytest.raises(RuntimeError, match="clickstream_events"):
        jdbc.require_tables(spark, derby)
    assert set(jdbc.create_tables(spark, derby)) == set(REQUIRED_TABLES)
    assert jdbc.create_tables(spark, derby) == []
    jdbc.require_tables(spark, derby)
    jdbc._execute(spark, derby, 'CREATE TABLE plain ("user_id" VARCHAR(255), "sessions" BIGINT)')
    ub = marts.user_behavior(fx.clicks(spark, SMOKE)).filter("batch_id = 0")
    with pytest.raises(RuntimeError, match="batch_id"):
        jdbc.write_jdbc_idempotent(ub, derby, "plain", 0, table_schema="user_behavior")


def test_jdbc_parallel_read(spark, derby):
    ub = marts.user_behavior(fx.clicks(spark, SMOKE)).filter("batch_id < 3")
    for b in (0, 1, 2):
        jdbc.write_jdbc_idempotent(ub.filter(F.col("batch_id") == b), derby, "user_behavior", b)
    part = jdbc.read_table(spark, derby, "user_behavior", partition_column="batch_id", partitions=3)
    assert part.rdd.getNumPartitions() > 1 and part.count() == ub.count()


def test_jdbc_options_reach_the_source():
    assert jdbc._options({"url": "u", "fetchsize": 10, "ssl": "true", "password": None}) == {"url": "u", "fetchsize": "10", "ssl": "true"}


def test_skewed_parallel_read(spark, derby):
    """90 % of the rows in a thousandth of the value range, and NULLs: tasks of like size, all rows."""
    rows = [(k, 1_000_000 + k % 997 if k % 10 else 1_000_000_000 * (k % 7) + k, None if k % 50 == 0 else f"2024-01-{1 + k % 28:02d} 10:00:0{k % 6}") for k in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, v bigint, t string").withColumn("t", F.col("t").cast("timestamp")).withColumn("v", F.when(F.col("id") % 25 != 7, F.col("v")))
    jdbc.write_jdbc(df, derby, "skewed")
    for column in ("v", "id", "t"):
        read = jdbc.read_table(spark, derby, "skewed", column, 8)
        sizes = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
        nulls = df.filter(F.col(column).isNull()).count()
        assert read.count() == 4000 and read.select("id").distinct().count() == 4000
        assert len(sizes) >= 8 and max(sizes) <= max(700, nulls), (column, sizes)
    empty = df.limit(0)
    jdbc.write_jdbc(empty, derby, "nothing")
    assert jdbc.read_table(spark, derby, "nothing", "v", 8).count() == 0
    jdbc.write_jdbc(df.limit(3), derby, "few")
    assert jdbc.read_table(spark, derby, "few", "id", 8).count() == 3
