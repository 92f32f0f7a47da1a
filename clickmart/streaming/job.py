"""The streaming job as a command (B7): source -> five tables.

    spark-submit --py-files clickmart.zip clickmart/streaming/job.py --kafka broker:9092 --tables s3://bucket/clicks
    python -m clickmart.streaming.job --files /data/incoming --tables /data/clicks --available-now

The checkpoint is ``<spark.checkpoint.dir>/streams/<name>`` unless given.
With ``--tables`` the job also keeps the current tables and the window counts,
corrected for late events.  Progress and lag rows go to ``batch_progress`` and ``consumer_lag`` beside the
tables.  SIGTERM and SIGINT let the running batch finish before the job ends.
"""

from __future__ import annotations

import argparse
import signal
import threading

from pyspark.sql import SparkSession

from clickmart import config
from clickmart.sources import streams
from clickmart.streaming.batch import BatchProcessor, JdbcSink, ParquetSink
from clickmart.streaming.delivered import DeliveredOffsets
from clickmart.streaming.observe import ProgressRecorder
from clickmart.streaming.pipeline import DEFAULT_TRIGGER, start_pipeline, stop_gracefully


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="clickmart.streaming.job", description=__doc__)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", metavar="SERVERS", help="Kafka bootstrap servers")
    src.add_argument("--files", metavar="PATH", help="directory of JSON-lines files")
    p.add_argument("--topic", default=streams.TOPIC)
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None)
    p.add_argument("--min-partitions", type=int, default=None, help="split hot topic partitions over more tasks")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    dst = p.add_mutually_exclusive_group(required=True)
    dst.add_argument("--tables", metavar="ROOT", help="folder of the Parquet tables")
    dst.add_argument("--jdbc-url", help="JDBC URL of the database holding the tables")
    p.add_argument("--jdbc-driver", default=None)
    p.add_argument("--jdbc-user", default=None)
    p.add_argument("--jdbc-password", default=None)
    p.add_argument("--name", default="clickstream")
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--trigger", default=DEFAULT_TRIGGER)
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--lenient", action="store_true", help="record sink failures instead of failing the batch")
    p.add_argument("--dedup-within", default=None, help="drop repeated records across batches within this watermark")
    p.add_argument("--region-label", default="region")
    p.add_argument("--dedupe", action="store_true", help="drop repeated deliveries by topic, partition and offset, in all batches with --tables")
    p.add_argument("--no-current", action="store_true", help="do not keep the current tables and the corrected window counts")
    p.add_argument("--window", default="5 minutes", help="width of the kept window counts")
    p.add_argument("--delay", default="10 minutes", help="how long a window stays open for late events")
    p.add_argument("--progress", default=None, metavar="ROOT", help="folder of the progress tables (default: that of the tables)")
    p.add_argument("--stop-timeout", type=float, default=120.0, help="seconds a stop waits for the running batch")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace):
    if args.kafka:
        raw = streams.kafka_events(spark, args.kafka, args.topic, args.starting_offsets,
                                   max_offsets_per_trigger=args.max_offsets_per_trigger,
                                   min_partitions=args.min_partitions)
    else:
        raw = streams.file_events(spark, args.files, args.max_files_per_trigger)
    if args.tables:
        sink = ParquetSink(args.tables, keep=not args.no_current, window=args.window, delay=args.delay)
    else:
        sink = JdbcSink({"url": args.jdbc_url, "driver": args.jdbc_driver, "user": args.jdbc_user,
                         "password": args.jdbc_password})
    processor = BatchProcessor(sink, strict=not args.lenient, region_label=args.region_label, dedupe=args.dedupe,
                               delivered=DeliveredOffsets(args.tables) if args.dedupe and args.tables else None)
    root = args.progress or args.tables
    if root:
        spark.streams.addListener(ProgressRecorder(spark, root))
    return start_pipeline(spark, raw, processor, name=args.name, checkpoint=args.checkpoint,
                          trigger=args.trigger, available_now=args.available_now, dedup_within=args.dedup_within)


def wait(query, stop: threading.Event, timeout: float) -> None:
    """Until the query ends, or ``stop`` is set: then let its batch finish."""
    while query.isActive and not stop.is_set():
        query.awaitTermination(1)
    if query.isActive:
        stop_gracefully(query, timeout)
    elif query.exception() is not None:
        raise query.exception()


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = config.stream_builder(SparkSession.builder, f"clickmart-{args.name}").getOrCreate()
    stop = threading.Event()
    for s in (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: stop.set())
    wait(run(spark, args), stop, args.stop_timeout)


if __name__ == "__main__":
    main()
