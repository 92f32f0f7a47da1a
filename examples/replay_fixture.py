"""End to end on the driver's test data: wire records as JSON-lines files ->
the streaming job (one micro-batch per file) -> the five stored tables ->
dashboard panels over them.

    python examples/replay_fixture.py /root/testdata/sf0.01

Everything is written under ``<spark.checkpoint.dir>/clickmart-example-<id>``.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickmart.plans import dashboard  # noqa: E402
from clickmart.sinks.tables import checkpoint_root  # noqa: E402
from clickmart.sources import fixture as fx  # noqa: E402
from clickmart.sources import streams  # noqa: E402
from clickmart.streaming import job  # noqa: E402


def main(sf_dir: str) -> None:
    spark = (SparkSession.builder.master("local[8]").appName("clickmart-example")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    base = f"{checkpoint_root(spark)}/clickmart-example-{uuid.uuid4().hex[:8]}"
    raw_dir, tables = f"{base}/incoming", f"{base}/tables"

    # One folder of JSON lines per 10 days, written in order.
    wire = fx.wire_records(spark, sf_dir)
    for lo in (0, 10, 20):
        streams.write_wire_files(wire.filter(F.col("batch_id").between(lo, lo + 9)).coalesce(1), raw_dir)

    args = job.parse_args(["--files", raw_dir, "--tables", tables, "--available-now", "--max-files-per-trigger", "1",
                           "--name", "example", "--checkpoint", f"{base}/checkpoint"])
    job.run(spark, args).awaitTermination()

    rng = (fx.TIME_FROM, fx.TIME_TO)
    for panel in ("event_count_check", "recent_session_metrics", "top_pages", "conversion_funnel", "device_by_segment"):
        print(f"== {panel}")
        dashboard.run_panel(spark, tables, panel, fx.NOW, rng).show(10, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
