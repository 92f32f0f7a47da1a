"""Exact deduplication across batches by ranges of offsets (K8).

What has been stored is kept per topic and partition as merged ranges of offsets,
which in practice is one range each and one more for every gap.  A record whose
offset lies in a range was delivered before and is dropped, however long ago that
was; there is no state per record and no watermark after which repeats come back.

The ranges after a batch are written once under the batch's number when its
tables are written.  A batch looks at the ranges of the batches before it, so a
replayed batch keeps its own records, and a restart finds the ranges where they
were.  Ranges of other streams over the same tables count too: a new checkpoint
that starts from the earliest offset stores nothing twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmart.schema import IDENTITY
from clickmart.sinks import files

SPAN = 1 << 16  # offsets that are brought together before islands are told apart
KEPT = 20       # states of a stream that stay; older ones are removed

Ranges = dict[tuple[str, int], list[list[int]]]


def merged(*parts: Ranges) -> Ranges:
    """The union, with touching ranges joined."""
    out: Ranges = {}
    for key in sorted({k for p in parts for k in p}):
        rows: list[list[int]] = []
        for lo, hi in sorted(r for p in parts for r in p.get(key, ())):
            if rows and lo <= rows[-1][1] + 1:
                rows[-1][1] = max(rows[-1][1], hi)
            else:
                rows.append([lo, hi])
        out[key] = rows
    return out


def islands(records: DataFrame) -> DataFrame:
    """topic, partition, lo, hi: the runs of consecutive offsets in ``records``.

    Offsets are told apart within spans of ``SPAN``, so a partition with a large
    share of the records is spread over tasks; a run that crosses spans comes in
    pieces that touch."""
    seen = records.select(*IDENTITY).dropna().distinct().withColumn("_span", F.shiftright("offset", 16))
    place = F.row_number().over(Window.partitionBy("topic", "partition", "_span").orderBy("offset"))
    seen = seen.withColumn("_run", F.col("offset") - place)
    return seen.groupBy("topic", "partition", "_span", "_run").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).select("topic", "partition", "lo", "hi")


def drop_delivered(records: DataFrame, ranges: Ranges) -> DataFrame:
    """``records`` without those whose offset is in ``ranges``, and each identity
    once.  Records without a full identity all stay."""
    spark = records.sparkSession
    known = F.lit(True)
    for c in IDENTITY:
        known = known & F.col(c).isNotNull()
    alone = F.when(~known, F.monotonically_increasing_id())
    once = records.withColumn("_alone", alone).dropDuplicates([*IDENTITY, "_alone"]).drop("_alone")
    rows = [(t, p, r) for (t, p), r in ranges.items()]
    if not rows:
        return once
    # One row per partition of the source; what it holds grows with the gaps only.
    table = spark.createDataFrame(rows, "_topic string, _partition int, _ranges array<array<bigint>>")
    inside = F.exists("_ranges", lambda r: (F.col("offset") >= r[0]) & (F.col("offset") <= r[1]))
    joined = once.join(F.broadcast(table), (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition")), "left")
    return joined.filter(F.col("_ranges").isNull() | F.col("offset").isNull() | ~inside).select(*records.columns)


class DeliveredOffsets:
    """The ranges stored under ``root``."""

    def __init__(self, root: str):
        self.root = f"{root.rstrip('/')}/_delivered"

    def _states(self, spark: SparkSession) -> dict[str, dict[int, str]]:
        out: dict[str, dict[int, str]] = {}
        for path in files.glob(spark, f"{self.root}/stream_id=*/batch_id=*"):
            stream, batch = path.rsplit("/", 2)[-2:]
            out.setdefault(stream.split("=", 1)[1], {})[int(batch.split("=", 1)[1])] = path
        return out

    @staticmethod
    def _read(spark: SparkSession, path: str) -> Ranges:
        return {(t, p): r for t, p, r in json.loads(files.read_text(spark, path))}

    def before(self, spark: SparkSession, stream: str, batch_id: int) -> Ranges:
        """What counts as delivered for a batch: the newest state of every other
        stream, and of its own that of the batch before."""
        found = []
        for name, states in self._states(spark).items():
            numbers = [n for n in states if name != stream or n < batch_id]
            if numbers:
                found.append(self._read(spark, states[max(numbers)]))
        return merged(*found)

    def own(self, spark: SparkSession, stream: str, batch_id: int) -> Ranges:
        states = self._states(spark).get(stream, {})
        numbers = [n for n in states if n < batch_id]
        return self._read(spark, states[max(numbers)]) if numbers else {}

    def add(self, spark: SparkSession, stream: str, batch_id: int, new: Iterable[tuple[str, int, int, int]]) -> None:
        """Write the state after a batch, which stored the ranges ``new``."""
        fresh: Ranges = {}
        for topic, partition, lo, hi in new:
            fresh.setdefault((topic, partition), []).append([lo, hi])
        state = merged(self.own(spark, stream, batch_id), fresh)
        text = json.dumps([[t, p, r] for (t, p), r in state.items()])
        files.write_once(spark, f"{self.root}/stream_id={stream}/batch_id={int(batch_id)}", text)
        states = self._states(spark).get(stream, {})
        for n in sorted(states)[:-KEPT]:
            files.delete(spark, states[n])
