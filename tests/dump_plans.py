"""Write PLANS.md: operator counts of each registered query's final
(adaptive) physical plan at a given scale, with the scale note per query.

    python tests/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

OPS = (r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|BroadcastExchange|"
       r"BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|Window|Expand|Generate|TakeOrderedAndProject|"
       r"HashAggregate|ObjectHashAggregate|SortAggregate|Scan \w+|Union|CartesianProduct|BroadcastNestedLoopJoin")

NOTES = {
    "realtime_metrics": "one Expand (grouping sets) pass; partial aggregation before both shuffles; no join",
    "sessionize": "bucket summary + window over summary rows + roll-up; events never shuffled as rows",
    "session_windows": "Spark session_window: sorts a user's events in one task (stream form; batch uses sessionize)",
    "avg_time_on_page": "window on (session, bucket); seams joined on (session, bucket): rows shuffled once",
    "session_funnel": "flags per (session, minute), folded along the minutes; no join",
    "device_by_segment": "per-user segments joined with distinct (user, device) pairs",
    "retention_cohort": "window over distinct (user, day) rows only",
    "error_rate_alert": "one scan with pushed filter; RANGE window over the per-window table (bounded by time span)",
    "recent_activity": "TakeOrderedAndProject: k rows per task, no full sort",
    "top_pages": "two-level aggregation, then top-k",
    "dedup_events": "dropDuplicates = aggregation on the key columns, duplicates collapse map-side",
    "sliding_active_users": "one row per user and slide first; only those rows are expanded into the 6 windows",
    "device_analytics": "device and region unpivoted in one scan, two-level distinct",
    "rollup_dimensions": "cube over a (device, region, user) pre-aggregate",
    "page_bounce_rate": "landing page = min(struct(ts, type, page)): a struct buffer makes it a SortAggregate (spills, exact)",
    "page_conversion_rate": "per-session purchase flag joined with distinct (session, page) views",
    "engagement_funnel_distinct": "one scan, three conditional counts, rows via inline, then distinct",
    "conversion_funnel": "one scan, three conditional counts (the panel's three scans + UNION ALL)",
}


def main(argv):
    from pyspark.sql import SparkSession

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from clickmart.plans import registry

    lines = [
        "# Physical plans (generated by `tests/dump_plans.py`)",
        "",
        f"Final adaptive plans at `{os.path.basename(sf_dir)}`, local[8], 8 shuffle partitions. Every scan is of Parquet: the",
        "derived fixture events (the stand-in for the stored events table, written once per application) or a",
        "driver table. Counts are operator occurrences in the executed plan.",
        "",
        "| key | operators | note |",
        "|---|---|---|",
    ]
    for name, fn in registry.queries().items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        text = df._jdf.queryExecution().executedPlan().toString()
        ops = Counter(re.findall(OPS, text))
        desc = ", ".join(f"{k.replace('Exchange ', 'Exch ')} {v}" for k, v in sorted(ops.items()))
        lines.append(f"| `{name}` | {desc} | {NOTES.get(name, '')} |")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
