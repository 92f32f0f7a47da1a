"""Exact distinct users over any range of batches, from stored bitmaps.

Every user has a stable number.  A batch stores, per page and per hour, the
numbers of its users as bitmaps of 32,768 bits, one row for each stretch of
numbers that occurs.  Bitmaps of any batches are joined by OR, so the distinct
users of a range are exact, which sums or maxima of per-batch counts cannot be,
and neither raw events nor user ids are read again.  Spark's bitmap functions
aggregate partially, so a page in every batch gathers nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.schema import PAGE_VIEW

NUMBER_BUCKETS = 64


def number_bucket(user: str = "user_id", buckets: int = NUMBER_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def user_numbers(users: DataFrame, taken: DataFrame | None = None, buckets: int = NUMBER_BUCKETS) -> DataFrame:
    """user_id, number (from 1) for the distinct users of ``users``.

    Numbers are dealt within buckets of the users' hash, every ``buckets``-th
    number each, so no task numbers all of them and they stay nearly without
    gaps.  ``taken`` (bucket, used: numbers a bucket has dealt before) continues an
    earlier numbering.  A NULL user has no number."""
    new = users.select("user_id").filter(F.col("user_id").isNotNull()).distinct().withColumn("bucket", number_bucket(buckets=buckets))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("user_id")).cast("bigint") - 1
    if taken is not None:
        new = new.join(taken.groupBy("bucket").agg(F.max("used").alias("used")), "bucket", "left")
        place = place + F.coalesce("used", F.lit(0))
    return new.select("user_id", (place * buckets + F.col("bucket") + 1).alias("number"))


def user_bitmaps(rows: DataFrame, keys: Sequence[str], numbers: DataFrame) -> DataFrame:
    """keys, stretch, users: the numbers of the users of each key, as bitmaps.  Each
    pair of key and user moves once."""
    pairs = rows.select(*keys, "user_id").filter(F.col("user_id").isNotNull()).distinct().join(numbers, "user_id")
    return pairs.groupBy(*keys, F.bitmap_bucket_number("number").alias("stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))


def page_bitmaps(ev: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per (batch, page): the views, on the row of the lowest stretch, and the users
    as bitmaps; a page seen only by nobody known has a row without users."""
    views = ev.filter(F.col("event_type") == PAGE_VIEW)
    keys = ["batch_id", "page_url"]
    bits = user_bitmaps(views, keys, numbers).withColumn("view_count", F.lit(0).cast("bigint"))
    counts = views.groupBy(*keys).agg(F.count(F.lit(1)).alias("view_count")).select(
        *keys, F.lit(None).cast("bigint").alias("stretch"), F.lit(None).cast("binary").alias("users"), "view_count")
    return bits.unionByName(counts)


def hour_bitmaps(ev: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per (batch, hour of the event time): the users as bitmaps."""
    hours = ev.filter(F.col("timestamp").isNotNull()).withColumn("hour_start", F.window("timestamp", "1 hour").start)
    return user_bitmaps(hours, ["batch_id", "hour_start"], numbers)


def distinct_users(bitmaps: DataFrame, keys: Sequence[str] = (), name: str = "unique_visitors", **sums: str) -> DataFrame:
    """Per key the exact number of distinct users in ``bitmaps`` (rows of any
    batches), and the ``sums`` (new name=column)."""
    merged = bitmaps.groupBy(*keys, "stretch").agg(F.bitmap_or_agg("users").alias("users"), *[F.sum(c).alias(n) for n, c in sums.items()])
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias(name), *[F.sum(n).alias(n) for n in sums])


def top_pages_unique(bitmaps: DataFrame, k: int = 10) -> DataFrame:
    """J6 with true distinct visitors: the ``k`` most viewed pages of the batches in
    ``bitmaps`` (rows of :func:`page_bitmaps`)."""
    found = distinct_users(bitmaps, ["page_url"], total_views="view_count")
    return found.orderBy(F.col("total_views").desc(), "page_url").limit(k).select("page_url", "total_views", "unique_visitors")
