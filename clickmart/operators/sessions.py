"""Session operators: sessionisation by inactivity gap (K4) and the session
columns the stored tables declare but the original job never filled (M1-M4,
M6).

Scale notes
-----------
A window partitioned by a bare user or session id puts the whole history of
that key into one task; one robot user or one endless session can hold a
third of all rows.  No window over *events* is partitioned by a bare key:
every "previous / next event of the same key" is computed on time-bucketed
groups ``(key, bucket)``, and the seams between buckets are patched from a
per-bucket summary.  Windows partitioned by the bare key run only over that
summary, which has one row per (key, non-empty bucket) -- bounded by the
time span, not by the key's event count.
Everything else is a plain multi-level ``groupBy`` (map-side partial
aggregation, so hot keys collapse before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions import epoch_micros, floor_div, floor_seconds, idiv, micros_between, pct2
from clickmart.schema import ADD_TO_CART, FUNNEL_STAGES, PAGE_VIEW, PURCHASE

HOUR_MICROS = 3_600_000_000
FINE_MICROS = 60_000_000  # a minute: events of one session that meet in one task
SALTS = 16                # groups of pages of one session
# Order of events inside a session when no event id exists.
SESSION_ORDER = ("timestamp", "event_type", "page_url")

_B = "_tb"  # time-bucket column used by the seam-patching helpers


def _with_bucket(df: DataFrame, ts: str, bucket_micros: int) -> DataFrame:
    return df.withColumn(_B, floor_div(epoch_micros(ts, df.schema[ts].dataType), F.lit(bucket_micros)))


def with_next_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    order: Sequence[str] = SESSION_ORDER,
    out: str = "next_ts",
    bucket_micros: int = HOUR_MICROS,
) -> DataFrame:
    """Add the time of the next row of the same ``keys``, rows ordered by ``order``
    (whose first column must be ``ts``); NULL for the last row of a key.

    Rows with a NULL ``ts`` or key must be removed by the caller.
    """
    keys = list(keys)
    d = _with_bucket(df, ts, bucket_micros)
    inside = Window.partitionBy(*keys, _B).orderBy(*order)
    d = d.withColumn("_nx_in", F.lead(ts).over(inside))
    seams = (
        d.groupBy(*keys, _B)
        .agg(F.min(ts).alias("_bmin"))
        .withColumn("_nx_seam", F.lead("_bmin").over(Window.partitionBy(*keys).orderBy(_B)))
        .drop("_bmin")
    )
    return (
        d.join(seams, [*keys, _B], "inner")
        .withColumn(out, F.coalesce("_nx_in", "_nx_seam"))
        .drop("_nx_in", "_nx_seam", _B)
    )


def _session_buckets(df: DataFrame, user: str, ts: str, gap_seconds: int, bucket_micros: int, out: str) -> tuple:
    """Rows with their time bucket, and the per-(user, bucket) summary with
    the session number of each bucket's events (see :func:`sessionize`)."""
    gap_us = int(gap_seconds) * 1_000_000
    if gap_us <= 0:
        raise ValueError("gap_seconds must be positive")
    width = max(1, min(int(bucket_micros), gap_us))
    d = _with_bucket(df.filter(F.col(user).isNotNull() & F.col(ts).isNotNull()), ts, width)
    by_bucket = Window.partitionBy(user).orderBy(_B)
    prev_last = F.lag("_bmax").over(by_bucket)
    gap_after = micros_between(prev_last, "_bmin", df.schema[ts].dataType) > F.lit(gap_us)
    starts = F.when(prev_last.isNull() | gap_after, 1).otherwise(0)
    summary = (
        d.groupBy(user, _B).agg(F.min(ts).alias("_bmin"), F.max(ts).alias("_bmax"), F.count(F.lit(1)).alias("_bn"))
        .withColumn("_st", starts)
        .withColumn(out, F.sum("_st").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"))
    )
    return d, summary


def sessionize(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "timestamp",
    gap_seconds: int = 1800,
    out: str = "session_seq",
    bucket_micros: int = HOUR_MICROS,
) -> DataFrame:
    """Number each user's sessions 1, 2, ... in time order (K4).

    A new session starts at a user's first event and whenever the time since
    the user's previous event is *more* than ``gap_seconds``; a gap of exactly
    the threshold stays in the session (as Spark's ``session_window`` merges
    touching windows).  Rows without a user or a time are left out.

    Plan: time buckets are made no wider than the gap, so two events of one
    bucket are always closer than the gap and a session can only start at
    the first event of a bucket.  The rows are therefore never sorted: a
    ``groupBy(user, bucket)`` gives each bucket's first and last time, a
    window over those summary rows (one per user and non-empty bucket)
    numbers the sessions, and an equi-join on (user, bucket) hands the
    number back to the rows.  A hot user is spread over all its buckets.
    """
    d, summary = _session_buckets(df, user, ts, gap_seconds, bucket_micros, out)
    return d.join(summary.select(user, _B, out), [user, _B], "inner").drop(_B)


def derived_sessions(ev: DataFrame, gap_seconds: int = 86400, user: str = "user_id", ts: str = "timestamp",
                     bucket_micros: int = HOUR_MICROS) -> DataFrame:
    """One row per derived session (K4 key): user, session_seq, start, end,
    number of events and duration in whole seconds.

    Rolled up from the per-bucket summary alone: events only pass through a
    map-side partial aggregation, never a shuffle of rows or a join back."""
    _, summary = _session_buckets(ev.select(user, ts), user, ts, gap_seconds, bucket_micros, "session_seq")
    return summary.groupBy(user, "session_seq").agg(
        F.min("_bmin").alias("session_start"),
        F.max("_bmax").alias("session_end"),
        F.sum("_bn").alias("events"),
    ).withColumn("duration_seconds", idiv(micros_between("session_start", "session_end"), F.lit(1_000_000)))


def session_windows(
    ev: DataFrame, gap_seconds: int = 1800, user: str = "user_id", ts: str = "timestamp", watermark: str | None = None
) -> DataFrame:
    """K4, streaming form: the same sessions as :func:`derived_sessions`
    (without the running number), from Spark's ``session_window``, which
    merges windows that touch -- so a gap of exactly the threshold stays in
    the session here too.  With ``watermark`` it runs on a stream: a session
    is emitted once the watermark passes its end, and its state is dropped.

    ``session_window`` sorts all events of a user in one task, so bounded data
    takes the plan of :func:`derived_sessions` instead, which spreads them."""
    if not ev.isStreaming:
        return derived_sessions(ev, gap_seconds, user, ts).drop("session_seq")
    d = ev.filter(F.col(user).isNotNull() & F.col(ts).isNotNull())
    if watermark:
        d = d.withWatermark(ts, watermark)
    return d.groupBy(user, F.session_window(ts, f"{int(gap_seconds)} seconds").alias("_s")).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("events"),
    ).select(user, "session_start", "session_end", "events").withColumn(
        "duration_seconds", idiv(micros_between("session_start", "session_end"), F.lit(1_000_000)))


def _timed(ev: DataFrame) -> DataFrame:
    """Events that can be placed in a session timeline."""
    return ev.filter(F.col("session_id").isNotNull() & F.col("timestamp").isNotNull())


def _grain(by_batch: bool) -> list[str]:
    return ["batch_id"] if by_batch else []


def avg_session_duration(ev: DataFrame, by_batch: bool = True) -> DataFrame:
    """M1: mean of (last - first event time) over sessions, whole seconds,
    floored; NULL sessions and times are left out."""
    g = _grain(by_batch)
    per_session = _timed(ev).groupBy(*g, "session_id").agg(
        micros_between(F.min("timestamp"), F.max("timestamp")).alias("_span")
    )
    return per_session.groupBy(*g).agg(
        F.count(F.lit(1)).alias("sessions"),
        floor_seconds(F.sum("_span"), F.count(F.lit(1))).alias("avg_session_duration"),
    )


def avg_time_on_page(ev: DataFrame, by_batch: bool = False) -> DataFrame:
    """M2: per page, mean seconds from a PAGE_VIEW to the next event of its
    session, over the views that have a next event (floored)."""
    g = _grain(by_batch)
    nxt = with_next_time(_timed(ev).select(*g, "session_id", *SESSION_ORDER), [*g, "session_id"], out="_next")
    views = nxt.filter(F.col("event_type") == PAGE_VIEW)
    timed = F.col("_next").isNotNull()
    return views.groupBy(*g, "page_url").agg(
        F.count_if(timed).alias("timed_views"),
        floor_seconds(F.sum(F.when(timed, micros_between("timestamp", "_next"))), F.count_if(timed)).alias("avg_time_on_page"),
    )


def page_bounce_rate(ev: DataFrame, by_batch: bool = False) -> DataFrame:
    """M3: per landing page (page of a session's first event), the share of
    those sessions that have exactly one event."""
    g = _grain(by_batch)
    first = F.min(F.struct(*[F.col(c) for c in SESSION_ORDER]))
    sessions = _timed(ev).groupBy(*g, "session_id").agg(
        F.count(F.lit(1)).alias("_n"), first.getField("page_url").alias("page_url")
    )
    return sessions.groupBy(*g, "page_url").agg(
        F.count(F.lit(1)).alias("landing_sessions"),
        F.count_if(F.col("_n") == 1).alias("bounced_sessions"),
    ).withColumn("bounce_rate", pct2("bounced_sessions", "landing_sessions"))


def page_conversion_rate(ev: DataFrame, by_batch: bool = False) -> DataFrame:
    """M4: per page, of the sessions that viewed it, the share with a PURCHASE."""
    g = _grain(by_batch)
    t = _timed(ev)
    bought = t.groupBy(*g, "session_id").agg(F.max(F.when(F.col("event_type") == PURCHASE, 1).otherwise(0)).alias("_b"))
    viewed = t.filter(F.col("event_type") == PAGE_VIEW).select(*g, "session_id", "page_url").distinct()
    return viewed.join(bought, [*g, "session_id"], "inner").groupBy(*g, "page_url").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("_b").cast("bigint").alias("converted_sessions"),
    ).withColumn("conversion_rate", pct2("converted_sessions", "sessions"))


def page_sums(ev: DataFrame) -> DataFrame:
    """D3 with M2-M4 as sums per (batch, page), from one scan and without joins.

    ``views``/``visitors`` count all PAGE_VIEW rows, also those without a session
    or a time; ``timed_views``/``span`` the views with a next event and the
    microseconds to it; ``landing``/``bounced`` the sessions that begin on the
    page and those of one event; ``viewed_sessions``/``converted`` the sessions
    that view it and those of them with a PURCHASE.

    Plan: events meet once per (session, minute), where each learns the next
    one's time, and are summed per page there.  What is left goes to the session
    as two kinds of rows: the first and last event of each minute, whose window
    patches the seams between minutes, and the page rows, which are spread over
    ``SALTS`` groups so that a session of very many pages is not one task.  A
    purchase is told to each of those groups.  Rows outside sessions only pass
    through, spread by page and user.
    """
    g, ts = ["batch_id"], "timestamp"
    micros = lambda a, b: micros_between(a, b, ev.schema[ts].dataType)
    view, buy = F.col("event_type").eqNullSafe(PAGE_VIEW), F.col("event_type").eqNullSafe(PURCHASE)
    spread = F.xxhash64("page_url", "user_id")
    timed = F.col("session_id").isNotNull() & F.col(ts).isNotNull()
    d = ev.select(*g, "session_id", "user_id", *SESSION_ORDER, timed.alias("_timed"))
    d = _with_bucket(d, ts, FINE_MICROS).withColumn(_B, F.when(F.col("_timed"), F.col(_B)).otherwise(spread))

    minute = [*g, "session_id", "_timed", _B]
    order = Window.partitionBy(*minute).orderBy(*SESSION_ORDER)
    d = d.withColumn("_next", F.lead(ts).over(order)).withColumn("_k", F.row_number().over(order))
    d = d.withColumn("_last", F.lead(F.lit(1)).over(order).isNull())
    followed = F.col("_timed") & view & ~F.col("_last")
    pages = d.groupBy(*minute, "page_url", "user_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(view).alias("views"),
        F.max(buy).alias("_buy"),
        F.count_if(followed).alias("timed_views"),
        F.sum(F.when(followed, micros(ts, "_next"))).alias("span"),
        F.min(ts).alias("_from"),
        F.max(F.col("_k") == 1).alias("_first"),
        F.max("_last").alias("_last"),
        F.max(F.when(F.col("_last") & view, F.col(ts))).alias("_open"),  # a view whose next event is in a later minute
    )

    carried = ["page_url", "user_id", "_n", "views", "timed_views", "span", "_from", "_first", "_last", "_open"]

    def row(salt: Column, kind: str, keep: set[str]) -> Column:
        return F.struct(salt.cast("bigint").alias("_salt"), F.lit(kind).alias("_kind"), *[
            (F.col(c) if c in keep else F.lit(None).cast(pages.schema[c].dataType)).alias(c) for c in carried])

    by_page = F.when(F.col("_timed"), F.pmod(F.xxhash64("page_url"), F.lit(SALTS))).otherwise(spread)
    page = F.when(F.col("views") > 0, F.array(row(by_page, "page", {"page_url", "user_id", "views", "timed_views", "span"})))
    seam = F.when(F.col("_timed") & (F.col("_first") | F.col("_last")),
                  F.array(row(F.lit(-1), "seam", {"page_url", "user_id", "_n", "_from", "_first", "_last", "_open"})))
    told = F.when(F.col("_timed") & F.col("_buy"), F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda k: row(k, "buy", set())))
    empty = F.array().cast(f"array<{_struct_ddl(pages, carried)}>")
    rows = pages.select(*minute, F.inline(F.concat(*[F.coalesce(x, empty) for x in (page, seam, told)])))

    group = [*g, "session_id", "_timed", "_salt"]
    along = Window.partitionBy(*group).orderBy(_B, "_last")  # the first row of a minute, then its last
    bought = F.max(F.col("_kind") == "buy").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = (
        rows.withColumn("_then", F.lead("_from").over(along))
        .withColumn("_opens", F.lag("_kind").over(along).isNull())
        .withColumn("_bought", bought)
    )
    is_seam = F.col("_kind") == "seam"
    starts = is_seam & F.col("_first") & F.col("_opens")
    patched = is_seam & F.col("_open").isNotNull() & F.col("_then").isNotNull()
    alone = starts & F.col("_last") & (F.col("_n") == 1) & F.col("_then").isNull()
    sums = rows.filter(F.col("_kind") != "buy").groupBy(*group, "page_url", "user_id").agg(
        F.sum("views").alias("views"),
        (F.coalesce(F.sum("timed_views"), F.lit(0)) + F.count_if(patched)).alias("timed_views"),
        (F.coalesce(F.sum("span"), F.lit(0)) + F.coalesce(F.sum(F.when(patched, micros("_open", "_then"))), F.lit(0))).alias("span"),
        F.count_if(starts).alias("landing"),
        F.count_if(alone).alias("bounced"),
        F.max(F.col("_timed") & (F.col("_kind") == "page")).alias("_viewed"),
        F.max("_bought").alias("_bought"),
    )
    # A session of several users counts once for its page.
    once = F.row_number().over(Window.partitionBy(*group, "page_url").orderBy("user_id")) == 1
    sums = sums.withColumn("viewed_sessions", (once & F.col("_viewed")).cast("bigint"))
    sums = sums.withColumn("converted", F.when(F.col("_bought"), F.col("viewed_sessions")).otherwise(F.lit(0).cast("bigint")))
    figures = ["views", "timed_views", "span", "landing", "bounced", "viewed_sessions", "converted"]
    per_user = sums.groupBy(*g, "page_url", "user_id").agg(*[F.sum(c).alias(c) for c in figures])
    return per_user.groupBy(*g, "page_url").agg(
        *[F.sum(c).alias(c) for c in figures], F.count_if(F.col("views") > 0).alias("visitors"))


def _struct_ddl(df: DataFrame, columns: Sequence[str]) -> str:
    fields = ["_salt:bigint", "_kind:string", *[f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns]]
    return f"struct<{','.join(fields)}>"


def session_funnel(ev: DataFrame) -> DataFrame:
    """M6: sessions reaching each stage in time order.

    Page Views: the session has a PAGE_VIEW.  Add to Cart: an ADD_TO_CART at
    or after its first PAGE_VIEW.  Purchases: a PURCHASE at or after such an
    ADD_TO_CART.  Stage counts are therefore non-increasing.

    Plan: per (session, minute) six flags say which of V, A, P and of the ordered
    sequences VA, AP, VAP occur in it.  They add up along the minutes: a sequence
    is complete in a minute, or its head in an earlier one and its tail in this.
    Events meet per minute only and are never joined; the window over a session
    runs over its minutes.
    """
    et = F.col("event_type")
    stages = {"_v": PAGE_VIEW, "_a": ADD_TO_CART, "_p": PURCHASE}
    t = _with_bucket(_timed(ev).filter(et.isin(*stages.values())), "timestamp", FINE_MICROS)
    t = t.select("session_id", _B, "timestamp", *[(et == kind).alias(c) for c, kind in stages.items()])
    up_to = Window.partitionBy("session_id", _B).orderBy("timestamp").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = lambda c: F.max(c).over(up_to)
    t = t.withColumn("_va", F.col("_a") & seen("_v")).withColumn("_ap", F.col("_p") & seen("_a"))
    t = t.withColumn("_vap", F.col("_p") & seen("_va"))
    flags = ("_v", "_a", "_p", "_va", "_ap", "_vap")
    minutes = t.groupBy("session_id", _B).agg(*[F.max(c).alias(c) for c in flags])

    earlier = Window.partitionBy("session_id").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.max(c).over(earlier), F.lit(False))
    minutes = minutes.withColumn("_bv", before("_v"))
    minutes = minutes.withColumn("_two", F.col("_va") | (F.col("_bv") & F.col("_a")))
    minutes = minutes.withColumn("_three", F.col("_vap") | (F.col("_bv") & F.col("_ap")) | (before("_two") & F.col("_p")))
    reached = minutes.groupBy("session_id").agg(*[F.max(c).alias(f"_f{i}") for i, c in enumerate(("_v", "_two", "_three"), start=1)])
    totals = reached.agg(*[F.count_if(f"_f{i}").alias(f"_s{i}") for i in (1, 2, 3)])
    return totals.select(
        F.inline(F.array(*[
            F.struct(F.lit(label).alias("stage"), F.lit(i).cast("bigint").alias("stage_order"), F.col(f"_s{i}").alias("sessions"))
            for i, (label, _) in enumerate(FUNNEL_STAGES, start=1)
        ]))
    )
