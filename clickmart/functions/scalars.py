"""Column expressions shared by the marts and queries.

All are built-in Spark expressions (JVM side, inside whole-stage codegen);
none is a Python UDF.  Integer arithmetic is used wherever a result must be
bit-identical across engines (rates, means, second differences).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integral division ``a div b`` (truncates; callers pass non-negative values)."""
    return F.call_function("div", _c(a).cast("bigint"), _c(b).cast("bigint"))


def floor_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integral division rounded down, also below zero (times before 1970);
    ``b`` is positive."""
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    return F.call_function("div", a - F.pmod(a, b), b)


def pct2(n: ColumnOrName, d: ColumnOrName, empty: Column | None = None) -> Column:
    """``100 * n / d`` rounded half-up to two places, as DOUBLE.

    Computed in integers, ``((n*20000 + d) div (2d)) / 100``, so the value is
    the same in every engine.  ``empty`` is returned when ``d`` is 0 or NULL
    (NULL by default).
    """
    n, d = _c(n).cast("bigint"), _c(d).cast("bigint")
    value = idiv(n * 20000 + d, d * 2).cast("double") / F.lit(100.0)
    out = F.when(d > 0, value)
    return out.otherwise(empty) if empty is not None else out


def mean2(total: ColumnOrName, n: ColumnOrName) -> Column:
    """``total / n`` rounded half-up to two places, as DOUBLE; NULL when n = 0."""
    total, n = _c(total).cast("bigint"), _c(n).cast("bigint")
    return F.when(n > 0, idiv(total * 200 + n, n * 2).cast("double") / F.lit(100.0))


def micros_between(start: ColumnOrName, end: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Exact microseconds from ``start`` to ``end`` (BIGINT); see :func:`epoch_micros`."""
    return epoch_micros(end, dtype) - epoch_micros(start, dtype)


def floor_seconds(total_micros: ColumnOrName, n: ColumnOrName) -> Column:
    """Mean of ``n`` microsecond spans, in whole seconds: ``total div (n * 10^6)``."""
    n = _c(n).cast("bigint")
    return F.when(n > 0, idiv(total_micros, n * 1_000_000))


def epoch_micros(ts: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp (BIGINT).

    Zoned TIMESTAMP columns (``dtype`` given) are measured on the instant.
    Otherwise the value is read on the wall clock from its date and time
    fields, which for TIMESTAMP_NTZ involves no time zone at all --
    ``timestamp_diff`` and ``unix_micros`` would first cast an NTZ value
    through the session zone and shift differences across DST changes.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(_c(ts))
    c = _c(ts)
    return (
        F.unix_date(F.to_date(c)).cast("bigint") * 86_400_000_000
        + F.hour(c).cast("bigint") * 3_600_000_000
        + F.minute(c).cast("bigint") * 60_000_000
        + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    )


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal of a naive ``datetime``, read from its text.

    ``F.lit(datetime)`` makes a zoned literal in the Python process's zone,
    which a later cast to NTZ shifts by the session zone; text has no zone.
    """
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_bucket(ts: ColumnOrName) -> Column:
    """Start of the hour of ``ts``, same type as ``ts`` (time-zone free for NTZ).

    ``date_trunc`` would turn an NTZ value into a zoned one through the
    session zone; a tumbling window start keeps the type.  Rows with a NULL
    time are dropped by Spark's window rewrite, which every caller wants.
    """
    return F.window(_c(ts), "1 hour").start


def day_bucket(ts: ColumnOrName) -> Column:
    """Midnight of the day of ``ts`` as TIMESTAMP_NTZ."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def parse_event_time(s: ColumnOrName, zoned: bool = False) -> Column:
    """Event-time text to a timestamp; unparsable text gives NULL (never throws).

    Batch tables store TIMESTAMP_NTZ on the UTC wall clock: naive text (what
    the producer sends) is read as is; text with a zone (``...Z``,
    ``...+02:00``) is read as an instant and moved to UTC -- a plain cast to
    NTZ would silently drop the offset.  Streams need a zoned TIMESTAMP
    because ``withWatermark`` rejects NTZ, so ``zoned=True`` parses to
    TIMESTAMP (naive text under the session zone).
    """
    c = _c(s)
    if zoned:
        return c.try_cast("timestamp")
    instant = c.try_cast("timestamp")
    utc_wall = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    # A zone follows a time of day: Z, an offset, or a region's name or letters.
    has_zone = F.trim(c).rlike(r"[T ][0-9]{1,2}(:[0-9]{1,2}){0,2}(\.[0-9]*)? *(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2}){0,2}|[A-Za-z][A-Za-z0-9_+/:-]*)$")
    return F.when(has_zone, utc_wall).otherwise(c.try_cast("timestamp_ntz"))


def is_type(col: ColumnOrName, event_type: str) -> Column:
    """Case-insensitive event-type test (producers disagree on case)."""
    return F.upper(_c(col)) == F.lit(event_type.upper())
