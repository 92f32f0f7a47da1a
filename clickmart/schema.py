"""Schemas, table layouts and fixed vocabulary of the click-event data model.

Everything here is plain data: the wire schema of one JSON click event, the
five stored tables (partitioned by date, stream and batch), and the event-type
and label constants the marts and dashboard queries compare against.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's wire format and labels) -------
# Wire field names of one click event, in wire order; every field is a
# nullable string.
WIRE_FIELDS = ("userId", "sessionId", "eventType", "eventTime", "page", "referrer", "device", "region")
# Event types the producer emits.
PAGE_VIEW = "PAGE_VIEW"
ADD_TO_CART = "ADD_TO_CART"
PURCHASE = "PURCHASE"
LOGIN = "LOGIN"
LOGOUT = "LOGOUT"
# Stage labels of the conversion funnel, in funnel order.
FUNNEL_STAGES = (("Page Views", PAGE_VIEW), ("Add to Cart", ADD_TO_CART), ("Purchases", PURCHASE))
# User segments by number of purchases: 0, 1, more.
SEGMENT_BROWSERS = "Browsers"
SEGMENT_ONE_TIME = "One-time Buyers"
SEGMENT_REPEAT = "Repeat Buyers"
# Series labels of the time-series panels.
LABEL_TOTAL_EVENTS = "Total Events"
LABEL_BOUNCE_RATE = "Bounce Rate"
# Names of the five stored tables.
TABLE_EVENTS = "clickstream_events"
TABLE_METRICS = "realtime_metrics"
TABLE_PAGES = "page_metrics"
TABLE_USERS = "user_behavior"
TABLE_DIMENSIONS = "device_analytics"
REQUIRED_TABLES = (TABLE_EVENTS, TABLE_METRICS, TABLE_PAGES, TABLE_USERS, TABLE_DIMENSIONS)
# ---------------------------------------------------------------------------

CORRUPT_COLUMN = "_corrupt_record"

# Optional wire field: the order value of a PURCHASE (text of a number).
AMOUNT = "amount"
# Where a record came from; its identity, if the source knows it.
IDENTITY = ("topic", "partition", "offset")

EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in WIRE_FIELDS])
# Same schema plus the slot ``from_json`` fills with the text of a record it
# cannot decode (used to tell undecodable records from records without a user).
EVENT_SCHEMA_WITH_CORRUPT = T.StructType(EVENT_SCHEMA.fields + [
    T.StructField(AMOUNT, T.StringType(), True), T.StructField(CORRUPT_COLUMN, T.StringType(), True)])

# Decoded event as stored (wire names renamed, event time parsed).
RAW_EVENT_COLUMNS = ("user_id", "page_url", "event_type", "timestamp", "session_id", "device", "region", "referrer")

_S, _L, _NTZ, _TS, _D = T.StringType(), T.LongType(), T.TimestampNTZType(), T.TimestampType(), T.DateType()
_RATE = T.DecimalType(5, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TABLE_SCHEMAS: dict[str, T.StructType] = {
    TABLE_EVENTS: _struct(
        ("user_id", _S), ("page_url", _S), ("event_type", _S), ("timestamp", _NTZ), ("session_id", _S),
        ("device", _S), ("region", _S), ("referrer", _S), ("amount", T.DecimalType(18, 2)), ("topic", _S),
        ("partition", T.IntegerType()), ("offset", _L), ("created_at", _TS), ("event_date", _D), ("stream_id", _S), ("batch_id", _L),
    ),
    TABLE_METRICS: _struct(
        ("metric_timestamp", _NTZ), ("total_events", _L), ("unique_users", _L), ("unique_sessions", _L),
        ("page_views", _L), ("purchases", _L), ("cart_additions", _L), ("bounce_rate", _RATE),
        ("avg_session_duration", _L), ("created_at", _TS), ("batch_date", _D), ("stream_id", _S), ("batch_id", _L),
    ),
    TABLE_PAGES: _struct(
        ("page_url", _S), ("view_count", _L), ("unique_visitors", _L), ("avg_time_on_page", _L),
        ("bounce_rate", _RATE), ("conversion_rate", _RATE), ("last_updated", _TS), ("batch_date", _D), ("stream_id", _S), ("batch_id", _L),
    ),
    TABLE_USERS: _struct(
        ("user_id", _S), ("sessions", _L), ("events", _L), ("purchases", _L), ("last_active", _NTZ),
        ("updated_at", _TS), ("batch_date", _D), ("stream_id", _S), ("batch_id", _L),
    ),
    TABLE_DIMENSIONS: _struct(
        ("dimension_type", _S), ("dimension_value", _S), ("event_count", _L), ("unique_users", _L),
        ("conversion_rate", _RATE), ("updated_at", _TS), ("batch_date", _D), ("stream_id", _S), ("batch_id", _L),
    ),
}

# Column a writer fills with the processing time (the database default in the
# original tables).
WRITE_TIME_COLUMN = {
    TABLE_EVENTS: "created_at",
    TABLE_METRICS: "created_at",
    TABLE_PAGES: "last_updated",
    TABLE_USERS: "updated_at",
    TABLE_DIMENSIONS: "updated_at",
}

# Partition columns of each table, outermost first: the event's date or the
# batch's date, so that a time range prunes whole folders; then the stream and
# the batch, which a replay replaces.
PARTITIONS = {name: ("event_date" if name == TABLE_EVENTS else "batch_date", "stream_id", "batch_id") for name in REQUIRED_TABLES}
