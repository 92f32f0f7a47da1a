"""Decoding of wire records (A3) and the quarantine of records it drops (A4).

Input is any frame with a ``value`` column (binary or string) -- a Kafka
source, a JSON-lines file source, or a stored table.  Other columns (e.g.
``batch_id``, ``partition``, ``offset``) are passed through when asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import parse_event_time
from clickmart.schema import AMOUNT, CORRUPT_COLUMN, EVENT_SCHEMA_WITH_CORRUPT, IDENTITY, WIRE_FIELDS

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def decode_records(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON parse per record: the ``keep`` columns, the record text as
    ``value``, the eight wire fields, the optional ``amount``, and ``reason`` -- NULL for a usable
    event, ``undecodable`` (NULL, not a JSON object) or ``missing_user``.
    :func:`parse_events` and :func:`quarantine_events` are its two halves,
    so a micro-batch can decode once and split."""
    text = F.col("value").cast("string")
    d = raw.select(*keep, text.alias("_text"), F.from_json(text, EVENT_SCHEMA_WITH_CORRUPT, _JSON_OPTIONS).alias("_d"))
    undecodable = F.col("_d").isNull() | F.col(f"_d.{CORRUPT_COLUMN}").isNotNull()
    reason = F.when(undecodable, "undecodable").when(F.col("_d.userId").isNull(), "missing_user")
    return d.select(*keep, F.col("_text").alias("value"), *[F.col(f"_d.{f}").alias(f) for f in (*WIRE_FIELDS, AMOUNT)],
                    reason.alias("reason"))


def identity_of(raw: DataFrame) -> list[str]:
    """The identity columns that the source has."""
    return [c for c in IDENTITY if c in raw.columns]


def parse_events(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Wire value -> the eight wire fields (strings); records that do not
    decode or have no ``userId`` are dropped, as in the original job."""
    return events_of(decode_records(raw, keep), keep)


def quarantine_events(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Complement of :func:`parse_events`: every dropped record with a reason,
    ``undecodable`` (NULL, not a JSON object) or ``missing_user``."""
    return rejects_of(decode_records(raw, keep), keep)


def events_of(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The usable events of :func:`decode_records` output (wire fields and the
    ``keep`` columns; ``amount`` is one to keep)."""
    return decoded.filter(F.col("reason").isNull()).select(*keep, *WIRE_FIELDS)


def rejects_of(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The quarantined records of :func:`decode_records` output."""
    return decoded.filter(F.col("reason").isNotNull()).select(*keep, "value", "reason")


def to_click_events(parsed: DataFrame, zoned: bool = False) -> DataFrame:
    """Wire fields -> stored column names, event time parsed (NULL when
    unparsable, never an error), an ``amount`` read as a number (likewise).
    Extra columns are kept.

    ``zoned=True`` (streams) reads times without a zone in the session's zone,
    so that must be UTC."""
    if zoned:
        zone = parsed.sparkSession.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            raise ValueError(f"spark.sql.session.timeZone must be UTC to read event times on a stream, not {zone}")
    renames = {"userId": "user_id", "page": "page_url", "eventType": "event_type", "sessionId": "session_id"}
    others = [c for c in parsed.columns if c not in (*WIRE_FIELDS, AMOUNT)]
    if AMOUNT in parsed.columns:
        others.append(F.col(AMOUNT).try_cast("decimal(18,2)").alias(AMOUNT))
    return parsed.select(
        *[F.col(w).alias(renames[w]) for w in ("userId", "page", "eventType")],
        parse_event_time("eventTime", zoned).alias("timestamp"),
        F.col("sessionId").alias("session_id"),
        "device", "region", "referrer", *others,
    )
