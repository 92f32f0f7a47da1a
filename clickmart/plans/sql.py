"""Dashboard SQL text on Spark: the stored tables as temp views, and the
panel time-range macros expanded before ``spark.sql`` runs the text.

    register_views(spark, read_tables(spark, root))
    run_sql(spark, "SELECT ... FROM clickstream_events WHERE $__timeFilter(timestamp) ...", rng, now)

Macros: ``$__timeFilter(col)`` -> ``col BETWEEN <from> AND <to>`` (inclusive),
``$__timeFrom()`` / ``$__timeTo()`` -> the range ends.  ``NOW()`` and
``CURRENT_TIMESTAMP`` are replaced by the ``now`` argument when one is given,
so a query is reproducible.  Values are TIMESTAMP_NTZ literals.
Catalyst plans the text exactly like the DataFrame panels.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _ntz(v: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"


def expand_macros(text: str, rng: tuple[dt.datetime, dt.datetime] | None = None, now: dt.datetime | None = None) -> str:
    """Replace the time macros of panel SQL with literals."""
    if rng is not None:
        lo, hi = _ntz(rng[0]), _ntz(rng[1])
        text = re.sub(r"\$__timeFilter\(\s*([^)]+?)\s*\)", lambda m: f"({m.group(1)} BETWEEN {lo} AND {hi})", text)
        text = text.replace("$__timeFrom()", lo).replace("$__timeTo()", hi)
    if now is not None:
        text = re.sub(r"\bNOW\(\s*\)|\bCURRENT_TIMESTAMP\b(?!\s*\()", _ntz(now), text, flags=re.IGNORECASE)
    if "$__" in text:
        raise ValueError("unexpanded macro in query text (give the time range)")
    return text


def register_views(spark: SparkSession, T: Mapping[str, DataFrame]) -> None:
    """Register each table of ``T`` as a temp view under its name."""
    for name, df in T.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, rng: tuple[dt.datetime, dt.datetime] | None = None,
            now: dt.datetime | None = None) -> DataFrame:
    """Expand the macros and run the text with ``spark.sql``."""
    return spark.sql(expand_macros(text, rng, now))
