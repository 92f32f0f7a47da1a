"""Helpers shared by the operators: staged tables, word rules, byte and hash arrays."""

from __future__ import annotations

import contextlib
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.sinks import files
from clickmart.sinks.tables import scratch_root

#: A word: a run of characters other than ASCII white space (RE2 and Java syntax).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
SEGMENT = 1 << 20


# --- tables ------------------------------------------------------------------

def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``); a temporary
    one only where none is named and all of Spark is one machine, as in tests."""
    return scratch_root(spark)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    lineage ends there and the rows outlive any executor."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Work:
    """Staged tables of one call, removed together once its result is staged."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stage(self, df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
        """``stage``, written by ``tasks`` tasks at most, for tables whose size says
        so: a small one in hundreds of files costs more than its rows."""
        self.paths.append(scratch(self.spark, name))
        return stage(df if tasks is None else df.coalesce(tasks), name, self.paths[-1])

    def clear(self) -> None:
        for path in self.paths:
            files.delete(self.spark, path)
        self.paths = []


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the actions inside; the old ones come back after."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def crc(col: str) -> Column:
    """crc32 of the column's text; NULL where it is NULL."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, also where ``body``
    uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def worker_cache(name: str) -> dict:
    """A dict of this Python process that outlives a task (functions shipped by
    value get new globals in every task)."""
    holder = sys.modules.setdefault("_clickmart_llm_cache", types.ModuleType("_clickmart_llm_cache"))
    return holder.__dict__.setdefault(name, {})


# --- bytes and hashes --------------------------------------------------------

def flat(arr) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string column as UTF-8 bytes and row offsets; NULL is empty."""
    import pyarrow as pa

    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, cap: int = 4 * SEGMENT) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``cap`` bytes; a longer row stands alone."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + cap, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64; changes ``h`` in place."""
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    c = worker_cache("powers")
    if len(c.get("up", ())) < n:
        n = max(n, 1 << 16)
        up, down = np.full(n, _BASE, _U), np.full(n, _BASE_INV, _U)
        up[0] = down[0] = 1
        c["up"], c["down"] = np.cumprod(up), np.cumprod(down)
        c["table"] = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
    return c["up"], c["down"], c["table"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges ``[start, end)``, by prefix sums."""
    up, down, table = _powers(len(data) + 1)
    pre = np.zeros(len(data) + 1, _U)
    np.cumsum(table[data] * up[:len(data)], out=pre[1:])
    h = (pre[end] - pre[start]) * down[start]
    h += (end - start).astype(_U) * _U(0xD6E8FEB86659FD93)
    return mix(h)


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; no word crosses a row."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | cut[1:n]
    end = word
    last = word.copy()
    last[:-1] &= ~end[1:] | cut[1:n]
    return np.flatnonzero(start), np.flatnonzero(last) + 1


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each row where its words begin (one more
    entry than rows).  Long texts are hashed in segments."""
    start, end = word_spans(data, off)
    hashes = np.empty(len(start), _U)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + SEGMENT, "right")))
        base = start[lo]
        hashes[lo:hi] = span_hashes(data[base:end[hi - 1]], start[lo:hi] - base, end[lo:hi] - base)
        lo = hi
    return hashes, np.searchsorted(start, off)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = words[:n].copy()
    for j in range(1, k):
        h *= _U(_BASE)
        h += words[j:j + n]
    return mix(h)
