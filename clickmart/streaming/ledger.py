"""Aggregates kept up to date batch by batch, with exact distinct counts.

A ledger holds, per key, sums, maxima and numbers of distinct members (the
sessions of a user, the users of a device).  A batch adds two small tables: the
members that no earlier batch had for their key, found by an anti-join against
the members stored so far, and the key's totals with the number of those new
members.  Totals of all batches then simply add up, so reading a ledger never
touches raw events or members, and a batch reads only the member folders
(``bucket``) that its own members fall in.

Both tables lie in a folder of the run that wrote them, and count only once a
commit names that run.  Commits are numbered files written once, in order: a
reader sees a batch in whole or not at all; a batch that is already committed is
left alone when it is replayed; a run that died before its commit is never read;
and of two writers the later one finds the number taken and computes anew.
Every ``fold_every`` batches all runs become one, and the runs they replace are
removed one fold later, when no reader can still be on them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.sinks import files

MEMBERS, TOTALS = "members", "totals"
BUCKETS = 64


def hashed(*columns: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("string")


@dataclass(frozen=True)
class Ledger:
    """``keys`` and ``member`` with their types; ``sums`` and ``peaks`` of every
    key; ``levels`` names the counts of members by their greatest level (0: seen,
    1: also reached the first step, ...).  ``bucket`` gives a folder name for a
    row of members, ``total_bucket`` for a row of totals."""

    name: str
    keys: Mapping[str, str]
    member: str
    levels: tuple[str, ...]
    sums: tuple[str, ...]
    peaks: Mapping[str, str] = field(default_factory=dict)
    bucket: Callable[[], Column] | None = None
    total_bucket: Callable[[], Column] | None = None
    fold_every: int = 50

    def schema(self, table: str) -> T.StructType:
        keys = ", ".join(f"`{k}` {t}" for k, t in self.keys.items())
        if table == MEMBERS:
            own = "member string, level int"
        else:
            own = ", ".join([*(f"`{c}` bigint" for c in (*self.sums, *self.levels)), *(f"`{c}` {t}" for c, t in self.peaks.items())])
        return T.StructType.fromDDL(f"{keys}, {own}, run string, bucket string")


@dataclass(frozen=True)
class State:
    """What the commits say: the runs to read, per stream the ranges of batches
    that are in, and the caller's mark."""

    seq: int = 0
    runs: tuple[str, ...] = ()
    done: Mapping[str, list] = field(default_factory=dict)
    mark: int | None = None
    replaced: tuple[str, ...] = ()
    since_fold: int = 0

    def has(self, stream: str, batch_id: int) -> bool:
        return any(lo <= batch_id <= hi for lo, hi in self.done.get(stream, ()))


def _with_batch(ranges: list, batch_id: int) -> list:
    merged: list = []
    for lo, hi in sorted([*ranges, [batch_id, batch_id]]):
        if merged and lo <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return merged


def _home(root: str, ledger: Ledger) -> str:
    return f"{root.rstrip('/')}/_ledgers/{ledger.name}"


def _commits(spark: SparkSession, root: str, ledger: Ledger) -> list[str]:
    return sorted(files.glob(spark, f"{_home(root, ledger)}/commits/*"))


def read_state(spark: SparkSession, root: str, ledger: Ledger) -> State:
    """The state after the newest commit.  A commit holds the whole state, so one
    file is read."""
    found = _commits(spark, root, ledger)
    if not found:
        return State()
    said = json.loads(files.read_text(spark, found[-1]))
    return State(said["seq"], tuple(said["runs"]), said["done"], said["mark"], tuple(said["replaced"]), said["since_fold"])


def _commit(spark: SparkSession, root: str, ledger: Ledger, state: State) -> bool:
    """Whether ``state`` became commit number ``state.seq``."""
    text = json.dumps({"seq": state.seq, "runs": state.runs, "done": state.done, "mark": state.mark, "replaced": state.replaced,
                       "since_fold": state.since_fold, "writer": uuid.uuid4().hex})
    return files.write_once(spark, f"{_home(root, ledger)}/commits/{state.seq:012d}", text) == text


def stored_table(spark: SparkSession, root: str, ledger: Ledger, state: State, table: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of one of the ledger's tables that ``state`` counts."""
    schema = schema or ledger.schema(table)
    base = f"{_home(root, ledger)}/{table}"
    paths = [p for p in (f"{base}/run={run}" for run in state.runs) if files.path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _write(df: DataFrame, root: str, ledger: Ledger, table: str, run: str, bucket: Column) -> None:
    df.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{_home(root, ledger)}/{table}/run={run}")


def _merged_members(members: DataFrame, ledger: Ledger) -> DataFrame:
    return members.groupBy(*ledger.keys, "member").agg(F.max("level").alias("level"))


def _merged_totals(totals: DataFrame, ledger: Ledger) -> DataFrame:
    return totals.groupBy(*ledger.keys).agg(*[F.sum(c).alias(c) for c in (*ledger.sums, *ledger.levels)], *[F.max(c).alias(c) for c in ledger.peaks])


def read_totals(spark: SparkSession, root: str, ledger: Ledger, state: State | None = None, where: Column | None = None) -> DataFrame:
    """One exact row per key over all committed batches: keys, sums, levels, peaks.
    ``where`` may use ``bucket`` to open only some folders."""
    state = state or read_state(spark, root, ledger)
    totals = stored_table(spark, root, ledger, state, TOTALS)
    return _merged_totals(totals if where is None else totals.filter(where), ledger)


def apply_batch(spark: SparkSession, root: str, ledger: Ledger, rows: DataFrame, stream: str, batch_id: int,
                mark: Callable[[State], int | None] | None = None,
                extras: Callable[[State, DataFrame], Mapping[str, DataFrame]] | None = None,
                folds: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None) -> bool:
    """Add a batch; False if it is in already.

    ``rows`` has the keys, the member column, ``level`` (int; 0 where absent),
    sums and peaks, in any grain; a NULL key is a key, a NULL member none.
    ``mark`` gives the mark of the new state, ``extras`` more tables (name ->
    DataFrame with a ``bucket``) that become visible with the batch, from the
    state before and the batch's own totals; ``folds`` is passed to :func:`fold`.
    """
    missing = {*ledger.keys, ledger.member, *ledger.sums, *ledger.peaks} - set(rows.columns)
    if missing:
        raise ValueError(f"ledger {ledger.name}: the rows lack {sorted(missing)}")
    level = F.max("level") if "level" in rows.columns else F.lit(0)
    # One row per key and member: a hot key or member is reduced before it moves.
    rows = rows.groupBy(*ledger.keys, F.col(ledger.member).cast("string").alias("member")).agg(
        level.cast("int").alias("level"), *[F.sum(c).cast("bigint").alias(c) for c in ledger.sums], *[F.max(c).alias(c) for c in ledger.peaks])
    rows = rows.withColumn("bucket", ledger.bucket()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # folders, of which there are few
        while True:
            state = read_state(spark, root, ledger)
            if state.has(stream, batch_id):
                return False
            if _attempt(spark, root, ledger, rows, touched, state, stream, batch_id, mark, extras):
                if state.since_fold + 1 >= ledger.fold_every:
                    fold(spark, root, ledger, folds)
                return True
    finally:
        rows.unpersist()


def _attempt(spark, root, ledger, rows, touched, state, stream, batch_id, mark, extras) -> bool:
    run = f"{stream}-{batch_id}-{uuid.uuid4().hex[:12]}"
    known = _merged_members(stored_table(spark, root, ledger, state, MEMBERS).filter(F.col("bucket").isin(touched)), ledger)
    known = known.select(*[F.col(k).alias(f"_k_{k}") for k in ledger.keys], F.col("member").alias("_m"), F.col("level").alias("_known"))
    same = F.col("member") == F.col("_m")
    for k in ledger.keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    before = F.coalesce("_known", F.lit(-1))
    joined = rows.join(known, same, "left").select(*rows.columns, before.alias("_before")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fresh = joined.filter(F.col("member").isNotNull() & (F.col("level") > F.col("_before")))
        _write(fresh.select(*ledger.keys, "member", "level"), root, ledger, MEMBERS, run, ledger.bucket())
        reached = [F.count_if(F.col("member").isNotNull() & (F.col("level") >= i) & (F.col("_before") < i)).alias(c) for i, c in enumerate(ledger.levels)]
        totals = joined.groupBy(*ledger.keys).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ledger.sums], *reached, *[F.max(c).alias(c) for c in ledger.peaks])
        _write(totals, root, ledger, TOTALS, run, ledger.total_bucket())
        if extras is not None:
            own = spark.read.schema(ledger.schema(TOTALS)).option("basePath", f"{_home(root, ledger)}/{TOTALS}").parquet(f"{_home(root, ledger)}/{TOTALS}/run={run}")
            for table, df in extras(state, own).items():
                df.write.partitionBy("bucket").parquet(f"{_home(root, ledger)}/{table}/run={run}")
    finally:
        joined.unpersist()
    done = {**state.done, stream: _with_batch(state.done.get(stream, []), batch_id)}
    new = State(state.seq + 1, (*state.runs, run), done, mark(state) if mark else state.mark, state.replaced, state.since_fold + 1)
    return _commit(spark, root, ledger, new)


def fold(spark: SparkSession, root: str, ledger: Ledger, folds: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None) -> bool:
    """Make one run of all runs; False if another writer came first.  ``folds``
    says how further tables are folded (name -> DataFrame -> DataFrame); those not
    named are kept as they are."""
    state = read_state(spark, root, ledger)
    if len(state.runs) < 2:
        return False
    run = f"fold-{state.seq}-{uuid.uuid4().hex[:12]}"
    members = _merged_members(stored_table(spark, root, ledger, state, MEMBERS), ledger)
    _write(members, root, ledger, MEMBERS, run, ledger.bucket())
    _write(_merged_totals(stored_table(spark, root, ledger, state, TOTALS), ledger), root, ledger, TOTALS, run, ledger.total_bucket())
    for table in sorted({p.rsplit("/", 2)[-2] for p in files.glob(spark, f"{_home(root, ledger)}/*/run=*")} - {MEMBERS, TOTALS}):
        paths = [p for p in (f"{_home(root, ledger)}/{table}/run={r}" for r in state.runs) if files.path_exists(spark, p)]
        if paths:
            df = spark.read.option("basePath", f"{_home(root, ledger)}/{table}").option("mergeSchema", "true").parquet(*paths).drop("run")
            df = df.withColumn("bucket", F.col("bucket").cast("string"))
            df = (folds or {}).get(table, lambda d: d)(df)
            df.repartition("bucket").write.partitionBy("bucket").parquet(f"{_home(root, ledger)}/{table}/run={run}")
    new = State(state.seq + 1, (run,), state.done, state.mark, state.runs, 0)
    if not _commit(spark, root, ledger, new):
        return False
    # What the fold before replaced has no reader any more.
    for old in state.replaced:
        for path in files.glob(spark, f"{_home(root, ledger)}/*/run={old}"):
            files.delete(spark, path)
    for path in _commits(spark, root, ledger)[:-2 * ledger.fold_every]:
        files.delete(spark, path)
    return True
