"""Removal of repeated word windows, by level-wise doubling.

A window of ``size`` words goes from a document if a document with a smaller id
has it too.  Level 1 looks at runs of half that length, and only at one run per
window: the run of least hash among those inside it (equal windows choose equal
runs).  Only windows around a run that repeats are extended to the full length.
Neighbouring windows that chose the same run travel as one context, and only
where a run was met in different contexts are its windows compared singly.

Hot runs and windows are resolved as far as possible inside each batch of
documents, so a passage that a third of all documents share sends a few rows
per batch into one task, not one per document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import _powers, flat, mix, shingles, slices, stage, words_of

HEAVY = 32                  # contexts of one run in a batch that settle that its windows are compared singly
CELLS = 1 << 20             # of document ids; a broadcast table has no more rows
OPEN, GONE, MARK, COMPARE = 0, 1, 2, 3
LAST = (1 << 63) - 1        # a NULL id counts as the largest
_U = np.uint64
RUN = "kind tinyint, run bigint, context bigint, doc bigint, at bigint"


def span_keys(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the ranges ``[start, end)`` of hash values, by prefix sums."""
    up, down, _ = _powers(len(values) + 1)
    pre = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[:len(values)], out=pre[1:])
    return (pre[end] - pre[start]) * down[start]


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """For every start the place of the least of ``width`` keys from there; of
    equal keys (in their upper 32 bits) the first."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    v = (keys & _U(0xFFFFFFFF00000000)) | np.arange(len(keys), dtype=_U)
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:len(v) - have], v[have:])
        have *= 2
    v = np.minimum(v[:n], v[width - have:width - have + n])
    return (v & _U(0xFFFFFFFF)).astype(np.int64)


def least_of(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by ``keys`` and ``doc``; group number and least doc of each, in that order."""
    order = np.lexsort((doc, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    return order, group, doc[order][new][group] if len(order) else doc[order]


class Contexts:
    """The chosen runs of some documents and the context of each."""

    def __init__(self, words: np.ndarray, first: np.ndarray, size: int):
        half = (size + 1) // 2
        runs = shingles(words, half)
        chosen = window_minima(runs, size - half + 1)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))[:len(chosen)]
        start = np.flatnonzero(np.arange(len(chosen)) + size <= first[row + 1])
        chosen, row = chosen[start], row[start]
        new = np.ones(len(start), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
        self.begin = start[new]                                        # first window of each context
        self.more = np.diff(np.append(np.flatnonzero(new), len(start))) - 1  # windows after it
        self.row, at = row[new], chosen[new]
        self.run = runs[at]
        key = span_keys(words, self.begin, self.begin + self.more + size)
        key += (at - self.begin).astype(_U) * _U(0xA24BAED4963EE407) + self.more.astype(_U) * _U(0x9FB21C651E98DF25)
        self.context = mix(key)


def _level_one(size: int):
    """Rows of runs and contexts; what a batch settles by itself is marked."""
    def find(batches):
        import pyarrow as pa

        for batch in batches:
            data, off = flat(batch.column(1))
            ids = batch.column(0).cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)
            marks = batch.column(2).to_numpy(zero_copy_only=False)
            for lo, hi in slices(off):
                part, begin = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                words, first = words_of(part, begin)
                c = Contexts(words, first, size)
                doc = ids[lo:hi][c.row]
                at = ((c.begin - first[c.row]) << 32) | (marks[lo:hi][c.row] << 8) | c.more
                order, group, least = least_of([c.run, c.context], doc)
                kind = np.where(doc[order] > least, GONE, OPEN).astype(np.int8)
                run, context = c.run[order].copy(), c.context[order]
                lead = np.flatnonzero(np.diff(group, prepend=-1))
                if len(lead):
                    # contexts per run; the leads of heavy runs are compared singly, two marks stand for them
                    new = np.append(True, run[lead][1:] != run[lead][:-1])
                    head = np.flatnonzero(new)
                    many = np.diff(np.append(head, len(lead))) >= HEAVY
                    heavy = np.isin(run, run[lead][head[many]]) & (kind == OPEN)
                    kind[heavy] = COMPARE
                    mark = np.repeat(lead[head[many]], 2)
                else:
                    mark = lead
                settled = (kind == GONE) | (kind == COMPARE)
                home = run[mark]
                run[settled] = mix(doc[order][settled].astype(_U) + at[order][settled].astype(_U))  # anywhere
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([kind, np.full(len(mark), MARK, np.int8)])),
                    pa.array(np.concatenate([run, home]).view(np.int64)),
                    pa.array(np.concatenate([context, np.arange(len(mark), dtype=_U) % _U(2)]).view(np.int64)),
                    pa.array(np.concatenate([doc[order], np.full(len(mark), LAST)])),
                    pa.array(np.concatenate([at[order], np.zeros(len(mark), np.int64)]))],
                    names=["kind", "run", "context", "doc", "at"])

    return find


def _level_two(size: int):
    """Rows of single windows, for the contexts listed with each document."""
    def find(batches):
        import pyarrow as pa

        for batch in batches:
            data, off = flat(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            for lo, hi in slices(off):
                words, first = words_of(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                part = lists.slice(lo, hi - lo)
                at = part.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(hi - lo), np.diff(part.offsets.to_numpy(zero_copy_only=False)))
                more = at & 0xFF
                start = np.repeat(at >> 32, more + 1) + np.arange((more + 1).sum()) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
                row, mark = np.repeat(row, more + 1), np.repeat(at & 0xFFFFFF00, more + 1)
                begin = first[row] + start
                key = mix(span_keys(words, begin, begin + size))
                doc = ids[lo:hi][row]
                order, _, least = least_of([key], doc)
                gone = doc[order] > least
                own = (start << 32 | mark)[order]
                run = np.where(gone, mix(own.astype(_U) + doc[order].astype(_U)), key[order])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.where(gone, GONE, OPEN).astype(np.int8)), pa.array(run.view(np.int64)),
                    pa.array(np.zeros(len(own), np.int64)), pa.array(doc[order]), pa.array(own)],
                    names=["kind", "run", "context", "doc", "at"])

    return find


def _cut(size: int, names: list[str]):
    """Texts without the words of the listed windows."""
    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            lists = batch.column(batch.schema.get_field_index("__at")).to_pylist()
            n_words, removed, spans, kept = [], [], [], []
            for text, at in zip(texts, lists, strict=True):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if at:
                    found = np.unique(np.array(at, np.int64))
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, found >> 32, 1)
                    np.add.at(step, (found >> 32) + (found & 0xFF) + size, -1)
                    gone = np.cumsum(step)[:-1] > 0
                    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                    removed.append(int(gone.sum()))
                    words = [words[k] for k in np.flatnonzero(~gone)]
                else:
                    spans.append([])
                    removed.append(0)
                kept.append(b" ".join(words).decode())
            keep = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string())],
                [*names, "n_words", "n_removed", "spans", "kept"])

    return cut


def _keyed(docs: DataFrame) -> DataFrame:
    """With ``__doc`` (NULL as the largest id) and ``__mark``, 24 bits of the text
    that tell apart rows alike in id."""
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 24))
    return docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))).withColumn("__mark", mark)


def _cell(doc: str, mark: str) -> F.Column:
    return F.pmod(F.xxhash64(doc, mark), F.lit(CELLS))


def _listed(rows: DataFrame) -> DataFrame:
    """Per document the places of its rows."""
    rows = rows.withColumn("m", F.call_function("shiftright", "at", F.lit(8)).bitwiseAND(F.lit(0xFFFFFF)))
    return rows.groupBy("doc", "m").agg(F.sort_array(F.collect_list("at")).alias("__at")).withColumn("c", _cell("doc", "m"))


def remove_windows(docs: DataFrame, size: int = 13, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus n_words, n_removed, ``spans`` (word
    places, maximal) and ``kept`` (the other words, joined by one space).

    A word goes if a window of ``size`` words over it also starts in a document
    with a smaller ``doc_id``, judged on the input.  Repeats inside one document,
    or in rows with equal ids, do not count; a NULL id is larger than any other.
    NULL and empty texts have no words; texts shorter than a window keep all.
    Columns of ``docs`` with those names are replaced; an empty table gives no rows.
    """
    if size < 2:
        raise ValueError("a window has two words at least")
    out = ("n_words", "n_removed", "spans", "kept")
    docs = docs.drop(*out)
    names = [c for c in (keep or docs.columns) if c not in out]
    rows = _keyed(docs)

    runs = rows.select("__doc", "text", "__mark").mapInArrow(_level_one(size), RUN).repartition("run")
    same = Window.partitionBy("run", "context")
    here = Window.partitionBy("run")
    runs = (
        runs.withColumn("least", F.min("doc").over(same))
        .withColumn("many", F.min("context").over(here) != F.max("context").over(here))
        .withColumn("kind", F.when((F.col("kind") == OPEN) & (F.col("doc") > F.col("least")), GONE)
                    .when((F.col("kind") == OPEN) & F.col("many"), COMPARE).otherwise(F.col("kind")))
        .filter(F.col("kind").isin(GONE, COMPARE)).select("kind", "doc", "at")
    )
    runs = stage(runs, "window-runs")

    todo = stage(_listed(runs.filter(F.col("kind") == COMPARE)), "window-compare")
    # At most CELLS rows, whatever the input.
    some = rows.join(F.broadcast(todo.select("c").distinct()), _cell("__doc", "__mark") == F.col("c"), "left_semi")
    some = some.select("__doc", "__mark", "text").dropDuplicates(["__doc", "__mark"])
    some = some.join(todo, (F.col("__doc") == F.col("doc")) & (F.col("__mark") == F.col("m")))
    single = some.select("__doc", "text", "__at").mapInArrow(_level_two(size), RUN).repartition("run")
    single = single.withColumn("least", F.min("doc").over(here)).filter((F.col("kind") == GONE) | (F.col("doc") > F.col("least")))
    gone = runs.filter(F.col("kind") == GONE).select("doc", "at").unionAll(single.select("doc", "at"))
    gone = stage(_listed(gone), "window-gone")

    kind = T.ArrayType(T.LongType())
    cells = F.broadcast(gone.select("c").distinct())
    touched = _cell("__doc", "__mark") == F.col("c")
    clean = rows.join(cells, touched, "left_anti").withColumn("__at", F.lit(None).cast(kind))
    hit = rows.join(cells, touched, "left_semi")
    hit = hit.join(gone, (F.col("__doc") == F.col("doc")) & (F.col("__mark") == F.col("m")), "left")
    used = [*dict.fromkeys([*names, "text"])]
    schema = T.StructType([*[docs.schema[c] for c in names],
                           *T.StructType.fromDDL("n_words bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept string").fields])
    return clean.select(*used, "__at").mapInArrow(_cut(size, names), schema).unionAll(
        hit.select(*used, "__at").mapInArrow(_cut(size, names), schema))
