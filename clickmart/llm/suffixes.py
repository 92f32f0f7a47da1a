"""Removal of repeated byte strings, by a logarithmic family of suffix arrays.

Suffixes are sampled: in every string of ``length`` bytes the run of RUN bytes
with the least hash is chosen, and the suffix that begins there is kept.  Equal
strings choose equal runs, so a repeated string is found through two kept
suffixes with one beginning.  Strings next to each other that chose the same
run travel together; the bytes they cover are the suffix's context.

The suffix array of a batch of documents is its kept suffixes in the order of
their first bytes.  A new batch is sorted together with the existing levels
(each sorted already): suffixes with equal contexts lie side by side and are
repeated as a whole; those that agree in their run only are compared byte for
byte afterwards.  Then the batch becomes a level, and levels of equal size are
merged, so that n batches leave at most log2(n) + 1 levels.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.common import flat, mix, scratch, slices, span_hashes, stage
from clickmart.llm.windows import window_minima

RUN = 64                    # bytes that two suffixes have in common at least to be compared
PIECE = 1 << 20             # bytes sampled at once; longer texts in pieces
HEAVY = 32                  # contexts of one run in a piece that settle that they are compared
TOGETHER = 4_096            # contexts of one run that one task compares; more are compared string by string
CELLS = 1 << 20             # of documents; a broadcast table has no more rows
BATCHES = 4
OPEN, GONE, MARK, COMPARE = 0, 1, 2, 3
MARK_BITS, MORE_BITS = 22, 10  # of a place: start << 32 | mark of the text << 10 | strings after the first
_U = np.uint64
ENTRY = "kind tinyint, head bigint, run bigint, context bigint, doc bigint, at bigint"


def sample(data: np.ndarray, off: np.ndarray, length: int):
    """The kept suffixes of some texts: row, place of the run, first string that
    chose it and how many more follow."""
    run = min(RUN, length)
    if len(data) < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, _U)
    at = np.arange(len(data) - run + 1)
    runs = span_hashes(data, at, at + run)
    chosen = window_minima(runs, length - run + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(chosen)]
    start = np.flatnonzero(np.arange(len(chosen)) + length <= off[row + 1])
    chosen, row = chosen[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    lead = np.flatnonzero(new)
    more = np.diff(np.append(lead, len(start))) - 1
    return row[lead], chosen[lead], start[lead], more, runs[chosen[lead]]


def _pieces(off: np.ndarray, length: int):
    """Row ranges to be sampled at once, with their bytes; a long row in pieces
    that overlap, so that every string lies in one of them."""
    for lo, hi in slices(off, PIECE):
        a, b = int(off[lo]), int(off[hi])
        while b - a > 2 * PIECE:
            yield lo, lo + 1, a, a + PIECE + length - 1
            a += PIECE
        yield lo, hi, a, b


def _entries(length: int):
    def find(batches):
        import pyarrow as pa

        for batch in batches:
            data, off = flat(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            marks = batch.column(2).to_numpy(zero_copy_only=False)
            for lo, hi, a, b in _pieces(off, length):
                part = data[a:b]
                begin = off[lo:hi + 1] - a if hi > lo + 1 else np.array([0, b - a])
                row, place, start, more, run = sample(part, begin, length)
                key = span_hashes(part, start, start + more + length)
                key += (place - start).astype(_U) * _U(0xA24BAED4963EE407) + more.astype(_U) * _U(0x9FB21C651E98DF25)
                context = mix(key)
                head = np.zeros(len(place), _U)
                for k in range(8):
                    head = head << _U(8) | part[place + k].astype(_U)
                doc = ids[lo:hi][row]
                first = a + start - off[lo:hi][row]
                at = (first << 32) | (marks[lo:hi][row] << MORE_BITS) | more
                # Equal contexts here: all are repeated, one stays to meet others.
                order = np.lexsort((at, doc, context, run))
                same = (np.diff(run[order]) == 0) & (np.diff(context[order]) == 0)
                head_of = np.append(True, ~same) if len(order) else np.zeros(0, bool)
                twice = np.zeros(len(order), bool)
                twice[1:] |= same
                twice[:-1] |= same
                kind = np.where(head_of, OPEN, GONE).astype(np.int8)
                run, context, head, doc, at = run[order], context[order], head[order], doc[order], at[order]
                again = np.flatnonzero(head_of & twice)  # the one that stays is repeated too
                lead = np.flatnonzero(head_of)
                top = np.flatnonzero(np.append(True, run[lead][1:] != run[lead][:-1])) if len(lead) else lead
                many = np.diff(np.append(top, len(lead))) >= HEAVY
                heavy = np.isin(run, run[lead[top[many]]]) & (kind == OPEN)
                kind[heavy] = COMPARE
                mark = np.repeat(lead[top[many]], 2)
                rows = [np.concatenate([x, x[again], x[mark]]) for x in (head, run, context, doc, at)]
                rows[2][len(kind) + len(again):] = np.arange(len(mark), dtype=_U) % _U(2)
                kinds = np.concatenate([kind, np.full(len(again), GONE, np.int8), np.full(len(mark), MARK, np.int8)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds), pa.array((rows[0] ^ _U(1 << 63)).view(np.int64)), pa.array(rows[1].view(np.int64)),
                     pa.array(rows[2].view(np.int64)), pa.array(rows[3]), pa.array(rows[4])],
                    names=["kind", "head", "run", "context", "doc", "at"])

    return find


class Family:
    """The levels, and what scanning each batch against them has found."""

    def __init__(self, spark):
        self.spark, self.levels, self.found = spark, [], []

    def add(self, batch: DataFrame, insert: bool = True) -> None:
        """``batch``: entries of new documents.  Scan them against all levels, then
        make them a level and merge levels of equal size."""
        settled = F.col("kind").isin(GONE, COMPARE)
        self.found.append(batch.filter(settled).select("kind", "run", "doc", "at"))
        new = batch.filter(~settled)
        rows = new.withColumn("old", F.lit(False))
        for _, level in self.levels:
            rows = rows.unionByName(level.withColumn("old", F.lit(True)))
        rows = rows.repartition("run")
        same, here = Window.partitionBy("run", "context"), Window.partitionBy("run")
        rows = (
            rows.withColumn("n", F.count(F.lit(1)).over(same))
            .withColumn("many", F.min("context").over(here) != F.max("context").over(here))
            .withColumn("news", ~F.min("old").over(here)).filter("news and kind <> 2")
        )
        rows = rows.withColumn("kind", F.when(F.col("n") > 1, GONE).otherwise(OPEN).cast("tinyint"))
        said = F.array(F.when(F.col("kind") == GONE, F.lit(GONE).cast("tinyint")), F.when(F.col("many"), F.lit(COMPARE).cast("tinyint")))
        said = F.explode(F.filter(said, lambda x: x.isNotNull()))
        self.found.append(stage(rows.select(said.alias("kind"), "run", "doc", "at"), "suffix-found"))
        if insert:
            level, size = new, 1
            while self.levels and self.levels[-1][0] == size:
                level, size = level.unionByName(self.levels.pop()[1]), size * 2
            # One suffix of each context stays; order by the first bytes.
            level = level.groupBy("kind", "head", "run", "context").agg(F.min(F.struct("doc", "at")).alias("p"))
            level = level.select("kind", "head", "run", "context", "p.doc", "p.at")
            level = level.repartitionByRange("head", "run").sortWithinPartitions("head", "run", "context")
            self.levels.append((size, stage(level, "suffix-level")))

    def results(self) -> DataFrame:
        out = self.found[0]
        for more in self.found[1:]:
            out = out.unionByName(more)
        return out


def _strings(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts' bytes: hash, context and place of every string in them."""
    n = np.diff(off) - length + 1
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = off[:-1][owner] + place
    return span_hashes(data, begin, begin + length), owner, place


def _contexts(length: int):
    """run, doc, at, bytes of the contexts listed with each document."""
    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            data, off = flat(batch.column(1))
            ids, lists = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            run, doc, place, body = [], [], [], []
            held = 0

            def out():
                return pa.RecordBatch.from_pydict({"run": pa.array(run, pa.int64()), "doc": pa.array(doc, pa.int64()),
                                                   "at": pa.array(place, pa.int64()), "body": pa.array(body, pa.binary())})

            for k, listed in enumerate(lists):
                for c in listed:
                    start = off[k] + (c["at"] >> 32)
                    body.append(data[start:start + (c["at"] & (1 << MORE_BITS) - 1) + length].tobytes())
                    run.append(c["run"])
                    doc.append(ids[k])
                    place.append(c["at"])
                    held += len(body[-1])
                if held > 4 * PIECE:
                    yield out()
                    run, doc, place, body, held = [], [], [], [], 0
            yield out()

    return cut


def _ranges(owner: np.ndarray, place: np.ndarray, doc: np.ndarray, at: np.ndarray):
    """Runs of consecutive places of one context as (doc, at)."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.append(True, (np.diff(owner) != 0) | (np.diff(place) != 1))
    lead = np.flatnonzero(new)
    more = np.diff(np.append(lead, len(owner))) - 1
    base = at[owner[lead]] >> MORE_BITS << MORE_BITS
    return doc[owner[lead]], base + (place[lead] << 32) + more


def _compare(length: int):
    """Contexts sorted by run: strings that two of them have, run by run."""
    def compare(batches):
        import pyarrow as pa

        rest = None
        for batch in batches:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            run = rest.column(0).to_numpy(zero_copy_only=False)
            whole = int(np.searchsorted(run == run[-1], True)) if len(run) else 0  # the last run may go on
            if whole:
                yield repeated(rest.slice(0, whole))
                rest = rest.slice(whole)
        if rest is not None and rest.num_rows:
            yield repeated(rest)

    def repeated(rows):
        import pyarrow as pa

        body = rows.column(3).cast(pa.large_binary())
        size = np.array([len(b) for b in body.to_pylist()], np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        doc, at = (rows.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        run = rows.column(0).to_numpy(zero_copy_only=False)
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(run) != 0)), len(run))
        data = np.frombuffer(b"".join(body.to_pylist()), np.uint8)
        docs, places = [], []
        lo = 0
        while lo < len(run):  # as many runs at once as fit
            hi = int(cuts[max(np.searchsorted(cuts, lo, "right"), np.searchsorted(ends[cuts], ends[lo] + PIECE, "right") - 1)])
            key, owner, place = _strings(data[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo], length)
            _, back, count = np.unique(key, return_inverse=True, return_counts=True)
            hit = count[back] > 1
            d, a = _ranges(owner[hit], place[hit], doc[lo:hi], at[lo:hi])
            docs.append(d)
            places.append(a)
            lo = hi
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(places))], names=["doc", "at"])

    return compare


def _single(length: int):
    """Every string of the contexts: hash, document, place."""
    def split(batches):
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                body = part.column(3).to_pylist()
                ends = np.concatenate([[0], np.cumsum([len(b) for b in body])]).astype(np.int64)
                key, owner, place = _strings(np.frombuffer(b"".join(body), np.uint8), ends, length)
                doc, at = (part.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
                own = (at[owner] >> MORE_BITS << MORE_BITS) + (place << 32)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc[owner]), pa.array(own)], names=["key", "doc", "at"])

    return split


def _cut(length: int, names: list[str]):
    """Texts without the bytes of the listed strings."""
    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            data, off = flat(batch.column(batch.schema.get_field_index("text")))
            lists = batch.column(batch.schema.get_field_index("__at")).to_pylist()
            removed, spans, kept = [], [], []
            for k, at in enumerate(lists):
                text = data[off[k]:off[k + 1]]
                if not at:
                    removed.append(0)
                    spans.append([])
                    kept.append(text.tobytes())
                    continue
                found = np.array(at, np.int64)
                step = np.zeros(len(text) + 1, np.int64)
                np.add.at(step, found >> 32, 1)
                np.add.at(step, (found >> 32) + (found & (1 << MORE_BITS) - 1) + length, -1)
                gone = np.cumsum(step)[:-1] > 0
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                removed.append(int(gone.sum()))
                kept.append(text[~gone].tobytes())
            keep = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(np.diff(off)), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary())],
                [*names, "n_bytes", "n_removed", "spans", "kept"])

    return cut


def _cell(doc: str, mark: str) -> F.Column:
    return F.pmod(F.xxhash64(doc, mark), F.lit(CELLS))


def _listed(rows: DataFrame, what) -> DataFrame:
    """Per document what its rows say."""
    mark = F.call_function("shiftright", "at", F.lit(MORE_BITS)).bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    rows = rows.withColumn("m", mark).groupBy("doc", "m").agg(F.collect_set(what).alias("__at"))
    return rows.withColumn("c", _cell("doc", "m"))


def remove_repeats(docs: DataFrame, length: int = 400, keep: list[str] | None = None, batches: int = BATCHES) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus n_bytes, n_removed, ``spans`` (byte
    places, maximal) and ``kept`` (binary: the other bytes of the UTF-8 text).

    A byte goes if a string of ``length`` bytes over it also starts anywhere else
    in the table, the same text included; strings do not cross texts, may
    overlap, and are judged on the input.  NULL text is empty; shorter texts keep
    all; repeated rows repeat each other, also with equal or NULL ids.  Columns
    of ``docs`` with those names are replaced; an empty table gives no rows.
    """
    if not 8 <= length < 1 << MORE_BITS:
        raise ValueError("length must be 8 to 1023 bytes")
    out = ("n_bytes", "n_removed", "spans", "kept")
    docs = docs.drop(*out)
    names = [c for c in (keep or docs.columns) if c not in out]
    # Rows alike in id and text stand for each other; 22 bits of the text tell rows alike in id apart.
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << MARK_BITS))
    rows = docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))).withColumn("__mark", mark)

    found = rows.select("__doc", "text", "__mark").mapInArrow(_entries(length), ENTRY)
    found = found.withColumn("batch", F.pmod(F.xxhash64("doc", F.lit(3)), F.lit(batches)).cast("int"))
    path = scratch(docs.sparkSession, "suffixes")
    found.write.option("compression", "zstd").partitionBy("batch").parquet(path)
    entries = docs.sparkSession.read.schema(found.schema).parquet(path)
    family = Family(docs.sparkSession)
    for b in range(batches):
        family.add(entries.filter(F.col("batch") == b).drop("batch"), insert=b + 1 < batches)
    results = family.results()

    # What agrees in its run only: compare the bytes.
    todo = results.filter(F.col("kind") == COMPARE).select("run", "doc", "at").distinct()
    size = todo.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    todo = stage(_listed(todo, F.struct("run", "at")), "suffix-compare")
    crowded = size.filter(F.col("n") > TOGETHER).select("run")
    # At most CELLS rows, whatever the input.
    some = rows.join(F.broadcast(todo.select("c").distinct()), _cell("__doc", "__mark") == F.col("c"), "left_semi")
    some = some.select("__doc", "__mark", "text").dropDuplicates(["__doc", "__mark"])
    some = some.join(todo, (F.col("__doc") == F.col("doc")) & (F.col("__mark") == F.col("m")))
    contexts = some.select("__doc", "text", "__at").mapInArrow(_contexts(length), "run bigint, doc bigint, at bigint, body binary")
    contexts = stage(contexts, "suffix-contexts")
    few = contexts.join(crowded, "run", "left_anti").repartition("run").sortWithinPartitions("run")
    gone = few.select("run", "doc", "at", "body").mapInArrow(_compare(length), "doc bigint, at bigint")
    many = contexts.join(crowded, "run", "left_semi").select("run", "doc", "at", "body")
    many = many.mapInArrow(_single(length), "key bigint, doc bigint, at bigint")
    more = many.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = gone.unionAll(many.join(more, "key", "left_semi").select("doc", "at"))
    gone = stage(_listed(gone.unionAll(results.filter(F.col("kind") == GONE).select("doc", "at")), F.col("at")), "suffix-gone")

    cells = F.broadcast(gone.select("c").distinct())
    touched = _cell("__doc", "__mark") == F.col("c")
    used = [*dict.fromkeys([*names, "text"])]
    clean = rows.join(cells, touched, "left_anti").withColumn("__at", F.lit(None).cast("array<bigint>"))
    hit = rows.join(cells, touched, "left_semi").join(gone, (F.col("__doc") == F.col("doc")) & (F.col("__mark") == F.col("m")), "left")
    schema = T.StructType([*[docs.schema[c] for c in names],
                           *T.StructType.fromDDL("n_bytes bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept binary").fields])
    return clean.select(*used, "__at").mapInArrow(_cut(length, names), schema).unionAll(
        hit.select(*used, "__at").mapInArrow(_cut(length, names), schema))
