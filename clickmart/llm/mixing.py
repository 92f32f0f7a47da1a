"""Mixing sources to target weights.

Every document gets a hash-random key.  Within a source the keys put the
documents in a random order that any run repeats; prefix sums of their sizes
in that order tell which documents lie below the source's budget.  The prefix
sums are built in three steps, so that no task ever holds a source: sums per
key cell (a cell is a source and a key prefix), running sums over the cells of
a coarser prefix, and a window over the documents of one cell.  A source with
a third of all rows is spread over ``16 ** FINE`` cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import WORD, stage

COARSE, FINE = 2, 4  # hexadecimal digits of the key: 256 and 65,536 cells a source


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _targets(sources: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source: its target and budget.  The table has a row per
    source, not per document; its windows run in one task.

    Sources at their limit form a prefix in the order of limit / weight, so
    the repeated resharing of the excess ends where running sums in that
    order say: the k-th source is at its limit if what the sources before it
    leave, shared by weight, gives it as much or more.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.col("share") * F.col("weight") >= F.col("limit")
    level = F.max(F.when(~full, F.col("share"))).over(every)
    return (
        sources.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("share", F.col("left") / F.sum("weight").over(onward))
        .withColumn("target", F.when(full, F.col("limit").cast("double")).otherwise(level * F.col("weight")))
        .select("source", "source_size", F.round("target", 6).alias("target"),
                F.least("limit", F.round("target").cast("bigint")).alias("budget"))
    )


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix",
                boundary: str = "cut") -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (double, words
    due to the row's source) and ``taken`` (words the mix takes from the row,
    repeats counted).

    Sources in code point order, NULL last, have the ``weights`` in turn.  They
    share the sum of all sizes by weight; a target stops at ``max_epochs`` times
    the source's size and the others share the excess.  A source's budget is its
    target rounded to words: whole epochs take every document, the rest of the
    budget takes documents in key order.  At ``boundary='cut'`` the document at
    the edge gives exactly the words still due; at ``'whole'`` it is taken whole
    if at least half of it lies below the budget, and ``taken`` is a multiple of
    ``size``.

    NULL or empty text has size 0 and ``taken`` 0.  NULL ids count as empty
    text in the key; rows alike in id are ordered by content, and rows alike in
    both are interchangeable.  An empty table gives no rows.  Columns of
    ``docs`` whose names are those of the result are replaced.
    """
    if boundary not in ("cut", "whole"):
        raise ValueError(f"boundary {boundary!r}")
    out = ("size", "source_size", "target", "taken")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    tie = F.xxhash64("text") if "text" in docs.columns else F.lit(0)  # here, so that no text is moved for its sake
    rows = (docs.drop(*out).withColumn("size", word_count()).withColumn("__key", key).withColumn("__tie", tie)
            .withColumn("__fine", F.substring("__key", 1, FINE)))
    cells = stage(rows.groupBy("source", "__fine").agg(F.sum("size").alias("__cell")), "mix-cells")

    coarse = cells.groupBy("source", F.substring("__fine", 1, COARSE).alias("__coarse")).agg(F.sum("__cell").alias("__sum"))
    exclusive = lambda *by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__sum").over(exclusive("source", order="__coarse")), F.lit(0))
    coarse = coarse.select(F.col("source").alias("__s"), F.col("__coarse").alias("__c"), start.alias("__from"))
    targets = _targets(cells.groupBy("source").agg(F.sum("__cell").alias("source_size")), weights, max_epochs)
    targets = targets.withColumnRenamed("source", "__t")
    inner = F.coalesce(F.sum("__cell").over(exclusive("source", "__coarse", order="__fine")), F.lit(0))
    cells = (
        cells.withColumn("__coarse", F.substring("__fine", 1, COARSE)).withColumn("__inner", inner)
        .join(coarse, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__coarse") == F.col("__c")))
        .join(targets, F.col("source").eqNullSafe(F.col("__t")))
        .select(F.col("source").alias("__s"), F.col("__fine").alias("__f"), (F.col("__from") + F.col("__inner")).alias("__start"),
                "source_size", "target", "budget")
    )
    in_cell = Window.partitionBy("source", "__fine").orderBy("__key", "doc_id", "size", "__tie")
    due = F.col("budget") - F.col("__epochs") * F.col("source_size") - F.col("__before")
    if boundary == "cut":
        part = F.greatest(F.lit(0), F.least("size", due))
    else:
        part = F.when(due * 2 >= F.col("size"), F.col("size")).otherwise(0)
    epochs = F.when(F.col("source_size") > 0, F.call_function("div", "budget", "source_size")).otherwise(0)
    kept = [c for c in docs.columns if c not in out]
    return (
        rows.join(cells, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__fine") == F.col("__f")))
        .withColumn("__before", F.col("__start") + F.sum("size").over(in_cell.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("__epochs", epochs)
        .withColumn("taken", (F.col("__epochs") * F.col("size") + part).cast("bigint"))
        .select(*kept, *out)
    )


def apply_mix(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as a ``boundary='whole'`` mix takes it,
    with the columns of the input."""
    copies = F.when(F.col("size") > 0, F.call_function("div", "taken", "size")).otherwise(0)
    return (
        mixed.withColumn("__copies", copies.cast("int")).filter("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .drop("__copy", "__copies", "size", "source_size", "target", "taken")
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS k,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
), s AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 3 * source_size AS cap,
         SUM(source_size) OVER () - COALESCE(SUM(3 * source_size) OVER (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         SUM(weight) OVER (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM s
), l AS (
  SELECT *, CAST(remaining AS DOUBLE) / CAST(weights AS DOUBLE) AS share FROM r
), t AS (
  SELECT source, source_size, cap, CASE WHEN share * weight >= cap THEN CAST(cap AS DOUBLE)
         ELSE MAX(CASE WHEN share * weight < cap THEN share END) OVER () * weight END AS target FROM l
), b AS (
  SELECT source, source_size, ROUND(target, 6) AS target, LEAST(cap, CAST(ROUND(target) AS BIGINT)) AS budget FROM t
), p AS (
  SELECT doc_id, source, size, SUM(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM d
)
SELECT p.doc_id, p.size, b.source_size, b.target,
       CAST(CASE WHEN b.source_size > 0 THEN (b.budget // b.source_size) * p.size
            + GREATEST(0, LEAST(p.size, b.budget % b.source_size - p.before)) ELSE 0 END AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""
