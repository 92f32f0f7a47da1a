"""Toxicity by nearest labelled examples.

A bounded sample of labelled rows gives the examples, and their texts all terms.
Documents and examples are TF-IDF vectors over all of these terms, with document
frequencies counted over all documents; a term weighs the more the further its
rows' share labelled 1 lies from the share of all, and none weighs nothing.  All
examples are compared: terms of many examples by a matrix product, the others by
posting lists, and what can be among the k best again in double precision, so
the k nearest are exact.  Their cosine-weighted votes, weighted back to the
labels' shares and damped towards the prior, are the score; the voters are the
evidence.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from functools import cached_property
from itertools import repeat

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --- bounds of the fitted sample and parameters ------------------------------
EXAMPLES = 6_000          # labelled rows per label at most
SMOOTH = 5.0              # rows of the labels' share that are added to a term's
FLOOR = 0.01              # added to the distance of a term's share from the labels'
NEIGHBOURS = 25
COMMON = 0.08             # share of examples that have a term of the matrix, at least
SLICE = 64                # documents a matrix product
DAMPING = 0.3             # votes of the prior, in cosines
# -----------------------------------------------------------------------------
ENTRY = np.dtype([("example", np.int32), ("weight", np.float32)])  # of a posting list
TOKEN = re.compile(r"[^\W_]+")
EVIDENCE = "array<struct<doc_id: bigint, cosine: double, label: int>>"


def terms_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def labelled(labels: DataFrame, label: str = "toxic", per_label: int = EXAMPLES) -> tuple[DataFrame, dict[int, int]]:
    """A sample of labelled ids, at most ``per_label`` per label and so fit to
    broadcast, and the number of rows per label.  Ids with conflicting labels
    count as labelled 1; NULL ids and labels are left out."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id"), F.col("doc_id")
    picked = [rows.filter(F.col("label") == y).orderBy(*order).limit(per_label) for y in (0, 1)]
    return picked[0].unionAll(picked[1]), sizes


def _document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term, over all ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def count(batches):
        import pyarrow as pa

        known, total, found = shared.value, 0, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                total += 1
                hit = set(map(known.get, set(terms_of(text))))  # the large dict is asked once a distinct term
                hit.discard(None)
                found[np.fromiter(hit, np.int64, len(hit))] += 1
        ids = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"id": pa.array([-1, *ids.tolist()], pa.int32()),
                                          "n": pa.array([total, *found[ids].tolist()], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows["id"].to_numpy(), rows["n"].to_numpy()
    df = np.zeros(len(terms), np.int64)
    df[ids[ids >= 0]] = n[ids >= 0]
    return int(n[ids < 0].sum()), df


class Index:
    """Exact nearest neighbours among unit vectors of the examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n, sizes = len(vectors), [len(v[0]) for v in vectors]
        self.term = np.concatenate([v[0] for v in vectors]).astype(np.int32) if vectors else np.zeros(0, np.int32)
        self.term_weight = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        self.row = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        example = np.repeat(np.arange(self.n), sizes)
        rows = np.bincount(self.term, minlength=n_terms)
        many = np.flatnonzero(rows > COMMON * self.n)
        self.column = np.full(n_terms, -1, np.int32)
        self.column[many] = np.arange(len(many))
        dense = self.column[self.term] >= 0
        self.matrix = np.zeros((len(many), self.n), np.float32)
        self.matrix[self.column[self.term[dense]], example[dense]] = self.term_weight[dense]
        order = np.flatnonzero(~dense)
        order = order[np.argsort(self.term[order], kind="stable")]
        # Narrow, and both in one place, since the lists are read from memory; the sums are of doubles.
        pairs = np.empty(len(order), ENTRY)
        pairs["example"], pairs["weight"] = example[order], self.term_weight[order]
        self.lists = pairs.view(np.int64)
        self.start = np.searchsorted(self.term[order], np.arange(n_terms + 1))
        self.slack = 2 * (len(many) + 5) * 2.0 ** -23  # twice the rounding of the matrix product and the lists, at least
        self.asked = np.zeros(n_terms)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest positive cosine, exactly, and the cosines;
        ties go to the earlier example."""
        return self.nearest_of([(ids, weights)], k)[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ``nearest`` of each vector."""
        found = []
        for at in range(0, len(vectors), SLICE):
            some = vectors[at:at + SLICE]
            left = np.zeros((len(some), len(self.matrix)), np.float32)
            for j, (ids, weights) in enumerate(some):
                column = self.column[ids]
                left[j, column[column >= 0]] = weights[column >= 0]
            found += [self._best(*v, near, k) for v, near in zip(some, left @ self.matrix, strict=True)]
        return found

    def _best(self, ids: np.ndarray, weights: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        start, end = self.start[ids], self.start[ids + 1]
        some = np.flatnonzero(end > start)
        if len(some):
            start, end = start[some], end[some]
            # A posting list lies in one piece: it is copied, not gathered.
            met = np.concatenate([self.lists[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]).view(ENTRY)
            near = near + np.bincount(met["example"], met["weight"] * np.repeat(weights[some], end - start), self.n)
        least = np.partition(near, self.n - k)[self.n - k] - self.slack if self.n > k else -1.0
        hit = np.flatnonzero(near >= least)
        # in double precision, term by term, so equal vectors get equal cosines
        start, end = self.row[hit], self.row[hit + 1]
        rows = list(zip(start.tolist(), end.tolist(), strict=True))
        term = np.concatenate([self.term[:0], *(self.term[a:b] for a, b in rows)])
        term_weight = np.concatenate([self.term_weight[:0], *(self.term_weight[a:b] for a, b in rows)])
        self.asked[ids] = weights
        cosine = np.bincount(np.repeat(np.arange(len(hit)), end - start), term_weight * self.asked[term], len(hit))
        self.asked[ids] = 0.0
        top = np.lexsort((hit, -cosine))[:k]
        top = top[cosine[top] > 0]
        return hit[top], cosine[top]


class Model:
    """Terms, their weights, the index and the votes; bounded by the sample.
    An example is its id, label, and its terms' places and numbers."""

    def __init__(self, terms: list[str], df: np.ndarray, total: int, examples: list[tuple[int, int, np.ndarray, np.ndarray]], sizes: dict[int, int]):
        self.ids = {t: k for k, t in enumerate(terms)}
        sampled = np.bincount([e[1] for e in examples], minlength=2)
        self.vote = np.array([sizes.get(y, 0) / max(1, sampled[y]) for y in (0, 1)])
        self.prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
        rows = np.zeros((2, len(terms)))
        for _, y, ids, _ in examples:
            rows[y, ids] += self.vote[y]
        share = (rows[1] + SMOOTH * self.prior) / (rows.sum(axis=0) + SMOOTH)
        self.weight = (np.log((1 + total) / (1 + df)) + 1e-6) * (np.abs(share - self.prior) + FLOOR)
        self.examples = [e[2:] for e in examples if len(e[2])]
        self.example_ids = [e[0] for e in examples if len(e[2])]
        self.labels = np.array([e[1] for e in examples if len(e[2])], np.int64)

    @cached_property
    def index(self) -> Index:
        """Made where texts are scored; it is larger than what it is made of."""
        return Index([self._unit(*e) for e in self.examples], len(self.ids))

    def _unit(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(ids)
        ids, n = ids[order], n[order]
        w = (1 + np.log(n)) * self.weight[ids]
        return ids.astype(np.int64), w / np.sqrt((w * w).sum())

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of a text's terms, in the order of the terms."""
        counts = Counter(terms_of(text))
        ids = np.fromiter(map(self.ids.get, counts, repeat(-1)), np.int64, len(counts))  # the large dict is asked once a distinct term
        known = ids >= 0
        if not known.any():
            return np.zeros(0, np.int64), np.zeros(0)
        return self._unit(ids[known], np.fromiter(counts.values(), np.int64, len(counts))[known])

    def score(self, text: str | None, k: int) -> tuple[float, list[dict]]:
        return self.scores([text], k)[0]

    def scores(self, texts: list[str | None], k: int) -> list[tuple[float, list[dict]]]:
        vectors = [self.vector(t) for t in texts]
        asked = [j for j, v in enumerate(vectors) if len(v[0]) and self.examples]
        found = [(self.prior, []) for _ in texts]
        if not asked:
            return found
        for j, near in zip(asked, self.index.nearest_of([vectors[j] for j in asked], k), strict=True):
            found[j] = self._votes(*near)
        return found

    def _votes(self, near: np.ndarray, cosine: np.ndarray) -> tuple[float, list[dict]]:
        y = self.labels[near]
        votes = cosine * self.vote[y]
        # The prior's votes are in units of a vote of average weight.
        unit = DAMPING * votes.sum() / max(1e-12, cosine.sum())
        value = (votes[y == 1].sum() + unit * self.prior) / max(1e-12, votes.sum() + unit)
        found = [{"doc_id": self.example_ids[i], "cosine": c, "label": a} for i, c, a in zip(near.tolist(), cosine.tolist(), y.tolist(), strict=True)]
        return float(min(1.0, max(0.0, value))), found


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = EXAMPLES) -> Model:
    """Fit on a bounded sample of ``labels`` and on term counts of all ``docs``."""
    picked, sizes = labelled(labels, label, per_label)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def count(batches):  # an example needs only its terms and their numbers
        import pyarrow as pa

        for batch in batches:
            found = [Counter(terms_of(x)) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "label": batch["label"], "terms": pa.array([" ".join(c) for c in found], pa.string()),
                "counts": pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))})

    rows = rows.select("doc_id", "label", "text").mapInArrow(count, "doc_id bigint, label int, terms string, counts array<int>")
    places: dict[str, int] = {}
    examples = []
    for batch in rows.dropDuplicates(["doc_id"]).toArrow().to_batches(max_chunksize=256):  # bounded by the sample
        for r in batch.to_pylist():
            ids = np.fromiter((places.setdefault(t, len(places)) for t in r["terms"].split()), np.int32)
            examples.append((r["doc_id"], r["label"], ids, np.array(r["counts"], np.int32)))
    terms = sorted(places)
    rank = np.zeros(len(terms), np.int32)
    rank[[places[t] for t in terms]] = np.arange(len(terms))
    examples = [(d, y, rank[ids], n) for d, y, ids, n in sorted(examples, key=lambda e: e[0])]
    del places
    n_docs, df = _document_frequencies(docs, terms)
    return Model(terms, df, n_docs, examples, sizes)


def toxicity(docs: DataFrame, model: Model, k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1), ``predicted`` (1 if score >= 0.5) and
    ``evidence`` (the nearest examples, their cosines and labels).

    Whole texts are scored.  A text that is NULL, empty or has no known term gets
    the labels' prior and no evidence; so does every text if nothing was
    labelled.  Equal texts get equal scores.  Columns of ``docs`` of these names
    are replaced; an empty table gives no rows.
    """
    from pyspark.sql import types as T

    out = ("score", "predicted", "evidence")
    docs = docs.drop(*out)
    shared = docs.sparkSession.sparkContext.broadcast([cloudpickle.dumps(model)])

    def label(batches):
        import pyarrow as pa

        if isinstance(shared.value[0], bytes):  # once a worker, not once a task
            shared.value[0] = pickle.loads(shared.value[0])
        model = shared.value[0]
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))
        for batch in batches:
            found = model.scores(batch.column(batch.schema.get_field_index("text")).to_pylist(), k)
            score = pa.array([s for s, _ in found], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, score, pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([e for _, e in found], kind)],
                [*batch.schema.names, *out])

    more = T.StructType.fromDDL(f"score double, predicted int, evidence {EVIDENCE}")
    return docs.mapInArrow(label, T.StructType([*docs.schema.fields, *more.fields]))
