"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton.  A
text is parsed from left to right into the longest phrases that occur in a
language's sample; few phrases mean that the sample predicts the text well.
Phrases times log2(sample length) per letter is an entropy in bits, and the
language with the fewest wins.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import slices, worker_cache

# --- bounds of the fitted sample ---------------------------------------------
SAMPLE_CHARS = 24_000        # letters and spaces of sample text per language
SAMPLE_ROWS = 400            # rows per language at most
ALL_CHARS = 1_500_000        # of all languages together; more languages get less each
# -----------------------------------------------------------------------------
CELLS = 64                   # in which a language's rows are chosen first
BLOCK = 256                  # characters parsed in step; a phrase ends at the end of a block
PAD = -1                     # no character: costs nothing
UNDETERMINED = "und"
SCHEMA = "lang_pred string, score double"


APART = re.compile(r"[\W\d_]+")


def normal(text: str) -> str:
    """Letters in lower case, all else one space."""
    return APART.sub(" ", text.lower()).strip()


def sample(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, sample_rows: int = SAMPLE_ROWS) -> dict[str, str]:
    """Text per language from rows chosen by a hash of their text: whole rows, at
    most ``sample_rows`` and little more than ``sample_chars``, cut at that.
    Every labelled row can be chosen; what is gathered has a fixed bound."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("key"))
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("key"))
    # First within cells of a language, then among what the cells keep: no task has a language's rows.
    chosen = rows.select("lang", "key").distinct().withColumn("cell", F.pmod("key", F.lit(CELLS)))
    chosen = chosen.withColumn("k", first("lang", "cell")).filter(F.col("k") <= sample_rows)
    chosen = chosen.withColumn("k", first("lang")).filter(F.col("k") <= sample_rows).select("lang", "key", "k")
    # A bounded number of keys, so fit to broadcast.
    rows = rows.join(F.broadcast(chosen), ["lang", "key"]).withColumn("text", F.substring("text", 1, 2 * sample_chars))
    rows = rows.groupBy("lang", "k").agg(F.min("text").alias("text"))
    before = Window.partitionBy("lang").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)))
    gathered: dict[str, list] = {}
    for r in rows.filter(F.col("before") < 2 * sample_chars).collect():
        gathered.setdefault(r.lang, []).append((r.k, normal(r.text)))
    each = min(sample_chars, ALL_CHARS // max(1, len(gathered)))
    return {lang: " ".join(t for _, t in sorted(parts))[:each] for lang, parts in sorted(gathered.items())}


def automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """The suffix automaton of ``codes``: the edges (code -> state) of every state."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        now = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = now
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return edges


class Table:
    """An automaton's edges in one array: the edge of state s by code c lies at
    ``base[s] + c`` and belongs to s if ``owner`` says so.  Rows of few edges lie in
    the gaps of others, so the array is about as long as there are edges, however
    large the alphabet.  Where there is no edge a new phrase begins: with the code
    itself, or, if the sample lacks it, between phrases (the last state)."""

    def __init__(self, edges: list[dict[int, int]], width: int):
        self.between = len(edges)
        self.begin = np.full(width, self.between, np.int32)
        for c, s in edges[0].items():
            self.begin[c] = s
        rows = {s: (np.fromiter(e.keys(), np.int64, len(e)), np.fromiter(e.values(), np.int64, len(e))) for s, e in enumerate(edges) if s and e}
        room = 2 * sum(len(c) for c, _ in rows.values()) + 2 * width + 1
        self.base = np.zeros(self.between + 1, np.int32)
        self.owner, self.next = np.full(room, -1, np.int32), np.zeros(room, np.int32)
        # Long rows first, each in the first gap from where the one before it found room.
        at, size = 0, 0
        for s in sorted((s for s in rows if len(rows[s][0]) > 1), key=lambda s: -len(rows[s][0])):
            codes, to = rows[s]
            if 2 * len(codes) <= size or not size:
                at, size = -int(codes.min()), len(codes)
            at = max(at, -int(codes.min()))
            while True:
                while at + 64 + width >= len(self.owner):
                    self.owner = np.concatenate([self.owner, np.full(room, -1, np.int32)])
                    self.next = np.concatenate([self.next, np.zeros(room, np.int32)])
                fits = (self.owner[np.arange(at, at + 64)[:, None] + codes] < 0).all(axis=1)
                if fits.any():
                    at += int(fits.argmax())
                    break
                at += 64
            self.base[s], self.owner[at + codes], self.next[at + codes] = at, s, to
        # Single edges take what is left, from the beginning.
        single = np.array([s for s in rows if len(rows[s][0]) == 1], np.int64)
        places = np.flatnonzero(self.owner < 0)[:len(single)]
        if len(places) < len(single):
            more = len(single) - len(places)
            places = np.concatenate([places, len(self.owner) + np.arange(more)])
            self.owner = np.concatenate([self.owner, np.full(more, -1, np.int32)])
            self.next = np.concatenate([self.next, np.zeros(more, np.int32)])
        codes = np.array([rows[s][0][0] for s in single], np.int64)
        self.base[single], self.owner[places], self.next[places] = places - codes, single, [rows[s][1][0] for s in single]
        # Any state may be asked for any code: pad both ends.
        shift = max(0, -int(self.base.min()))
        most = int(self.base.max()) + shift + width
        self.base += shift
        self.owner = np.concatenate([np.full(shift, -1, np.int32), self.owner])
        self.next = np.concatenate([np.zeros(shift, np.int32), self.next])
        if len(self.owner) < most:
            self.owner = np.concatenate([self.owner, np.full(most - len(self.owner), -1, np.int32)])
            self.next = np.concatenate([self.next, np.zeros(most - len(self.next), np.int32)])
        self.owner, self.next = self.owner[:most], self.next[:most]

    def step(self, state: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a new phrase began."""
        at = self.base[state] + codes
        fresh = self.owner[at] != state
        return np.where(fresh, self.begin[codes], self.next[at]), fresh


class Model:
    """Automata of all languages over the characters of all samples; code 0 is any
    other character and occurs in no sample."""

    def __init__(self, texts: dict[str, str]):
        self.langs = sorted(texts)
        seen = np.unique(np.frombuffer("".join(texts.values()).encode("utf-32-le"), np.uint32))
        self.map = np.zeros(0x110000, np.int32)
        self.map[seen] = np.arange(1, len(seen) + 1)
        self.tables = [Table(automaton(self.codes(texts[x])), len(seen) + 1) for x in self.langs]
        self.bits = np.array([np.log2(max(2, len(texts[x]))) for x in self.langs])

    def codes(self, text: str) -> np.ndarray:
        return self.map[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """Phrases of each row of ``blocks`` (codes, time by row), per language."""
        out = np.empty((len(self.langs), blocks.shape[1]))
        whole = [(step != PAD).all() for step in blocks]
        for k, table in enumerate(self.tables):
            state = np.full(blocks.shape[1], table.between, np.int32)
            count = np.zeros(blocks.shape[1], np.int32)
            for step, full in zip(blocks, whole, strict=True):
                if full:
                    state, fresh = table.step(state, step)
                    count += fresh
                else:
                    real = np.flatnonzero(step != PAD)
                    state[real], fresh = table.step(state[real], step[real])
                    count[real] += fresh
            out[k] = count
        return out

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character of each text, per language, and the share of its
        characters that any sample has."""
        sizes = np.array([len(t) for t in texts])
        n_blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(n_blocks)])
        codes = self.codes("".join(texts))
        at = np.concatenate([[0], np.cumsum(sizes)])
        total = np.zeros((len(self.langs), len(texts)))
        start = np.repeat(at[:-1], n_blocks) + BLOCK * (np.arange(first[-1]) - np.repeat(first[:-1], n_blocks))
        left = np.minimum(BLOCK, np.repeat(at[1:], n_blocks) - start)
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        order = np.argsort(left, kind="stable")
        for lo in range(0, len(order), 8192):  # blocks of like length together
            part = order[lo:lo + 8192]
            longest = int(left[part].max())
            grid = start[part][None, :] + np.arange(longest)[:, None]
            inside = np.arange(longest)[:, None] < left[part][None, :]
            blocks = np.where(inside, codes[np.minimum(grid, len(codes) - 1)], PAD)
            found = self.phrases(blocks)
            for k in range(len(self.langs)):
                total[k] += np.bincount(owner[part], found[k], len(texts))
        known = np.bincount(np.repeat(np.arange(len(texts)), sizes), codes > 0, len(texts))
        return total * self.bits[:, None] / np.maximum(1, sizes), known / np.maximum(1, sizes)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score.  The score is the winner's share when every language
        weighs 2 to the power of minus its excess bits over a run of 16 letters,
        times the share of the text's characters that the samples know; equal
        entropies fall to the first language by code point."""
        names, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        full = [k for k, t in enumerate(texts) if t]
        if full and self.langs:
            bits, known = self.entropy([texts[k] for k in full])
            best = bits.argmin(axis=0)
            weight = np.exp2(-16 * (bits - bits.min(axis=0)) / 4)
            for j, k in enumerate(full):
                names[k], score[k] = self.langs[best[j]], known[j] / weight[:, j].sum()
        return names, score


def identify(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (0 to 1), predicted from the text
    alone against the sample ``texts`` per language.

    ``und`` with score 0 where the text is NULL, empty or without a letter, or
    where there is no sample at all.  Equal texts get equal results; whole texts
    are parsed, in blocks.  Columns of ``docs`` named ``lang_pred`` or ``score``
    are replaced; an empty table gives no rows.
    """
    from pyspark.sql import types as T

    docs = docs.drop("lang_pred", "score")
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.withColumn("__letters", has_letter)
    shared = docs.sparkSession.sparkContext.broadcast(texts)  # bounded by ALL_CHARS
    token = f"{hash(tuple(sorted(texts.items()))):x}"

    def label(batches):
        import pyarrow as pa
        from pyarrow import compute as pc

        cache = worker_cache("language")
        if token not in cache:
            cache.clear()
            cache[token] = Model(shared.value)
        model = cache[token]
        for batch in batches:
            letters = batch.column(batch.schema.get_field_index("__letters"))
            text = batch.column(batch.schema.get_field_index("text"))
            off = np.concatenate([[0], np.cumsum(pc.fill_null(pc.utf8_length(text), 0).to_numpy(zero_copy_only=False))])
            rest = batch.drop_columns(["__letters"])
            for lo, hi in slices(off, 1 << 20):
                size = hi - lo
                pairs = zip(text.slice(lo, size).to_pylist(), letters.slice(lo, size).to_pylist(), strict=True)
                names, score = model.predict([normal(t) if ok else "" for t, ok in pairs])
                piece = rest.slice(lo, size)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(names), pa.array(score)],
                                                 [*piece.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(label, schema)
