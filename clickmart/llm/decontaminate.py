"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur with up to k = floor(rate * m) edits.
Cut into k + 1 pieces, at least one piece of any such occurrence is unharmed,
so exact hits of pieces (Aho-Corasick) find every candidate.  A hit is verified
upwards: of a run of s pieces with at most s - 1 edits, one half again has
fewer edits than pieces, so some chain of doubling runs from a hit piece up to
the whole item holds within those bounds.  Each run is compared by Myers'
bit-parallel distance.
"""

from __future__ import annotations

import re

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import worker_cache

ERROR_RATE = 0.08
MIN_CHARS = 24             # shorter items (after normalising) must occur as they are, as whole words
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")  # scripts without spaces between words
GROUP_CHARS = 4_000_000    # characters of items that go to the workers at once
APART = re.compile(r"[\W_]+")


def lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normal(text: str) -> str:
    """Letters and digits in lower case, all else one space."""
    return APART.sub(" ", lower(text))


def origins(text: str) -> list[int]:
    """For each character of ``normal(text)`` its place in ``text``, and the end."""
    low, at, out = lower(text), 0, []
    for gap in APART.finditer(low):
        out.extend(range(at, gap.start() + 1))
        at = gap.end()
    out.extend(range(at, len(low) + 1))
    return out


class Pattern:
    """Myers' bit-parallel matching of one string anywhere in a text."""

    def __init__(self, text: str):
        self.size, self.masks = len(text), {}
        for k, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << k

    def best(self, text: str) -> tuple[int, int]:
        """Least distance to a part of ``text`` and the first end that has it."""
        full, high = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, now, least, end = full, 0, self.size, self.size, 0
        get = self.masks.get
        for k, c in enumerate(text):
            eq = get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            plus = down | (full & ~(xh | up))
            minus = up & xh
            if plus & high:
                now += 1
            elif minus & high:
                now -= 1
                if now < least:
                    least, end = now, k + 1
            plus <<= 1
            minus <<= 1
            up = (minus | ~(xv | plus)) & full
            down = plus & xv & full
        return least, end


def _border(text: str, at: int) -> bool:
    """Whether a word may begin or end at a place of a normalised text."""
    return at in (0, len(text)) or " " in text[at - 1:at + 1] or bool(UNSPACED.search(text, at - 1, at + 1))


class Matcher:
    """All items' pieces in one automaton."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        import ahocorasick

        self.items, self.patterns = [], {}
        same: dict[str, list] = {}
        for name, text in items:
            same.setdefault(text, []).append(name)
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (text, names) in enumerate(same.items()):
            n = int(rate * len(text)) + 1 if len(text) >= MIN_CHARS else 1
            cuts = [len(text) * j // n for j in range(n + 1)]
            self.items.append((text, names, cuts))
            for j in range(n):
                pieces.setdefault(text[cuts[j]:cuts[j + 1]], []).append((i, j))
        self.automaton = ahocorasick.Automaton()
        for p, at in pieces.items():
            self.automaton.add_word(p, (len(p), at))
        if pieces:
            self.automaton.make_automaton()

    def _pattern(self, i: int, lo: int, hi: int, back: bool = False) -> Pattern:
        key = (i, lo, hi, back)
        if key not in self.patterns:
            text, _, cuts = self.items[i]
            text = text[cuts[lo]:cuts[hi]]
            self.patterns[key] = Pattern(text[::-1] if back else text)
        return self.patterns[key]

    def _verify(self, i: int, j: int, text: str, at: int) -> tuple[int, int, int] | None:
        """Piece ``j`` of item ``i`` stands at ``at``: start, end and distance of the
        item there, if it is within its bound."""
        cuts = self.items[i][2]
        n = len(cuts) - 1
        runs, lo, hi = [], 0, n
        while hi - lo > 1:
            runs.append((lo, hi))
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if j < mid else (mid, hi)
        for lo, hi in reversed(runs):
            most = hi - lo - 1
            left = max(0, at - (cuts[j] - cuts[lo]) - most)
            least, end = self._pattern(i, lo, hi).best(text[left:at + cuts[hi] - cuts[j] + most])
            if least > most:
                return None
        if not runs:
            end = at + cuts[-1]
            if cuts[-1] < MIN_CHARS and not (_border(text, at) and _border(text, end)):
                return None
            return at, end, 0
        end += left
        _, size = self._pattern(i, 0, n, True).best(text[left:end][::-1])
        return end - size, end, least

    def find(self, text: str | None) -> list[tuple[object, int, int, int]]:
        """Item, start, end (in ``text``) and distance of every occurrence."""
        if not text or not self.items:
            return []
        plain, found, done = normal(text), [], {}
        for last, (size, places) in self.automaton.iter(plain):
            at = last + 1 - size
            for i, j in places:
                if at < done.get(i, 0):
                    continue
                got = self._verify(i, j, plain, at)
                if got:
                    done[i] = max(got[1], at + 1)
                    found.append((i, *got))
        if not found:
            return []
        place = origins(text)
        return [(name, place[a], place[b - 1] + 1, d) for i, a, b, d in found for name in self.items[i][1]]


def _groups(items: DataFrame, group_chars: int):
    """The items in lists of about ``group_chars`` characters."""
    rows = items.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // group_chars)
    for g in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == g)
        texts = sorted({(r.item_id, normal(r.text).strip()) for r in part.collect()})
        yield [(name, t) for name, t in texts if t]


def match_items(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, keep: list[str] | None = None,
                group_chars: int = GROUP_CHARS) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus ``matches``: item_id, start, end and
    distance of every occurrence of an item with at most ``rate`` edits a
    character, in characters of the whole text.

    Texts are compared in lower case, with everything but letters and digits as
    one space.  Items shorter than ``MIN_CHARS`` must occur without an edit, from
    word border to word border (in scripts without spaces anywhere); items that
    are NULL, without id or without a letter or digit are left out; items with
    the same text are all reported.  Items are test sets of a bounded size: each
    worker holds ``group_chars`` characters of them at once, and a larger set is
    taken in groups, one pass over the documents each.  NULL and empty
    texts have no match; repeated rows are each matched; an empty table, or no
    items, gives no matches.  A column ``matches`` of ``docs`` is replaced.
    """
    from pyspark.sql import types as T

    kind = items.schema["item_id"].dataType
    match = T.ArrayType(T.StructType([T.StructField("item_id", kind), T.StructField("start", T.IntegerType()),
                                      T.StructField("end", T.IntegerType()), T.StructField("distance", T.IntegerType())]))
    docs = docs.drop("matches")
    keep = [c for c in (keep or docs.columns) if c != "matches"]
    rows = docs.withColumn("matches", F.array().cast(match))
    for group in _groups(items, group_chars):
        shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps((group, rate)))
        rows = rows.mapInArrow(_scanner(shared, f"{id(shared)}-{hash(tuple(group)):x}"), rows.schema)
    return rows.select(*keep, "matches")


def _scanner(shared, token: str):
    def scan(batches):
        import pickle

        import pyarrow as pa

        cache = worker_cache("items")
        if token not in cache:
            cache.clear()
            cache[token] = Matcher(*pickle.loads(shared.value))
        matcher = cache[token]
        for batch in batches:
            at = batch.schema.get_field_index("matches")
            texts = batch.column(batch.schema.get_field_index("text"))
            found = [[dict(zip(("item_id", "start", "end", "distance"), m, strict=True)) for m in matcher.find(t.as_py())] for t in texts]
            if any(found):
                old = batch.column(at).to_pylist()
                new = pa.array([a + b for a, b in zip(old, found, strict=True)], batch.schema.field(at).type)
                batch = batch.set_column(at, batch.schema.field(at), new)
            yield batch

    return scan


def contaminated(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per document id and item found in it: n_spans, the least distance,
    and the first of its spans."""
    found = match_items(docs.select("doc_id", "text"), items, rate, ["doc_id"])
    return (
        found.select("doc_id", F.explode("matches").alias("m"))
        .groupBy("doc_id", F.col("m.item_id").alias("item_id"))
        .agg(F.count(F.lit(1)).alias("n_spans"), F.min("m.distance").alias("distance"),
             F.min(F.struct("m.start", "m.end")).alias("first"))
        .select("doc_id", "item_id", "n_spans", "distance", F.col("first.start").alias("start"), F.col("first.end").alias("end"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` without any item, columns unchanged."""
    kept = [F.col(c).alias(f"__{c}" if c == "matches" else c) for c in docs.columns]
    clean = match_items(docs.select(*kept), items, rate).filter(F.size("matches") == 0).drop("matches")
    return clean.toDF(*docs.columns)
