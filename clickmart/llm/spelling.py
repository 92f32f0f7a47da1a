"""Grouping of spelling variants by a bit-sliced position index.

For a batch of words the index has one bitset per (position, letter): which
words have that letter there.  A query word is read letter by letter, and whole
bitsets are carried along: the words that agree so far, and those with one error
so far, apart by kind: a letter replaced (same position), dropped (shifted by
one to the left) or inserted (to the right).  All queries of a batch advance
together.

Words that are near, of which the longer has M letters, agree in the first half
of M letters or in the other half at the end, so the vocabulary is dealt into
blocks by those pieces, once per possible M; a pair counts in one block only.
Blocks above ``BLOCK`` words are dealt again by a further half of what may still
differ, until at most one letter may.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import Work, stage

# --- fixed values ------------------------------------------------------------
LETTER = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
SHARE = 10                # a form is so many times as frequent as its variant
DELETED = 31              # a run whose hash this divides loses a letter
# -----------------------------------------------------------------------------
BATCH = 1024              # words of one index where their blocks are smaller
CELLS = 1 << 22           # letters of one index, likewise
BLOCK = 4096              # larger blocks are dealt again
HELD = 200_000            # distinct words that a counting task holds
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_U = np.uint64


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: words of at least MIN_LENGTH letters with their number of
    occurrences, after the deletions that the ids' hashes ask for."""
    runs = re.compile(f"[{LETTER}]{{{MIN_LENGTH},}}")  # shorter runs cannot become words

    def count(batches):
        import pyarrow as pa

        total: dict[str, int] = {}

        def out():
            rows = pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return rows

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen: dict[str, int] = {}
                for w in runs.findall(text.as_py() or ""):
                    seen[w] = seen.get(w, 0) + 1
                begun = zlib.crc32(f"{key}:".encode())
                for w, n in seen.items():
                    w = w.translate(_LOWER) if not w.islower() else w
                    h = zlib.crc32(w.encode(), begun)
                    if h % DELETED == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1:]
                        if len(w) < MIN_LENGTH:
                            continue
                    total[w] = total.get(w, 0) + n
                if len(total) > HELD:
                    yield out()
        if total:
            yield out()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# --- blocks ------------------------------------------------------------------

def _keyed(rows: DataFrame) -> DataFrame:
    piece = F.struct("m", "p", "s", F.expr("left(word, p)"), F.expr("right(word, s)"))
    return rows.withColumn("key", F.xxhash64(piece))


def blocks(words: DataFrame) -> DataFrame:
    """Rows of every word, one per block: the block's words have ``m`` letters or
    one less, and the first ``p`` and the last ``s`` of them in common.  A pair
    counts in the block where also the first ``apart`` differ (0: no condition)."""
    half = F.floor(F.col("m") / 2).cast("int")
    rows = words.withColumn("m", F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)))
    sides = F.array(F.struct(half.alias("p"), F.lit(0).alias("s"), F.lit(0).alias("apart")),
                    F.struct(F.lit(0).alias("p"), (F.col("m") - half).alias("s"), half.alias("apart")))
    return _keyed(rows.withColumn("side", F.explode(sides)).select("word", "n", "m", "side.*"))


def _finer(rows: DataFrame) -> DataFrame:
    """The rows of a block in the two blocks of half of what may differ in it."""
    free = F.col("m") - F.col("p") - F.col("s")
    half = F.floor(free / 2).cast("int")
    sides = F.array(F.struct((F.col("p") + half).alias("p"), F.col("s").alias("s"), F.col("apart").alias("apart")),
                    F.struct(F.col("p").alias("p"), (F.col("s") + free - half).alias("s"), (F.col("p") + half).alias("apart")))
    return _keyed(rows.withColumn("side", F.explode(sides)).select("word", "n", "m", "side.*"))


def bounded_blocks(words: DataFrame, work: Work, most: int = BLOCK) -> DataFrame:
    """``blocks`` with all that have more than ``most`` words dealt again."""
    small, rows = None, blocks(words)
    while True:
        hot = work.stage(rows.groupBy("key", "m", "p", "s").agg(F.count(F.lit(1)).alias("size"))
                         .filter(f"size > {most} and m - p - s > 1").select("key").distinct(), "hot-blocks")
        if hot.isEmpty():
            return rows if small is None else small.unionByName(rows)
        rest = rows.join(hot, "key", "left_anti")
        small = rest if small is None else small.unionByName(rest)
        rows = work.stage(_finer(rows.join(hot, "key", "left_semi")), "finer-blocks")


# --- search ------------------------------------------------------------------

class PositionIndex:
    """Bitsets over a batch of words: which of them have a letter at a position."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.codes, self.lengths = codes, lengths
        self.width = -(-len(codes) // 64)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bits(self, chosen: np.ndarray) -> np.ndarray:
        """Rows of booleans over the words as rows of 64-bit bitsets."""
        packed = np.packbits(chosen, axis=-1, bitorder="little")
        out = np.zeros((*packed.shape[:-1], 8 * self.width), np.uint8)
        out[..., :packed.shape[-1]] = packed
        return out.view(_U)

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """For each letter the bitset of the words that have it at ``position``."""
        if position < 0 or position >= self.codes.shape[1]:
            return np.zeros((len(letters), self.width), _U)
        if position not in self.known:
            for old in [p for p in self.known if p < position - 3]:
                del self.known[old]
            column = self.codes[:, position]
            there = np.unique(column)
            place = np.full(256, len(there), np.int64)
            place[there] = np.arange(len(there))
            rows = np.concatenate([self.bits(column[None, :] == there[:, None]), np.zeros((1, self.width), _U)])
            place[0] = len(there)  # no letter: the word is shorter
            self.known[position] = (place, rows)
        place, rows = self.known[position]
        return rows[place[letters]]

    def near(self, queries: np.ndarray, length: int) -> np.ndarray:
        """For each query word of ``length`` letters the words at one error whose
        length is that of the batch's longest or, for longest queries, also one
        less."""
        longest = self.codes.shape[1]
        codes = self.codes[queries]
        zero = np.full((len(queries), self.width), ~_U(0))
        swap, drop, more = np.zeros_like(zero), np.zeros_like(zero), np.zeros_like(zero)
        same = length == longest
        for i in range(length):
            letters = codes[:, i]
            here = self.at(i, letters)
            if same:
                swap &= here
                swap |= zero & ~here
                drop &= self.at(i - 1, letters)
                drop |= zero
            else:
                more |= zero
                more &= self.at(i + 1, letters)
            zero &= here
        of = lambda n: self.bits(self.lengths == n)
        return (swap & of(length)) | (drop & of(length - 1)) if same else (more | zero) & of(longest)


def pairs_of(codes: np.ndarray, lengths: np.ndarray, block: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, other) of near words of one block that count there."""
    index, longest = PositionIndex(codes, lengths), codes.shape[1]
    a, b = [], []
    for length in (longest, longest - 1):
        queries = np.flatnonzero(lengths == length)
        step = max(64, (1 << 20) // max(1, index.width))  # 8 MB a set at most
        for lo in range(0, len(queries), step):
            part = queries[lo:lo + step]
            found = index.near(part, length)
            q, w = np.nonzero(found)
            hit, bit = np.nonzero((found[q, w][:, None] >> np.arange(64, dtype=_U)) & _U(1))
            a.append(part[q[hit]])
            b.append(w[hit] * 64 + bit)
    a, b = np.concatenate(a), np.concatenate(b)
    ok = block[a] == block[b]
    a, b = a[ok], b[ok]
    ok = apart[a] == 0
    for n in np.unique(apart[a]):
        if n:
            here = apart[a] == n
            ok[here] = (codes[a[here], :n] != codes[b[here], :n]).any(axis=1)
    return a[ok], b[ok]


NEAR = "word string, n_near bigint, best bigint, form string"


def _search(batches):
    """Rows sorted by (m, key); yields for each word and block the number of near
    words, and the most frequent of them."""
    import pyarrow as pa

    words, counts, apart, keys, m = [], [], [], [], None

    def done():
        raw = [w.encode("latin-1") for w in words]
        lengths = np.array([len(r) for r in raw])
        codes = np.zeros((len(raw), m), np.uint8)
        codes[np.arange(m) < lengths[:, None]] = np.frombuffer(b"".join(raw), np.uint8)
        block = np.cumsum([1, *(x != y for x, y in zip(keys[1:], keys, strict=False))])
        a, b = pairs_of(codes, lengths, block, np.array(apart))
        n = np.array(counts)
        order = np.lexsort((np.argsort(np.argsort(np.array(raw, object)))[b], -n[b], a))  # Latin-1 bytes stand in code-point order
        a, b = a[order], b[order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
        size = np.diff(np.append(first, len(a)))
        best = b[first]
        return pa.RecordBatch.from_arrays([pa.array([words[k] for k in a[first]], pa.string()), pa.array(size, pa.int64()), pa.array(n[best], pa.int64()),
                                           pa.array([words[k] for k in best], pa.string())], names=["word", "n_near", "best", "form"])

    for batch in batches:
        for w, n, of, length, key in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "apart", "m", "key")), strict=True):
            if words and (length != m or (len(words) >= BATCH or len(words) * m >= CELLS) and key != keys[-1]):
                yield done()
                words, counts, apart, keys = [], [], [], []
            m = length
            words.append(w)
            counts.append(n)
            apart.append(of)
            keys.append(key)
    if words:
        yield done()


def near_words(words: DataFrame, work: Work, most: int = BLOCK) -> DataFrame:
    """word, n_near, best (largest n of a near word), form (that word; the
    smallest of those in code-point order) for words with any near word."""
    rows = bounded_blocks(words, work, most).select("word", "n", "apart", "m", "key")
    rows = rows.repartition("key").sortWithinPartitions("m", "key")
    first = F.min(F.struct((-F.col("best")).alias("less"), "form"))
    found = rows.mapInArrow(_search, NEAR).groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return found.select("word", "n_near", (-F.col("first.less")).alias("best"), F.col("first.form").alias("form"))


def _last_forms(links: DataFrame, work: Work) -> DataFrame:
    """word, root for every word of ``links`` (word, form).  A form is more
    frequent than its word, so there is no circle, and every round of joins
    doubles the steps."""
    now = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = work.stage(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def group_variants(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id,
    text) with at least MIN_LENGTH letters and MIN_COUNT occurrences.

    Words are runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case, of whole
    texts; NULL text has none; a NULL id counts as an empty one in the hash;
    equal rows count each.  Near words differ by one inserted, deleted or
    replaced letter.  The form is the near
    word of largest n, ties to the smallest, where that n is SHARE times the
    word's at least; root is where the forms end.  Extra columns are not read;
    an empty table gives no rows.
    """
    work = Work(docs.sparkSession)
    words = work.stage(word_counts(docs).filter(F.col("n") >= MIN_COUNT), "vocabulary")
    near = near_words(words, work, block)
    own = F.col("best") >= SHARE * F.col("n")
    known = work.stage(words.join(near, "word", "left").select(
        "word", F.when(own, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(own, F.col("best")).alias("form_n")), "forms")
    roots = _last_forms(known.filter("form is not null").select("word", "form"), work)
    found = known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    found = stage(found, "variants")
    work.clear()
    return found
