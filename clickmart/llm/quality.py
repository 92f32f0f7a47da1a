"""Quality rules: base counts of a text and its divergence from its language.

A language's reference is the histogram of character classes and of its most
common short words, summed over all documents of that language that are long
and varied enough.  A document's own histograms are compared with them by
Jensen-Shannon distance.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import GAP, WORD, let, stage

# --- fixed values ------------------------------------------------------------
MIN_WORDS = 50            # shorter texts fail; also the least length of a reference document
MAX_REPEAT_PERCENT = 50   # words in repeated 3-word windows
SYMBOLS = "#*$%&|<>"
CLASSES = ("upper", "lower", "digit", "space", "stop", "mark")  # all other characters are one more class
UPPER, DIGIT, SPACE, STOP, MARK = r"\p{Lu}", r"\p{Nd}", r"\p{Z}\x1C-\x1F\x85", r".,;:?'()\-", SYMBOLS + "!"
LOWER = r"\p{Ll}\p{Lt}\p{Lm}\p{Lo}\p{M}"  # letters without case and combining marks count as lower
BLANK = r"\x20\x09-\x0D"  # white space that parts words, as in GAP
COMMON_WORDS = 32         # words of a reference
COMMON_LENGTH = 5         # letters of a common word at most
VARIED = 4                # a reference document has a distinct word in so many at least
PLAIN = 20                # and one mark in so many words at most, and fewer capitals than half
MIN_CHARS = 200           # least characters for the class distance
MIN_LETTER_WORDS = 100    # least words for the word distance
MAX_CLASS_DISTANCE = 0.17  # between the labels: at sf0.1 99.5 % of good rows lie below 0.150, all bad ones above 0.187
MAX_WORD_DISTANCE = 0.36
# -----------------------------------------------------------------------------


def _chars(text: Column, kept: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("bigint")


FEW = 64  # repeated windows that are looked up in a list


def _window_hashes(words: Column) -> Column:
    """Hash of every 3-word window; one for each word, the last two to be left out."""
    hashes = let(words, lambda w: F.transform(w, lambda x, k: F.xxhash64(x, F.get(w, k + 1), F.get(w, k + 2))))
    return F.when(F.size(words) < 4, F.array().cast("array<bigint>")).otherwise(F.slice(hashes, F.lit(1), F.size(words) - 2))


def _repeated_words(hashes: Column, ordered: Column) -> Column:
    """Words that lie in a 3-word window which the text has twice or more, from
    the windows' hashes, as they stand and sorted."""
    def covered(at: Column) -> Column:  # ascending starts of such windows
        gaps = F.transform(at, lambda p, k: F.least(F.lit(3), p - F.coalesce(F.get(at, k - 1), F.lit(-3))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g).cast("bigint")

    def listed(twice: Column) -> Column:
        at = F.transform(hashes, lambda h, k: F.when(F.array_contains(twice, h), k))
        return F.filter(at, lambda k: k.isNotNull())

    def sorted_starts(pairs: Column) -> Column:  # (hash, start), sorted
        same = lambda x, k: F.coalesce(F.get(pairs, k)["h"] == x["h"], F.lit(False))
        hit = F.filter(pairs, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(hit, lambda x: x["p"]))

    twice = F.array_distinct(F.filter(ordered, lambda h, k: F.coalesce(F.get(ordered, k - 1) == h, F.lit(False))))
    pairs = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    starts = let(twice, lambda d: F.when(F.size(d) <= FEW, listed(d)).otherwise(let(pairs, sorted_starts)))
    none = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(none, F.lit(0).cast("bigint")).otherwise(let(starts, covered))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed; ``__words`` has the words.  NULL text has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return (
        docs.withColumn("__words", F.array_remove(F.split(text, GAP), ""))
        .withColumn("n_words", F.size("__words").cast("bigint"))
        .withColumn("word_chars", F.char_length(F.array_join("__words", "")).cast("bigint"))
        .withColumn("__sparse", _sparse(text))
        .withColumn("n_symbols", _chars(F.col("__sparse"), SYMBOLS))
        .withColumn("n_dup_lines", let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
        .withColumn("__windows", _window_hashes(F.col("__words")))
        .withColumn("__ordered", F.sort_array("__windows"))
        .withColumn("n_repeat_words", _repeated_words(F.col("__windows"), F.col("__ordered")))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    )


def _sparse(text: Column) -> Column:
    """What is left without lower letters and blanks, a small part of most texts."""
    return F.regexp_replace(text, f"[{LOWER}{BLANK}]+", "")


def _class_counts(blanks: Column) -> list[Column]:
    """Counts of the classes and of all characters, from ``__sparse`` and the number of blanks."""
    chars = F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint")
    sparse = F.col("__sparse")
    counts = {"upper": _chars(sparse, UPPER), "lower": chars - F.char_length(sparse) - blanks, "digit": _chars(sparse, DIGIT),
              "space": _chars(sparse, SPACE) + blanks, "stop": _chars(sparse, STOP), "mark": _chars(sparse, MARK), "chars": chars}
    return [counts[n].cast("bigint").alias(f"__{n}") for n in (*CLASSES, "chars")]


def _letter_words() -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^\p{L}]+"), "")


def references(docs: DataFrame) -> DataFrame:
    """One row per ``lang`` (and one with NULL for all languages together): class
    shares and the most common words with their shares.  The table grows with
    the number of languages only."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select("lang", "text", _sparse(text).alias("__sparse"))
    one = one.select("lang", *_class_counts(_chars(text, BLANK)), _letter_words().alias("__letters"))
    n = F.size("__letters")
    usable = (n >= MIN_WORDS) & (F.col("__mark") * PLAIN <= n) & (2 * F.col("__upper") <= F.col("__chars"))
    usable &= VARIED * F.size(F.array_distinct("__letters")) >= n
    short = F.filter("__letters", lambda w: F.length(w) <= COMMON_LENGTH)
    totals = F.array(F.lit(None).cast("string"))  # the document's totals travel as one more word
    one = one.withColumn("__row", F.explode(F.when(usable, F.concat(totals, short)).otherwise(F.array().cast("array<string>"))))
    total = lambda c: F.sum(F.when(F.col("__row").isNull(), c))
    counts = stage(
        one.groupBy("lang", "__row").agg(
            F.count(F.lit(1)).alias("__n"), total(F.size("__letters")).alias("__letters"),
            *[total(F.col(f"__{n}")).alias(f"__{n}") for n in (*CLASSES, "chars")]),
        "quality-counts")
    counts = counts.filter(F.col("lang").isNotNull()).unionByName(counts.withColumn("lang", F.lit(None).cast("string")))
    counts = counts.groupBy("lang", "__row").agg(*[F.sum(c).alias(c) for c in counts.columns if c not in ("lang", "__row")])

    rest = F.col("__chars")
    for n in CLASSES:
        rest = rest - F.col(f"__{n}")
    totals = counts.filter(F.col("__row").isNull()).select(
        F.col("lang").alias("ref_lang"), F.col("__letters").alias("ref_letters"),
        F.transform(F.array(*[F.col(f"__{n}") for n in CLASSES], rest), lambda c: c / F.col("__chars")).alias("ref_classes"))
    order = Window.partitionBy("lang").orderBy(F.desc("__n"), "__row")
    top = counts.filter(F.col("__row").isNotNull()).withColumn("__k", F.row_number().over(order)).filter(F.col("__k") <= COMMON_WORDS)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("__k", "__row", "__n"))).alias("__top"))
    return (
        totals.join(top, F.col("ref_lang").eqNullSafe(F.col("lang")), "left")
        .select("ref_lang", "ref_classes", F.transform("__top", lambda x: x["__row"]).alias("ref_words"),
                F.transform("__top", lambda x: x["__n"] / F.col("ref_letters")).alias("ref_shares"))
    )


def _js(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two share arrays."""
    part = lambda a, b: F.when(a > 0, a * F.log2(a * 2 / (a + b))).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def quality(docs: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """``docs`` plus the base counts, ``class_distance``, ``word_distance`` and
    ``kept``.

    A document is compared with the reference of its ``lang``, or with that of
    all languages where its own is NULL or has none.  A distance is NULL, and
    does not count, below the length guards or without any reference.  NULL text
    is empty, fails the base rules and is not kept; rows are judged one by one,
    so repeated rows get the same verdict; an empty table gives no rows.
    Columns of ``docs`` whose names are those of the result are replaced.

    Write the result, or stage it, before filtering or joining on its columns:
    Spark moves such a filter below the counts and computes them many times.
    """
    out = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
    docs = docs.drop(*out)
    refs = references(docs)
    known = refs.filter(F.col("ref_lang").isNotNull())
    pooled = refs.filter(F.col("ref_lang").isNull()).drop("ref_lang")
    pooled = pooled.select([F.col(c).alias(f"all_{c}") for c in pooled.columns])
    # A row per language, of fixed width: languages are few hundred at most.
    table = F.broadcast(known)
    rows = base_counts(docs).select("*", *_class_counts(F.char_length(F.coalesce(F.col("text"), F.lit(""))) - F.col("word_chars")), _letter_words().alias("__letters"))
    rows = rows.join(table, F.col("lang") == F.col("ref_lang"), "left").join(F.broadcast(pooled), F.lit(True), "left")
    ref = lambda c: F.coalesce(F.col(c), F.col(f"all_{c}"))

    rest = F.col("__chars")
    for n in CLASSES:
        rest = rest - F.col(f"__{n}")
    own = F.transform(F.array(*[F.col(f"__{n}") for n in CLASSES], rest), lambda c: c / F.col("__chars"))
    class_distance = F.when(F.col("__chars") >= MIN_CHARS, _js(own, ref("ref_classes")))

    def words(hits: Column) -> Column:
        n = F.size("__letters")
        found = F.transform(ref("ref_words"), lambda w: F.size(hits) - F.size(F.array_remove(hits, w)))
        with_rest = lambda x: F.concat(x, F.array(F.greatest(F.lit(0.0), 1 - F.aggregate(x, F.lit(0.0), lambda a, b: a + b))))
        return _js(let(F.transform(found, lambda c: c / n), with_rest), let(ref("ref_shares"), with_rest))

    common = F.filter("__letters", lambda w: F.length(w) <= COMMON_LENGTH)
    word_distance = F.when(F.size("__letters") >= MIN_LETTER_WORDS, let(common, words))
    far = lambda c, most: F.coalesce(F.col(c) > most, F.lit(False))
    kept = ~F.col("base_failed") & ~far("class_distance", max_class_distance) & ~far("word_distance", max_word_distance)
    return (
        rows.withColumn("class_distance", F.round(class_distance, 6)).withColumn("word_distance", F.round(word_distance, 6))
        .withColumn("kept", kept).select(*docs.columns, *out)
    )
