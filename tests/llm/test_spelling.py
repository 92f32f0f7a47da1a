"""Operator 13: near words and forms, against plain edit distance."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickmart.llm import spelling
from clickmart.llm.common import Work


def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return 9
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(rows):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if edits(w, v) == 1] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def made(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {tuple(r) for r in spelling.group_variants(df, **more).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def variants(seed, n_words=40):
    """Rows whose words are edits of each other, of edits, and of common words."""
    rng = random.Random(seed)
    letters = "abcéÿ×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(n_words)]
    words = []
    for w in base:
        words += [w] * rng.choice([2, 30, 400])
        for _ in range(6):
            v = w
            for _ in range(rng.choice([1, 1, 2])):
                k = rng.randrange(len(v))
                v = rng.choice([v[:k] + v[k + 1:], v[:k] + rng.choice(letters) + v[k:], v[:k] + rng.choice(letters) + v[k + 1:]])
            words += [v.capitalize()] * rng.choice([1, 2, 3, 25])
    rng.shuffle(words)
    return [(k, " ".join(words[k::50])) for k in range(50)]


@pytest.mark.parametrize("block", [spelling.BLOCK, 3])
def test_against_brute_force(spark, block):
    rows = variants(block)
    assert made(spark, rows, block=block) == brute(rows)


def test_dense_words(spark):
    """All words over two letters: every block is hot and is dealt again and again."""
    rng = random.Random(2)
    words = [f"{n:b}".translate({48: "a", 49: "b"}) for n in range(64, 1024, 3)]
    text = " ".join(w for w in words for _ in range(rng.choice([2, 2, 25])))
    assert made(spark, [(-1, text)], block=4) == brute([(-1, text)])


def test_each_pair_counts_once(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(7, 8))) for _ in range(300)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    work = Work(spark)
    got = {r.word: r.n_near for r in spelling.near_words(df, work, 5).collect()}
    work.clear()
    assert got == {w: n for w in words if (n := sum(edits(w, v) == 1 for v in words))}


def test_index_by_kind_of_error():
    raw = [b"abcdefg", b"abcdefh", b"abXdefg", b"abcdefgh", b"abcdeffg", b"xabcdefg", b"bacdefg"]
    m = 8
    codes = np.zeros((len(raw), m), np.uint8)
    for k, r in enumerate(raw):
        codes[k, :len(r)] = list(r)
    lengths = np.array([len(r) for r in raw])
    a, b = spelling.pairs_of(codes, lengths, np.zeros(len(raw), int), np.zeros(len(raw), int))
    want = {(i, j) for i, x in enumerate(raw) for j, y in enumerate(raw) if max(len(x), len(y)) == m and edits(x, y) == 1}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and len(a) == len(want)


def test_odd_rows(spark):
    long = "ab" * 150
    rows = [(1, None), (2, ""), (None, "Colours colours"), (3, "Colours colour× colour× colöurs"), (3, "Colours colour× colour× colöurs"),
            (4, f"{long} {long}a {long}"), (5, f"{long}a x{long[1:]}"), (6, "ÀÁÂÃÄÅÆ àáâãäåæ ÀÁÂÃÄÅÆ"), (7, "short words only")]
    assert made(spark, rows) == {r for r in brute(rows)}
    df = spark.createDataFrame([(1, "letters letters", 1, 2, "x")], "doc_id bigint, text string, n int, word int, key string")
    assert [tuple(r)[:4] for r in spelling.group_variants(df).collect()] == [("letters", None, "letters", 2)]
    assert made(spark, []) == set()


def test_very_long_words(spark):
    long = "abc" * 20_000
    rows = [(1, f"{long} {long} {long}"), (2, f"{long}x {long}x {long[:30_000]}y{long[30_001:]} {long[:30_000]}y{long[30_001:]}")]
    got = {(len(r[0]), r[0][30_000]): r[4] for r in made(spark, rows)}
    kept = Counter(run if zlib.crc32(f"{k}:{run}".encode()) % 31 else None for k, t in rows for run in t.split())
    assert None not in kept and got == {(60_000, "a"): 2, (60_001, "a"): 1, (60_000, "y"): 1}
