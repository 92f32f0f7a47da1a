"""Operators 2 and 4: repeated byte strings and word windows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import suffixes, windows
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, spans string"  # a column whose name clashes


def corpus(rng, n=40):
    alphabet = "a b c d e f gamma delta été ß".split()
    shared = [" ".join(rng.choices(alphabet, k=rng.randint(5, 60))) for _ in range(5)]
    docs = []
    for k in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(rng.randint(0, 4))]
        docs.append((k, rng.choice([" ", "\n", "\t "]).join(parts)))
    docs += [(n, None), (n + 1, ""), (n + 2, "   \n "), (n + 3, "a" * 3000), (n + 4, "a " * 500), (n + 5, docs[3][1]), (3, docs[3][1]),
             (None, docs[4][1]), (5, "other text of a row with the same id " * 3)]
    rng.shuffle(docs)
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x") for d, t in docs], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windows_match_brute_force(spark, seed):
    docs = corpus(random.Random(seed))
    got = windows.remove_windows(frame(spark, docs), 13, ["doc_id"]).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.window_dedup(docs, 13)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size", [2, 5])
def test_other_window_sizes(spark, seed, size):
    docs = corpus(random.Random(seed), 20)
    got = windows.remove_windows(frame(spark, docs), size, ["doc_id"]).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.window_dedup(docs, size)


@pytest.mark.parametrize("seed,length", [(1, 40), (2, 40), (3, 100), (4, 400)])
def test_bytes_match_brute_force(spark, seed, length):
    docs = corpus(random.Random(seed))
    got = suffixes.remove_repeats(frame(spark, docs), length, ["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint"), F.sha2("kept", 256))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.byte_dedup(docs, length)


def test_crowded_runs_are_compared_string_by_string(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "TOGETHER", 1)
    monkeypatch.setattr(suffixes, "HEAVY", 2)
    docs = corpus(random.Random(9))
    got = suffixes.remove_repeats(frame(spark, docs), 100, ["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint"), F.sha2("kept", 256))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.byte_dedup(docs, 100)


def test_heavy_runs_of_windows(spark, monkeypatch):
    monkeypatch.setattr(windows, "HEAVY", 2)
    docs = corpus(random.Random(8))
    got = windows.remove_windows(frame(spark, docs), 13, ["doc_id"]).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.window_dedup(docs, 13)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 1000)
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefgh ", k=9000))
    docs = [(1, long), (2, long[2500:4200] + "x" * 50), (3, "y" * 10 + long[8000:]), (4, "z")]
    got = suffixes.remove_repeats(frame(spark, docs), 400, ["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint"), F.sha2("kept", 256))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.byte_dedup(docs, 400)


def test_any_number_of_batches_gives_the_same(spark):
    docs = corpus(random.Random(6), 25)
    rows = [sorted(map(str, suffixes.remove_repeats(frame(spark, docs), 60, ["doc_id"], batches=b).drop("kept").collect())) for b in (1, 5)]
    assert rows[0] == rows[1]


def test_spans_and_kept_text(spark):
    shared = " ".join(f"w{k}" for k in range(20))
    docs = [(1, shared), (2, "start " + shared + " end")]
    row = windows.remove_windows(frame(spark, docs), 13).filter("doc_id = 2").first()
    assert [(s.start, s.end) for s in row.spans] == [(1, 21)] and row.kept == "start end" and row.text == docs[1][1]


def test_empty_tables(spark):
    empty = frame(spark, []) if False else spark.createDataFrame([], SCHEMA)
    assert windows.remove_windows(empty).collect() == [] and suffixes.remove_repeats(empty).collect() == []


def test_minima_choose_the_first_of_equals():
    keys = np.array([5, 3, 3, 9, 1, 7], np.uint64) << np.uint64(40)
    assert windows.window_minima(keys, 3).tolist() == [1, 1, 4, 4]
