"""Operators 1, 3 and 10: benchmark passages, languages, toxicity."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import decontaminate, language, toxicity
from clickmart.llm.common import crc, read
from tests.llm import brute


# --- 1: benchmark passages ---------------------------------------------------

def mutated(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.4:
            out[at] = rng.choice("abcdefgh")
        elif kind < 0.7:
            out.insert(at, rng.choice("abcdefgh"))
        else:
            del out[at]
    return "".join(out)


def test_matches_are_those_of_the_edit_distance():
    rng = random.Random(1)
    letters = "abcdefgh"
    items = [(k, "".join(rng.choices(letters, k=rng.randint(30, 120)))) for k in range(8)]
    matcher = decontaminate.Matcher(items, 0.08)
    for _ in range(150):
        k, item = rng.choice(items)
        inside = mutated(rng, item, rng.randint(0, 16))
        text = "".join(rng.choices(letters, k=40)) + inside + "".join(rng.choices(letters, k=40))
        found = {m[0] for m in matcher.find(text)}
        want = {n for n, i in items if brute.edit_distance_in(i, text) <= int(0.08 * len(i))}
        assert found == want


def test_spans_point_into_the_whole_text():
    item = "the quick brown fox jumps over the lazy dog again and again"
    matcher = decontaminate.Matcher([("a", item), ("b", item)], 0.08)
    text = "Élan -- " + item.upper().replace(" ", ", ") + "!! and more"
    found = sorted(matcher.find(text))
    assert [m[0] for m in found] == ["a", "b"] and found[0][3] == 0
    assert decontaminate.normal(text[found[0][1]:found[0][2]]) == item


def test_decontamination_edge_rows(spark):
    items = spark.createDataFrame([(1, "A passage, of the benchmark; it is long enough."), (2, None), (None, "x" * 40), (3, "short"), (4, "")],
                                  "item_id bigint, text string")
    rows = [(1, "before a PASSAGE of the benchmark it is long enough after", "m"), (2, None, "m"), (3, "", "m"), (4, "clean shorter text", "m"),
            (1, "before a PASSAGE of the benchmark it is long enough after", "m"), (None, "a passage of the benchmrk it is long enough", "m"), (5, "-" * 5000, "m")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, matches string")
    kept = decontaminate.decontaminate(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5] and kept.columns == docs.columns and {r.matches for r in kept.collect()} == {"m"}
    found = {(r.doc_id, r.item_id): (r.n_spans, r.distance) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(1, 1): (2, 0), (None, 1): (1, 1)}
    in_groups = decontaminate.match_items(docs, items, group_chars=20)
    assert sorted(F_size(in_groups)) == sorted(F_size(decontaminate.match_items(docs, items)))
    assert decontaminate.contaminated(docs.limit(0), items).collect() == [] and decontaminate.contaminated(docs, items.limit(0)).collect() == []


def test_short_items_match_as_whole_words(spark):
    items = spark.createDataFrame([(1, "Capital of France?"), (2, "42"), (3, "東京の天気"), (4, "?!"), (5, "a passage that is long enough for edits")], "item_id bigint, text string")
    rows = [(1, "What is the CAPITAL of\nFrance -- Paris"), (2, "the capital of Francewoods"), (3, "he has 42."), (4, "in 1942 or 420"), (5, "今日東京の天気は晴れ"), (6, "capital of france"),
            (7, "some pasage that is long enough for edit")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(1, 1): 0, (3, 2): 0, (5, 3): 0, (6, 1): 0, (7, 5): found[7, 5]} and found[7, 5] > 0
    spans = {r.doc_id: rows[r.doc_id - 1][1][r.start:r.end] for r in decontaminate.contaminated(docs, items).collect()}
    assert spans[1] == "CAPITAL of\nFrance" and spans[3] == "42"


def F_size(df):
    return [(r.doc_id or -1, len(r.matches)) for r in df.collect()]


def test_all_exact_passages_are_found(spark, sf_dir):
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    plain = [(r.item_id, decontaminate.normal(r.text).strip()) for r in items.collect()]
    want = {(r.doc_id, k) for r in docs.collect() for k, t in plain if t in decontaminate.normal(r.text or "")}
    assert want and want <= got and len(got) <= 1.1 * len(want) + 2


# --- 3: languages ------------------------------------------------------------

def phrases_by_search(text, sample):
    """Greedy longest phrases that the sample has, ended at block ends."""
    n = 0
    for lo in range(0, len(text), language.BLOCK):
        block, at = text[lo:lo + language.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at:at + size + 1] in sample:
                size += 1
            at, n = at + size, n + 1
    return n


def test_cross_parsing_matches_plain_search():
    rng = random.Random(2)
    texts = {"x": "".join(rng.choices("abc ", k=800)), "y": "".join(rng.choices("bcd ", k=500))}
    model = language.Model(texts)
    queries = ["".join(rng.choices("abcdz ", k=rng.randint(1, 700))) for _ in range(60)]
    bits, known = model.entropy(queries)
    assert np.allclose(known, [sum(c != "z" for c in q) / len(q) for q in queries])
    for k, name in enumerate(model.langs):
        want = [phrases_by_search(q, texts[name]) * np.log2(len(texts[name])) / len(q) for q in queries]
        assert np.allclose(bits[k], want)


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.1", "documents").filter("doc_id % 4 = 0")
    held = crc("doc_id") % 3 == 1
    texts = language.sample(docs.filter(~held))
    got = language.identify(docs.filter(held).select("doc_id", "text", "lang"), texts)
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n > 500 and right >= 0.99 * n


def test_language_edge_rows(spark):
    train = spark.createDataFrame([("en", "the cat and the dog and the house " * 20), ("de", "der hund und die katze und das haus " * 20), (None, "x"), ("fr", None)],
                                  "lang string, text string")
    texts = language.sample(train)
    assert set(texts) == {"de", "en"}
    rows = [(1, "the dog", "a"), (2, None, "a"), (3, "", "a"), (4, "12 -- 34", "a"), (1, "the dog", "a"), (None, "und die katze", "a"), (6, "the house " * 40_000, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    got = sorted(((r.doc_id, r.lang_pred, 0 <= r.score <= 1) for r in language.identify(docs, texts).collect()), key=str)
    assert got == sorted([(1, "en", True), (2, "und", True), (3, "und", True), (4, "und", True), (1, "en", True), (None, "de", True), (6, "en", True)], key=str)
    assert language.identify(docs.limit(0), texts).collect() == []
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}


def test_scripts_do_not_fall_together(spark):
    """Large alphabets are kept whole; a script that no sample has matches nothing."""
    rng = random.Random(4)
    signs = {"zh": range(0x4E00, 0x4E00 + 2500), "ko": range(0xAC00, 0xAC00 + 2000), "th": range(0x0E01, 0x0E2E)}
    words = {x: ["".join(chr(rng.choice(r)) for _ in range(rng.randint(1, 3))) for _ in range(3000)] for x, r in signs.items()}
    line = lambda x, n: " ".join(rng.choices(words[x], k=n))
    rows = [(x, line(x, 200)) for x in signs for _ in range(60)] + [("en", "the cat and the dog and the house " * 20), ("de", "der hund und die katze und das haus " * 20)]
    texts = language.sample(spark.createDataFrame(rows, "lang string, text string"))
    assert set(texts) == {"zh", "ko", "th", "en", "de"} and len(set("".join(texts.values()))) > 4000
    asked = [(x, line(x, 40)) for x in signs for _ in range(10)] + [("en", "the dog and the cat"), ("de", "die katze und der hund")]
    unseen = [("?", "".join(chr(rng.randrange(0x0561, 0x0587)) for _ in range(100)))]
    got = language.identify(spark.createDataFrame(asked + unseen, "lang string, text string"), texts).collect()
    assert all(r.lang == r.lang_pred for r in got if r.lang != "?")
    assert [r.score < 0.5 for r in got if r.lang == "?"] == [True]


def test_tables_hold_the_edges_of_the_automaton():
    rng = random.Random(6)
    codes = np.array([rng.choice([1, 2, 3, 40, 500, rng.randrange(1, 3000)]) for _ in range(3000)])
    edges = language.automaton(codes)
    table = language.Table(edges, 3001)
    assert len(table.owner) < 2 * sum(map(len, edges)) + 3 * 3001
    for s in range(1, len(edges)):
        asked = np.array([*edges[s], *rng.sample(range(3001), 5)])
        got, fresh = table.step(np.full(len(asked), s), asked)
        for c, to, new in zip(asked.tolist(), got.tolist(), fresh.tolist(), strict=True):
            assert (to, new) == ((edges[s][c], False) if c in edges[s] else (edges[0].get(c, table.between), True))


def test_sample_is_bounded(spark, sf_dir):
    texts = language.sample(read(spark, sf_dir, "documents"), 2_000, 5)
    assert texts and all(len(t) <= 2_000 for t in texts.values())


# --- 10: toxicity ------------------------------------------------------------

def test_nearest_are_exact():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(300):
        ids = np.unique(rng.integers(0, 60, rng.integers(1, 12)))
        w = rng.random(len(ids))
        vectors.append((ids, w / np.sqrt((w * w).sum())))
    index = toxicity.Index(vectors, 60)
    dense = np.zeros((300, 60))
    for k, (ids, w) in enumerate(vectors):
        dense[k, ids] = w
    for ids, w in vectors[::11]:
        near, cosine = index.nearest(ids, w, 10)
        want = dense[:, ids] @ w
        assert np.allclose(cosine, np.sort(want)[::-1][:10][:len(cosine)])
        assert np.allclose(want[near], cosine)


def test_lists_and_rows_are_read_in_one_piece():
    """Rare and common terms, examples without a list, vectors of unknown reach; an entry of a list is 8 bytes."""
    rng = np.random.default_rng(8)
    vectors = []
    for k in range(400):
        ids = np.unique(np.concatenate([rng.integers(0, 5, 2), rng.integers(5, 3000, rng.integers(0, 30))]))
        w = rng.random(len(ids))
        vectors.append((ids, w / np.sqrt((w * w).sum())))
    index = toxicity.Index(vectors, 3000)
    assert index.lists.nbytes == 8 * len(index.lists) and len(index.matrix) >= 5
    dense = np.zeros((400, 3000))
    for k, (ids, w) in enumerate(vectors):
        dense[k, ids] = w
    asked = [*vectors[::7], (np.array([3]), np.ones(1)), (np.zeros(0, np.int64), np.zeros(0))]
    for (ids, w), (near, cosine) in zip(asked, index.nearest_of(asked, 25), strict=True):
        want = dense[:, ids] @ w
        order = np.lexsort((np.arange(400), -np.round(want, 12)))[:25]
        assert np.allclose(cosine, want[order][want[order] > 0][:len(cosine)]) and np.allclose(want[near], cosine)
        assert len(near) == min(25, (want > 0).sum())


def test_toxic_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    held = crc("doc_id") % 5 == 0
    model = toxicity.fit(docs, labels.filter(~held))
    got = toxicity.toxicity(docs.select("doc_id", "text"), model).join(labels.filter(held), "doc_id")
    toxic, clean = got.filter("toxic = 1"), got.filter("toxic = 0")
    assert toxic.filter("predicted = 1").count() >= 0.85 * toxic.count()
    assert clean.filter("predicted = 1").count() <= 0.04 * clean.count()
    assert toxic.filter("predicted = 1 and size(evidence) > 0").count() > 0


def test_toxicity_edge_rows(spark):
    bad, good = "you vile rotten fool", "a calm walk in the green park"
    rows = [(k, f"{bad if k % 2 else good} number{k}") for k in range(40)]
    docs = spark.createDataFrame([*rows, (100, None), (101, ""), (None, bad), (102, bad), (102, bad), (103, good * 5000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(0, 0), (None, 1), (7, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    assert got[102].predicted == 1 and got[None].predicted == 1 and got[103].predicted == 0
    assert got[100].score == got[101].score == model.prior and got[100].evidence == []
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), model).collect() == []


def test_rare_terms_and_all_examples_count(spark):
    rows = [(k, f"plain text about topic{k % 7} and number{k}", 0) for k in range(60)] + [(60 + k, f"plain text about topic{k} grudzle number{60 + k}", 1) for k in range(3)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, "text about a grudzle"), (901, "plain topic3")], "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int"))
    assert model.example_ids == [r[0] for r in rows] and len(model.ids) == len({t for r in rows for t in toxicity.terms_of(r[1])})
    got = {r.doc_id: r for r in toxicity.toxicity(docs, model).filter("doc_id >= 900").collect()}
    assert got[900].score > model.prior and {e.doc_id for e in got[900].evidence[:3]} == {60, 61, 62}
    assert len(got[901].evidence) == toxicity.NEIGHBOURS and got[901].score < model.prior
