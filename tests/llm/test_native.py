"""Operators 6, 7 and 9: surrogates, mixing, quality rules; none runs Python."""

import contextlib
import io
import random
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from clickmart.llm import mixing, quality, queries, surrogates
from clickmart.llm.common import read, stage
from tests.llm import brute

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op6_surrogates", "op7_mix_sources", "op9_quality_rules"])
def test_plans_run_no_python(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries.queries()[name](spark, SMOKE).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", out.getvalue())


# --- 6: surrogates -----------------------------------------------------------

def replaced(spark, texts, **more):
    df = spark.createDataFrame([(k, t, "m") for k, t in enumerate(texts)], "doc_id bigint, text string, n_entities string")
    return {r.doc_id: r for r in surrogates.replace_entities(df, **more).collect()}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def iban_ok(text):
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def test_types_keep_their_form(spark):
    texts = ["mail Jane.Doe7@Mail.example.com now", "card 4111 1111 1111 1111 ok", "card 4111111111111112 bad", "DE89 3704 0044 0532 0130 00", "ip 10.1.2.3 or 8.8.8.8",
             "call +1 (555) 123-4567", "ssn 123-45-6789", 'key "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"', "Господин Иван Петров пришел"]
    got = replaced(spark, texts)
    assert all(got[k].n_entities >= 1 and got[k].text != t for k, t in enumerate(texts))
    assert re.fullmatch(r"mail [A-Z][a-z]{3}\.[A-Z][a-z]{2}\d@[A-Z][a-z]{3}\.[a-z]{7}\.com now", got[0].text)
    card = re.search(r"\d{4}( \d{4}){3}", got[1].text)[0]
    assert card[4] == card[9] == " " and luhn(card.replace(" ", "")) == 0
    assert luhn(re.search(r"\d{16}", got[2].text)[0]) == luhn("4111111111111112")
    assert got[3].text.startswith("DE") and iban_ok(got[3].text)
    assert re.fullmatch(r"ip 10(\.\d{1,3}){3} or \d{1,3}(\.\d{1,3}){3}", got[4].text) and "8.8.8.8" not in got[4].text
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}", got[5].text)
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}", got[6].text)
    assert re.fullmatch(r'key "[0-9a-f]{40}"', got[7].text)
    assert re.fullmatch(r"Господин [А-Я][а-я]+ [А-Я][а-я]+ пришел", got[8].text)


def test_coreference_gender_and_distinctness(spark):
    got = replaced(spark, ["Mr. John Smith met Mrs. Smith.", "MR is no title; Mr. Smith left. Mrs. Joan Miller stayed.", "a@b.example.com A@B.example.com c@b.example.com",
                           "+1 (555) 123-4567 and +1 555.123.4567"])
    last = re.match(r"Mr\. (\w+) (\w+) met Mrs\. (\w+)\.", got[0].text)
    assert last and last[2] == last[3] and f"Mr. {last[2]} left" in got[1].text
    assert last[1] in surrogates.GIVEN["m", "latin"].split()
    assert re.search(r"Mrs\. (\w+) ", got[1].text)[1] in surrogates.GIVEN["f", "latin"].split()
    a, b, c = got[2].text.split()
    assert a.lower() == b.lower() != c.lower()
    one, two = got[3].text.split(" and ")
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two)


def test_surrogates_are_one_to_one_and_nobody_s(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "ROUNDS_BEFORE_GROWTH", 2)
    # 60 of the 100 numbers occur, so draws meet them and each other.
    parts = spark.createDataFrame([("phone", f"1{k:02d}") for k in range(60)], "type string, canon string")
    got = surrogates.assign(parts, "k").collect()
    said = [r.surrogate for r in got]
    assert len(got) == 60 and len(set(said)) == 60
    assert not set(said) & {r.canon for r in got}


def test_keys_and_runs(spark):
    texts = ["x@y.example.com"]
    one, two, other = (replaced(spark, texts, key=k)[0].text for k in ("a", "a", "b"))
    assert one == two != other


def test_surrogate_edge_rows(spark):
    texts = [None, "", "nothing to see", "x " * 20_000 + "a@b.example.com", "a@b.example.com"]
    got = replaced(spark, texts)
    assert got[0].text is None and got[1].text == "" and got[2].text == texts[2]
    assert [got[k].n_entities for k in range(5)] == [0, 0, 0, 1, 1]
    assert got[3].text.split()[-1] == got[4].text and got[3].text.startswith("x x x")
    df = spark.createDataFrame([(1, texts[4]), (1, texts[4]), (None, texts[4])], "doc_id bigint, text string")
    assert len({r.text for r in surrogates.replace_entities(df).collect()}) == 1
    assert surrogates.replace_entities(df.limit(0)).collect() == []


def test_no_found_entity_stays(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    got = surrogates.replace_entities(docs).withColumnRenamed("text", "new").join(docs, "doc_id")
    for r in got.filter("n_entities > 0").collect():
        for found in re.findall(r"[\w.]+@[\w.]+\.\w+|\b[0-9a-f]{40}\b|\b\d{16}\b|\+\d \(\d{3}\) \d{3}-\d{4}", r.text):
            assert found not in r.new
    assert got.filter("n_entities = 0 and new <> text").count() == 0


# --- 7: mixing ---------------------------------------------------------------

def mixed(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target string").repartition(3)
    return mixing.mix_sources(df, **more).collect()


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_budgets(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "ä", "z", None, ""]
    rows = [(k, " ".join("w" * rng.randint(0, 30)), rng.choices(names, [30, 5, 1, 1, 2, 3, 1])[0], "x") for k in range(150)]
    got = mixed(spark, rows)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = brute.mix_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert abs(mine[0].target - want[s]) < 1e-3 and {r.source_size for r in mine} == {sizes[s]}
        assert abs(sum(r.taken for r in mine) - want[s]) <= 1
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixed(spark, rows)))
    whole = mixed(spark, rows, boundary="whole")
    assert all(r.taken % max(1, r.size) == 0 for r in whole)
    for s in sizes:
        assert abs(sum(r.taken for r in whole if r.source == s) - want[s]) <= 30


def test_mix_edge_rows(spark):
    rows = [(1, None, "a", "x"), (1, "", "a", "x"), (None, "one two", "a", "x"), (None, "one two", "a", "x"), (2, "w " * 50_000, None, "x")]
    got = mixed(spark, rows)
    assert sorted(r.size for r in got) == [0, 0, 2, 2, 50_000]
    assert sum(r.taken for r in got if r.source == "a") == 12
    assert mixed(spark, [(1, None, "a", "x")])[0].target == 0
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix_sources(empty).collect() == [] and mixing.apply_mix(mixing.mix_sources(empty, boundary="whole")).collect() == []


def test_apply_mix_repeats_rows(spark):
    rows = [(k, "w w", "a", "x") for k in range(4)] + [(9, "w " * 40, "b", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target string").drop("target")
    plan = mixing.mix_sources(df, boundary="whole")
    want = {r.doc_id: r.taken // r.size for r in plan.collect()}
    got = mixing.apply_mix(plan)
    assert got.columns == df.columns
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == {k: n for k, n in want.items() if n}


# --- 9: quality rules --------------------------------------------------------

def test_base_counts_match_brute_force(spark):
    rng = random.Random(7)
    texts = [None, "", " \n ", "a b c", "a b c a b c", "x\nx\n\n \nx y\nx"] + [
        "".join(rng.choices(["a", "b", "é", " ", "\n", "#", "|", "\t", " "], k=rng.randint(1, 400))) for _ in range(80)] + ["p q r s t " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in quality.base_counts(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(texts[r.doc_id])


def test_many_repeated_windows(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefgh", k=600)) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for few in (0, 64):
        monkeypatch.setattr(quality, "FEW", few)
        for r in quality.base_counts(df).collect():
            assert r.n_repeat_words == brute.base_counts(texts[r.doc_id])[4]


def test_quality_labels(spark):
    sf = "/root/testdata/sf0.1"
    judged = stage(quality.quality(read(spark, sf, "documents")).drop("text"), "judged")  # see the docstring of quality
    got = judged.filter("not base_failed").join(read(spark, sf, "labels"), "doc_id")
    share = {r.quality: (r.kept, r.n) for r in got.groupBy("quality").agg(F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("n")).collect()}
    assert share[1][0] >= 0.99 * share[1][1] and share[0][0] <= 0.05 * share[0][1]


def test_quality_runs_no_python(spark):  # the query returns a written table, so its own plan would not show it
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        quality.quality(read(spark, SMOKE, "documents")).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", buf.getvalue())


def test_quality_query_can_be_filtered_joined_and_grouped(spark, sf_dir):
    judged = queries.op9_quality_rules(spark, sf_dir)
    began = time.time()
    kept = judged.filter("not base_failed and n_repeat_words >= 0 and kept").join(read(spark, sf_dir, "labels"), "doc_id")
    shares = kept.groupBy("quality").count().collect()
    assert time.time() - began < 30 and sum(r["count"] for r in shares) > 0
    assert judged.count() == read(spark, sf_dir, "documents").count()


def test_quality_edge_rows(spark):
    plain = "the cat sat on the mat and looked at the small bird in the tree " * 2
    rows = [(k, " ".join(random.Random(k).sample(plain.split() * 4, 100)), "en", "m") for k in range(20)]
    rows += [(50, None, "en", "m"), (51, "", None, "m"), (52, rows[0][1], "xx", "m"), (53, "#$ " * 60, "en", "m"), (0, rows[0][1], "en", "m"), (None, rows[0][1], None, "m")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, kept string")
    got = quality.quality(df).collect()
    assert len(got) == len(rows)
    assert all(r.kept is False for r in got if r.doc_id in (50, 51, 53)) and all(isinstance(r.kept, bool) for r in got)
    assert quality.quality(df.limit(0)).collect() == []
    alone = quality.quality(spark.createDataFrame([(1, "one two", "en")], "doc_id bigint, text string, lang string")).first()
    assert alone.class_distance is None and alone.kept is False


def test_junk_with_rates_of_capitals_and_stops_like_prose_goes(spark):
    numbers = " ".join(str(1000 + 37 * k) for k in range(300))
    signs = " ".join(f"====={k}. ~~~~{k * 7} ____{k * 3}" for k in range(100))
    words = "The cat sat on a mat. It looked at some small bird in that tree, and the dog ran off with his old bone to the house of my aunt".split()
    rows = [(k, ". ".join(" ".join(random.Random(k * 50 + j).sample(words, 15)) for j in range(6)), "en") for k in range(20)]
    df = spark.createDataFrame([*rows, (100, numbers, "en"), (101, signs, "en")], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in quality.quality(df).collect()}
    assert not any(got[k].base_failed for k in (100, 101))
    assert all(got[k].class_distance > 0.5 and not got[k].kept for k in (100, 101))
    assert all(got[k].class_distance < 0.1 for k in range(20))


def test_class_counts_match_plain_counting(spark):
    texts = [None, "", "Ab 1é 　!#=~\t\n.́", "中文 ǅ ٣ _@/[]{}+�\x1c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df = quality.base_counts(df).withColumn("__blanks", F.char_length(F.coalesce("text", F.lit(""))) - F.col("word_chars"))
    for r in df.select("doc_id", *quality._class_counts(F.col("__blanks"))).collect():
        t = texts[r.doc_id] or ""
        kind = [unicodedata.category(c) for c in t]
        space = [c.isspace() for c in t]
        want = (kind.count("Lu"), sum(k[0] in "LM" and k != "Lu" for k in kind), kind.count("Nd"), sum(space),
                sum(c in ".,;:?'()-" for c in t), sum(c in "#*$%&|<>!" for c in t), len(t))
        assert tuple(r)[1:] == want
