"""Operator 11: sequences under three limits, against the plain tokenizer."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickmart.llm import packing, queries
from clickmart.llm.common import read

PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def plain(texts):
    return [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def power(n):
    return n & (n - 1) == 0


def check(rows, limits):
    """Every sequence within its limits, gapless, and nearly full or a power of two; ids by example."""
    by_seq, by_doc = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        bears = np.unpackbits(np.frombuffer(r.mask, np.uint8), count=len(ids), bitorder="little")
        assert len(ids) == r.length > 0 and bears.sum() == r.loss
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append((r.start, ids.tolist(), bears.tolist(), r.doc_tokens))
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and (at >= limits.tokens - limits.waste or power(at))
        assert len(pieces) <= limits.segments and sum(p.loss for p in pieces) <= limits.loss
    return by_doc


def joined(parts):
    ids, bears, total = [], [], parts[0][3]
    for start, i, b, n in sorted(parts):
        assert start == len(ids) and n == total
        ids += i
        bears += b
    assert len(ids) == total
    return ids, bears


def test_whole_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    limits = packing.Limits()
    by_doc = check(packing.pack(packing.as_examples(docs), PATH).collect(), limits)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    want = dict(zip(texts, plain(list(texts.values())), strict=True))
    assert {d: joined(p)[0] for d, p in by_doc.items()} == {d: [*ids, 1] for d, ids in want.items()}
    got = {(r.doc_id, r.start): r for r in queries.op11_vector_packing(spark, sf_dir).collect()}
    for (d, start), r in got.items():
        piece = np.array([*want[d], 1], "<u4")[start:start + r.length]
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(want[d]) + 1
    assert sum(r.length for r in got.values()) == sum(len(w) + 1 for w in want.values())


@pytest.mark.parametrize("limits", [packing.Limits(64, 3, 40, 2), packing.Limits(32, 100, 5, 0), packing.Limits(16, 1, 16, 0), packing.Limits(1, 1, 1, 0)])
def test_instruction_limits(spark, limits):
    examples = []
    for k in range(200):
        ask, say = "please tell me more about it " * (k % 7), "here is what we know of that " * (k * 13 % 11)
        examples.append((k, [(ask, False), (say, True)]))
    df = spark.createDataFrame(examples, "doc_id bigint, parts array<struct<text:string,loss:boolean>>").coalesce(2)
    by_doc = check(packing.pack(df, PATH, 2, limits).collect(), limits)
    for k, parts in examples:
        (ask, say), (ids, bears) = plain([parts[0][0], parts[1][0]]), joined(by_doc[k])
        assert ids == [*ask, *say, 2] and bears == [0] * len(ask) + [1] * (len(say) + 1)


def test_little_padding_and_few_cuts(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").coalesce(1)
    rows = packing.pack(packing.as_examples(docs), PATH)
    fill = rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    padding = sum(2048 - r.n for r in fill if not power(r.n))
    assert padding <= 0.005 * sum(r.n for r in fill)
    assert sum(r.n < 2040 for r in fill) <= 12  # the end of the split, in powers of two
    short = rows.filter("doc_tokens <= 2048").groupBy("doc_id").count()
    assert short.filter("count > 1").count() < 0.3 * short.count()


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "", "x"), (None, "two words", "y"), (None, "two words", "y"), (4, "word " * 30_000, None), (4, "word " * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").coalesce(1)
    found = packing.pack(packing.as_examples(df), PATH).collect()
    assert sum(r.length for r in found) == 1 + 1 + 2 * 3 + 2 * 30_001
    assert {r.doc_tokens for r in found if r.doc_id is None} == {1, 3}
    parts = spark.createDataFrame([(1, None, 5), (2, [], 5), (3, [None, (None, None), ("a b", None)], 5)],
                                  "doc_id bigint, parts array<struct<text:string,loss:boolean>>, length int")
    got = {r.doc_id: r for r in packing.pack(parts.coalesce(1), PATH).collect() if r.doc_id != 3}
    assert got[1].length == got[2].length == 1 and got[1].loss == 1
    third = [r for r in packing.pack(parts.coalesce(1), PATH).collect() if r.doc_id == 3]
    assert sum(r.length for r in third) == 3 and sum(r.loss for r in third) == 0
    assert packing.pack(packing.as_examples(df.limit(0)), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.Limits(0)
