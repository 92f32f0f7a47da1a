"""Operator 12: the radix tree, and the trie against a plain dictionary."""

import hashlib
import random
import zlib

import pytest

from clickmart.llm import trie
from clickmart.llm.common import read


def brute(rows):
    """The contract, by dictionaries; ``rows`` (conv_id, turn, role, text)."""
    def turn_key(t):
        role, text = t[2] or "", t[3] or ""
        return t[1] is not None, t[1] or 0, hashlib.md5(f"{len(role)} {role}{text}".encode()).digest()

    own = {}
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append(r)
    own = {c: [(t[2] or "", t[3] or "") for t in sorted(ts, key=turn_key)] for c, ts in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + own[c][h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    words = lambda t: len([w for w in t.translate({c: " " for c in range(9, 14)}).split(" ") if w])
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(sums[c][0] for c in children.get(p, [])) or 1
        saved = sum(sums[c][1] for c in children.get(p, [])) + ((len(members[p]) - 1) * words(p[-1][1]) if p else 0)
        sums[p] = (leaves, saved)
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(paths[c]) == len(p)))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=str)


def test_whole_table(spark):
    df = read(spark, "/root/testdata/sf0.001", "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=str) == brute(rows)


def test_shared_beginnings(spark):
    rng = random.Random(5)
    rows = []
    for c in range(-30, 150):
        text = ""
        for t in range(rng.randint(1, 9)):
            text = f"{rng.choice('ab')} {'w ' * (t % 3)}"
            rows.append((c, t, "user" if t % 2 else "assistant", text))
    assert made(spark, rows) == brute(rows)


@pytest.mark.parametrize("limits", [(4, 7), (3, 50)])
def test_long_ones_in_small_trees(spark, monkeypatch, limits):
    """Strings of few turns and trees of few strings: all that is cut meets again."""
    monkeypatch.setattr(trie, "CHUNK", limits[0])
    monkeypatch.setattr(trie, "HELD", limits[1])
    monkeypatch.setattr(trie, "CELL_BITS", 2)
    monkeypatch.setattr(trie, "TEXT", 4)
    rng = random.Random(7)
    rows = []
    for c in range(60):
        line = [f"t{k}" for k in range(rng.choice([1, 5, 14, 30]))]
        if rng.random() < 0.5 and len(line) > 4:
            line[rng.randrange(len(line))] = "other"
        rows += [(c, t, "user", x) for t, x in enumerate(line)]
    assert made(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "late"), (1, None, None, None), (1, 3, "user", "a b"), (1, 3, "user", "a b"), (1, 3, "user", "c"), (2, 0, None, None), (2, 1, "", ""),
            (None, 0, "user", "lost"), (20, 0, "user", "x"), (21, 0, "user", "y"), (39, 5, "user", None), (-7, 0, "user", "n"), (0, 0, "user", "\x0bz z q")]
    assert made(spark, rows) == brute(rows)
    clash = spark.createDataFrame([(c, t, r, x, 1, 2) for c, t, r, x in rows], "conv_id bigint, turn bigint, role string, text string, node int, depth int")
    assert sorted((tuple(r) for r in trie.prefix_trie(clash).collect()), key=str) == brute(rows)
    assert made(spark, []) == []


def test_node_layouts():
    """Nodes grow through all layouts; every string is found with its sums."""
    tree, rng = trie.RadixTree(1), random.Random(3)
    node, sizes = tree.root, []
    keys = [bytes([k]) + rng.randbytes(15) for k in range(256)]
    rng.shuffle(keys)
    for n, key in enumerate(keys, 1):
        tree.add(key, [n], n)
        sizes.append(type(tree.root.kids).__name__ + str(getattr(tree.root.kids, "room", "")))
        assert [b for b, _ in tree.root.kids] == sorted(k[0] for k in keys[:n])
    assert [sizes.index(s) for s in ("Small4", "Small16", "Indexed", "Direct")] == [0, 4, 16, 48]
    assert tree.root is node and all(tree.root.kids.get(k[0]).path == k[1:] for k in keys)


def test_tree_against_a_dictionary():
    rng = random.Random(11)
    turns = [bytes([rng.randrange(3)]) * 15 + bytes([k]) for k in range(4)] + [bytes(15) + bytes([k]) for k in range(30)]
    tree, plain, said = trie.RadixTree(2), {}, {t: k for k, t in enumerate(turns)}
    for n in range(400):
        line = [rng.choice(turns[:5] if d < 2 else turns) for d in range(rng.randint(0, 5))]
        tree.add(trie.ROOT + b"".join(line), [1, n], n)
        for d in range(len(line) + 1):
            plain.setdefault(tuple(line[:d]), []).append((n, d == len(line)))
    found = {}
    for name, _, depth, sums, least, ends, *_ in trie._walk(tree, {trie.ROOT: (0, 0)}, said):
        found[name] = (depth, sums, least, ends[0] if ends else 0)
    want = {}
    for line, held in plain.items():
        name = trie.ROOT
        for t in line:
            name = trie.node_id(name, t)
        want[name] = (len(line), [len(held), sum(n for n, _ in held)], min(n for n, _ in held), sum(e for _, e in held))
    assert found == want
