"""The prefix trie of conversations, from adaptive radix trees.

A turn's id is the 16-byte hash of its role and text, so a conversation is a
string of fixed-width ids.  A task puts the strings of its rows into an adaptive
radix tree: nodes hold a compressed path and grow from 4 to 16, 48 and 256
children.  Branches may lie at any byte; only depths at the end of a turn are
nodes of the trie.  A task's tree is a partial sum: what it emits per node is
added up by node, so a first turn that a third of all conversations share costs
one row per task.

Long conversations are strings of up to ``CHUNK`` turns each, which begin with
the id of the node where the string before ended.  A node's id is the hash of
its parent's id and its turn's, so it is the same in every task.

The sums over subtrees need each node once.  Every node belongs to its smallest
member, which also owns all deeper nodes of its path; so each conversation shares
a beginning of its path and owns the rest, and one number says where.  A second
round of trees adds up the words of the shared beginnings.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import GAP, Work, crc, stage

WIDTH = 16                # bytes of an id
CHUNK = 512               # turns of one string at most
CELL_BITS = 9             # turn numbers alike above these bits are gathered in one row
HEADS = 4                 # conversations take 0 to 3 turns of another
FAMILY = 20               # whose id is the next lower multiple of this
HELD = 200_000            # turns that a task's tree holds
TEXT = 1 << 20            # bytes of one piece of a digest's text
ROOT = bytes(WIDTH)


# --- the tree ----------------------------------------------------------------

class Small:
    """Up to 4, then up to 16 children, found among their sorted bytes."""

    __slots__ = ("room", "keys", "kids")

    def __init__(self, room: int = 4):
        self.room, self.keys, self.kids = room, bytearray(), []

    def get(self, byte: int):
        k = self.keys.find(byte)
        return self.kids[k] if k >= 0 else None

    def put(self, byte: int, kid):
        """The layout that holds the new child: this one or the next larger."""
        if len(self.keys) == self.room:
            if self.room == 16:
                return Indexed(self).put(byte, kid)
            self.room = 16
        k = bisect_left(self.keys, byte)
        self.keys.insert(k, byte)
        self.kids.insert(k, kid)
        return self

    def __iter__(self) -> Iterator:
        return zip(self.keys, self.kids, strict=True)


class Indexed:
    """Up to 48 children behind an index of 256 bytes."""

    __slots__ = ("index", "kids")
    NONE = 255

    def __init__(self, smaller: Small):
        self.index, self.kids = bytearray([self.NONE]) * 256, []
        for byte, kid in smaller:
            self.put(byte, kid)

    def get(self, byte: int):
        k = self.index[byte]
        return self.kids[k] if k != self.NONE else None

    def put(self, byte: int, kid):
        if len(self.kids) == 48:
            return Direct(self).put(byte, kid)
        self.index[byte] = len(self.kids)
        self.kids.append(kid)
        return self

    def __iter__(self) -> Iterator:
        return ((b, self.kids[k]) for b, k in enumerate(self.index) if k != self.NONE)


class Direct:
    """A place for each of 256 children."""

    __slots__ = ("kids",)

    def __init__(self, smaller: Indexed):
        self.kids = [None] * 256
        for byte, kid in smaller:
            self.kids[byte] = kid

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def __iter__(self) -> Iterator:
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


class Node:
    """A compressed path, children, and the sums of the strings that end here."""

    __slots__ = ("path", "kids", "sums", "least")

    def __init__(self, path: bytes, kids, sums: list | None, least: int | None):
        self.path, self.kids, self.sums, self.least = path, kids, sums, least

    def ends(self, sums: list, least: int) -> None:
        if self.sums is None:
            self.sums, self.least = list(sums), least
        else:
            self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
            self.least = min(self.least, least)


class RadixTree:
    """Byte strings with sums; a string may be the beginning of another."""

    def __init__(self, n_sums: int):
        self.root, self.n_sums = Node(b"", Small(), None, None), n_sums

    def add(self, key: bytes, sums: list, least: int) -> None:
        node, at = self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                same = 0
                while at + same < len(key) and path[same] == key[at + same]:
                    same += 1
                below = Node(path[same + 1:], node.kids, node.sums, node.least)
                node.path, node.kids, node.sums, node.least = path[:same], Small().put(path[same], below), None, None
            at += len(node.path)
            if at == len(key):
                node.ends(sums, least)
                return
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids = node.kids.put(key[at], Node(key[at + 1:], Small(), list(sums), least))
                return
            node, at = kid, at + 1


def node_id(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=WIDTH).digest()


# --- conversations -----------------------------------------------------------

def _families(conversations: DataFrame) -> DataFrame:
    """Rows of bounded size: family, own (whether this is the family's first
    conversation), conv_id, n_head, cell, turns (id, words, copies) in order."""
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    words = F.size(F.array_remove(F.split(text, GAP), ""))
    turn = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(" "), role, text).cast("binary")))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), turn.alias("id"), words.alias("words"))
    # A cell has at most 2 ** CELL_BITS turn numbers; rows without a number are dealt by the hash that orders them.
    rows = rows.groupBy("conv_id", "turn", "id").agg(F.count(F.lit(1)).alias("copies"), F.first("words").alias("words"))
    part = F.when(F.col("turn").isNull(), F.hex(F.substring("id", 1, 1)))
    rows = rows.groupBy("conv_id", F.shiftright("turn", CELL_BITS).alias("cell"), part.alias("part"))
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words", "copies"))).alias("turns"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    return rows.select(family.alias("family"), (family == F.col("conv_id")).alias("own"), "conv_id", (crc("conv_id") % HEADS).cast("int").alias("n_head"),
                       "cell", "part", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"), t["copies"].alias("copies"))).alias("turns"))


STRINGS = "conv_id bigint, start_depth bigint, start binary, turns binary, words array<int>, start_words bigint, ended boolean, end binary"


def _rebuild(batches):
    """Rows sorted by family, its first conversation before the others, cells in
    order; yields the strings of the rebuilt conversations."""
    import pyarrow as pa

    names = [f.split()[0] for f in STRINGS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.bool_(), pa.binary()]
    found: list[tuple] = []

    def out():
        rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)
        found.clear()
        return rows

    family = conv = None
    head: list = []            # the first turns of the family's first conversation
    depth = said = seen = skip = 0
    start, ids, words = ROOT, [], []

    def flush(ended: bool) -> None:
        nonlocal depth, said, start, ids, words
        end = start
        for turn in ids:
            end = node_id(end, turn)
        found.append((conv, depth, start, b"".join(ids), words, said, ended, end))
        depth, said, start, ids, words = depth + len(ids), said + sum(words), end, [], []

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("family", "own", "conv_id", "n_head", "turns")), strict=True)

    for of, own, c, n_head, turns in rows():
        if c != conv:
            if conv is not None:
                flush(True)
            if of != family:
                family, head = of, []
            conv, depth, said, start, seen = c, 0, 0, ROOT, 0
            skip = 0 if own else n_head
            ids, words = [t for t, _ in head[:skip]], [w for _, w in head[:skip]]
        for t in turns:
            for _ in range(t["copies"]):
                if own and len(head) < HEADS - 1:
                    head.append((t["id"], t["words"]))
                seen += 1
                if seen > skip:
                    if len(ids) == CHUNK:  # only before a further turn: no last string is empty
                        flush(False)
                        if len(found) >= 1000:
                            yield out()
                    ids.append(t["id"])
                    words.append(t["words"])
        if len(found) >= 1000:
            yield out()
    if conv is not None:
        flush(True)
        yield out()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Strings of the rebuilt conversations, see STRINGS; the last one of a
    conversation is ``ended``, and empty only where the conversation has no turns."""
    rows = _families(conversations).repartition("family")
    rows = rows.sortWithinPartitions("family", F.col("own").desc(), "conv_id", F.col("cell").asc_nulls_first(), F.col("part").asc_nulls_first())
    return rows.mapInArrow(_rebuild, STRINGS)


# --- nodes -------------------------------------------------------------------

def _walk(tree: RadixTree, begun: dict, said: dict) -> Iterator[tuple]:
    """The trie's nodes in a tree, children first: id, parent's id, depth, sums over
    all strings that begin with it, their least number, sums of those that end
    there or None, words of the last turn and of the whole path, and the words of
    the subtree, each node's as often as its second sum says.

    Only depths that end a turn count.  The first id of a string is the node that
    it starts from; ``begun`` has that node's depth and words."""
    todo = [(tree.root, b"", None, 0, 0, None)]
    totals: dict[int, tuple[list, int | None, int]] = {}
    while todo:
        node, tail, above, depth, cum, rows = todo.pop()
        if rows is None:
            data, rows = tail + node.path, []
            whole = len(data) - len(data) % WIDTH
            for at in range(0, whole, WIDTH):
                turn = data[at:at + WIDTH]
                if above is None:
                    name, (depth, cum), words = turn, begun[turn], 0
                else:
                    name, depth, words = node_id(above, turn), depth + 1, said[turn]
                    cum += words
                rows.append((name, above, depth, words, cum))
                above = name
            todo.append((node, tail, above, len(data) == whole, cum, rows))
            todo += [(kid, data[whole:] + bytes([b]), above, depth, cum, None) for b, kid in node.kids]
            continue
        aligned = depth
        sums, least, below = list(node.sums or [0] * tree.n_sums), node.least, 0
        for _, kid in node.kids:
            more, low, under = totals.pop(id(kid))
            sums = [a + b for a, b in zip(sums, more, strict=True)]
            least = low if least is None else min(least, low)
            below += under
        ends = node.sums if aligned else None
        for name, parent, depth, words, cum in reversed(rows):
            below += words * sums[1]
            if parent is not None or depth == 0:  # other first ids are the ends of the strings before
                yield name, parent, depth, sums, least, ends, words, cum, below
            ends = None
        totals[id(node)] = (sums, least, below)


def _partial(batches, sums_of, n_sums, emit, schema):
    """Trees over the rows of a task, each of bounded size; ``sums_of`` gives the
    (turns, sums) to put in for a row, ``emit`` a row of ``schema`` for what
    ``_walk`` yields, or None."""
    import pyarrow as pa

    tree, begun, said, held = RadixTree(n_sums), {}, {}, 0

    def out():
        found: list[tuple] = []
        for node in _walk(tree, begun, said):
            row = emit(*node)
            if row is not None:
                found.append(row)
            if len(found) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
                found.clear()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            start, turns = row["start"], row["turns"]
            begun[start] = (row["start_depth"], row["start_words"])
            for k, w in enumerate(row["words"]):
                said[turns[WIDTH * k:WIDTH * (k + 1)]] = w
            for n, sums in sums_of(row):
                tree.add(start + turns[:WIDTH * n], sums, row["conv_id"])
            held += len(row["words"]) + 1
            if held >= HELD:
                yield from out()
                tree, begun, said, held = RadixTree(n_sums), {}, {}, 0
    if held:
        yield from out()


MEMBERS = "node binary, parent binary, depth bigint, n_convs bigint, n_ended bigint, conv_id bigint, words bigint, said bigint"
SUBTREES = "node binary, n_leaves bigint, saved_tokens bigint"


def _members(batches):
    import pyarrow as pa

    schema = pa.schema([(f.split()[0], pa.binary() if f.endswith("binary") else pa.int64()) for f in MEMBERS.split(", ")])

    def sums_of(row):
        yield len(row["words"]), [1, int(row["ended"])]

    def emit(node, parent, depth, sums, least, ends, words, cum, below):
        return node, parent, depth, sums[0], ends[1] if ends else 0, least, words, cum

    yield from _partial(batches, sums_of, 2, emit, schema)


def _subtrees(batches):
    """Rows with first_own (depth from which on the conversation owns its nodes),
    own_said (words before that) and leaf (whether it owns a childless node)."""
    import pyarrow as pa

    schema = pa.schema([("node", pa.binary()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])

    def sums_of(row):  # leaves, whether it shares the turn with the owner, words that it shares beyond this string
        n, words = len(row["words"]), row["words"]
        if row["leaf"]:
            yield n, [1, 0, 0]
        shares = min(n, row["first_own"] - 1 - row["start_depth"])
        if shares > 0:
            yield shares, [0, 1, max(0, row["own_said"] - row["start_words"] - sum(words))]

    def emit(node, parent, depth, sums, least, ends, words, cum, below):
        return (node, sums[0], below + sums[2]) if sums[0] or below or sums[2] else None

    yield from _partial(batches, sums_of, 3, emit, schema)


def _digests(whole: bool):
    """Rows (node, conv_id) or (node, conv_id, text) sorted by node and number;
    yields (node, conv_id, digest, text): the digest of a node's joined numbers,
    or, unless ``whole``, for the first and the last node of a task the text in
    bounded pieces, since other tasks may hold more of it."""
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("node", pa.binary()), ("conv_id", pa.int64()), ("digest", pa.string()), ("text", pa.binary())])
        found: list[tuple] = []

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
            found.clear()
            return rows

        node, first, parts, size, sha, edge = None, None, [], 0, None, not whole

        def end(last: bool) -> None:
            if edge or last and not whole:
                found.append((node, first, None, b",".join(parts)))
            else:
                sha.update(b",".join(parts))
                found.append((node, first, sha.hexdigest(), None))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                text = row[2] if whole else b"%d" % row[1]
                if row[0] != node:
                    if node is not None:
                        end(False)
                        edge = False
                    node, first, parts, size, sha = row[0], row[1], [], 0, hashlib.sha256()
                elif size > TEXT:
                    if whole:
                        sha.update(b",".join(parts) + b",")
                    else:  # it may reach beyond this task
                        found.append((node, first, None, b",".join(parts)))
                        edge = True
                    first, parts, size = row[1], [], 0
                parts.append(text)
                size += len(text) + 1
            if len(found) >= 10_000 or sum(len(f[3] or b"") for f in found) > TEXT:
                yield out()
        if node is not None:
            end(True)
        if found:
            yield out()

    return run


def end_digests(ends: DataFrame, work: Work) -> DataFrame:
    """node, ends_sha256 for ``ends`` (node, conv_id): SHA-256 of the numbers in
    ascending order.  Numbers are joined where they lie after a range sort; of a
    node that spans tasks only joined pieces meet, and they are read one by one."""
    columns = "node binary, conv_id bigint, digest string, text binary"
    rows = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    rows = work.stage(rows.mapInArrow(_digests(False), columns), "ends")
    split = rows.filter("digest is null").select("node", "conv_id", "text").repartition("node").sortWithinPartitions("node", "conv_id")
    return rows.filter("digest is not null").select("node", F.col("digest").alias("ends_sha256")).unionAll(
        split.mapInArrow(_digests(True), columns).select("node", "digest"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns stand in the order of their numbers, NULL first; those alike in number
    are ordered by the hash of role and text, so equal rows are turns of their
    own side by side.  NULL role or text is empty.  Rows without a conv_id are
    no conversation's and are left out.  An empty table gives no rows; extra
    columns are not read.
    """
    work = Work(conversations.sparkSession)
    strings = work.stage(rebuilt(conversations), "strings")
    nodes = strings.drop("end").mapInArrow(_members, MEMBERS)
    nodes = work.stage(nodes.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_ended").alias("n_ended"),
        F.min("conv_id").alias("conv_id"), F.first("words").alias("words"), F.first("said").alias("said")), "trie-nodes")

    # Where all members end, there are no children.
    childless = F.col("n_convs") == F.col("n_ended")
    owned = nodes.select("conv_id", F.struct("depth", (F.col("said") - F.col("words")).alias("said")).alias("first"), childless.alias("leaf"))
    nothing = F.struct((F.col("start_depth") + F.size("words") + 1).alias("depth"),
                       (F.col("start_words") + F.aggregate("words", F.lit(0).cast("bigint"), lambda a, w: a + w)).alias("said"))
    owners = owned.unionAll(strings.filter("ended").select("conv_id", nothing, F.lit(False))).groupBy("conv_id").agg(
        F.min("first").alias("first"), F.max("leaf").alias("leaf"))
    owners = owners.select("conv_id", F.col("first.depth").alias("first_own"), F.col("first.said").alias("own_said"), "leaf")
    sums = strings.drop("end").join(owners, "conv_id").mapInArrow(_subtrees, SUBTREES)

    # Everything about a node meets in one aggregation.
    none = {"depth": "bigint", "conv_id": "bigint", "n_convs": "bigint", "parent": "binary", "n_children": "bigint", "n_leaves": "bigint",
            "saved_tokens": "bigint", "ends_sha256": "string"}

    def part(df: DataFrame, **has) -> DataFrame:
        return df.select("node", *[has.get(c, F.lit(None).cast(t)).alias(c) for c, t in none.items()])

    own = {c: F.col(c) for c in ("depth", "conv_id", "n_convs", "parent")}
    rows = part(nodes, **own)
    rows = rows.unionAll(part(nodes.filter("parent is not null").select(F.col("parent").alias("node")), n_children=F.lit(1).cast("bigint")))
    rows = rows.unionAll(part(sums, n_leaves=F.col("n_leaves"), saved_tokens=F.col("saved_tokens")))
    rows = rows.unionAll(part(end_digests(strings.filter("ended").select(F.col("end").alias("node"), "conv_id"), work), ends_sha256=F.col("ends_sha256")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)
    rows = rows.groupBy("node").agg(*[F.max(c).alias(c) for c in own], total("n_children"), total("n_leaves"), total("saved_tokens"),
                                    F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = rows.join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    found = stage(found, "trie")
    work.clear()
    return found
