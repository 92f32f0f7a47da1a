"""Token-ID output in bit- or byte-plane files.

A shard file holds the ids of a run of documents in id order::

    magic, then per block of BLOCK ids one zstandard frame per plane
    (byte plane p: byte p of every id; bit plane p: bit p of every id),
    then the document index (Arrow stream, zstandard), then the chunk index
    (per block: first byte, number of ids, length of every plane), then a
    fixed tail that says where the two indexes are.

Splitting ids into planes puts the zero bytes of small ids together and lets
each plane be compressed by itself; the chunk index gives random access to any
token.  Tasks write shards under names of their own; the manifest, written by
Spark, names the shards of the tasks that ended well, so files that a lost
executor left behind are never read.
"""

from __future__ import annotations

import array
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmart.llm.common import flat, scratch, settings, slices, stage, worker_cache

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
TAIL = "<QQQIB8s"  # document index at, chunk index at, ids, block size, bits a plane, magic
LEVEL = 3
CACHED_WORDS, CACHED_LENGTH = 200_000, 64
MARKS = ".,;:!?*#$%&|"
BATCH_ROWS = "2000"
SLICE = 6 << 20           # bytes of text encoded at once
MANIFEST = "shard int, file string, n_docs bigint, n_tokens bigint"
DOCUMENT = "start bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """A block of unsigned 32-bit ids as four byte planes or 32 bit planes."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [raw[:, p].tobytes() for p in range(4)]
    each = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(each[:, p], bitorder="little").tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    if bits == 8:
        raw = np.empty((n, 4), np.uint8)
        for p, b in enumerate(planes):
            raw[:, p] = np.frombuffer(b, np.uint8)
    else:
        each = np.empty((n, 32), np.uint8)
        for p, b in enumerate(planes):
            each[:, p] = np.unpackbits(np.frombuffer(b, np.uint8), count=n, bitorder="little")
        raw = np.packbits(each, axis=1, bitorder="little")
    return raw.reshape(-1).view("<u4")


class PlaneWriter:
    """Writes one shard to an open binary file; holds one block in memory."""

    def __init__(self, out, bits: int = 8, block: int = BLOCK, level: int = LEVEL):
        import zstandard

        if bits not in (1, 8):
            raise ValueError("a plane has 1 or 8 bits of every id")
        self.out, self.bits, self.block = out, bits, block
        self.squeeze = zstandard.ZstdCompressor(level=level).compress
        self.pending, self.held, self.at, self.total = [], 0, 0, 0
        self.chunks: list[tuple[int, ...]] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.pending)
            whole = len(ids) - len(ids) % self.block
            for lo in range(0, whole, self.block):
                self._flush(ids[lo:lo + self.block])
            self.pending, self.held = [ids[whole:].copy()], len(ids) - whole

    def _flush(self, ids: np.ndarray) -> None:
        frames = [self.squeeze(p) for p in to_planes(ids, self.bits)]
        self.chunks.append((self.at, len(ids), *map(len, frames)))
        self.total += len(ids)
        self._put(b"".join(frames))

    def close(self, documents) -> None:
        """``documents``: Arrow table with doc_id and n_tokens."""
        import pyarrow as pa

        if self.held:
            self._flush(np.concatenate(self.pending))
        docs_at = self.at
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, documents.schema) as w:
            w.write_table(documents)
        self._put(self.squeeze(sink.getvalue().to_pybytes()))
        chunks_at = self.at
        self._put(np.array(self.chunks, "<u8").tobytes())
        self._put(struct.pack(TAIL, docs_at, chunks_at, self.total, self.block, self.bits, MAGIC))


class PlaneReader:
    """Reads a shard from an open seekable file; holds one block in memory."""

    def __init__(self, file):
        import zstandard

        self.file, self.expand = file, zstandard.ZstdDecompressor().decompress
        file.seek(0, os.SEEK_END)
        end = file.tell() - struct.calcsize(TAIL)
        docs_at, chunks_at, self.total, self.block, self.bits, magic = struct.unpack(TAIL, self._get(end, struct.calcsize(TAIL)))
        if magic != MAGIC:
            raise ValueError("not a plane file")
        width = 2 + 32 // self.bits
        self.chunks = np.frombuffer(self._get(chunks_at, end - chunks_at), "<u8").reshape(-1, width).astype(np.int64)
        self.docs_at, self.chunks_at, self.kept = docs_at, chunks_at, (-1, None)

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def documents(self):
        import pyarrow as pa

        return pa.ipc.open_stream(self.expand(self._get(self.docs_at, self.chunks_at - self.docs_at))).read_all()

    def chunk(self, k: int) -> np.ndarray:
        if self.kept[0] != k:
            at, n, *lengths = map(int, self.chunks[k])
            raw, ends = self._get(at, sum(lengths)), np.cumsum([0, *lengths])
            planes = [self.expand(raw[ends[p]:ends[p + 1]]) for p in range(len(lengths))]
            self.kept = (k, from_planes(planes, n, self.bits))
        return self.kept[1]

    def read(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids ``[start, start + n)`` in pieces of a block at most."""
        while n > 0:
            k, lo = divmod(start, self.block)
            piece = self.chunk(k)[lo:lo + n]
            yield piece
            start, n = start + len(piece), n - len(piece)


class WordEncoder:
    """Ids of whole texts by the tokenizer, asked once per distinct word.

    Only for tokenizers whose pre-tokenizer drops white space and keeps runs of
    letters apart from other characters, so that a text's ids are its words' ids
    in a row.  Words of Latin-1 letters, with marks behind them or none, skip the
    normaliser and the splitting rule, which would leave them as they are
    once in lower case.  Both are checked when the tokenizer is loaded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.words, self.cores = Tokenizer.from_file(path), {}, {}
        self.letters = Tokenizer(self.whole.model)
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.marks: dict[str, bytes] | None = {"": b""}
        probe = "The \u00c9t\u00e9, stra\u00dfe. ab'c \n x-1 \n\nab? reed*** x|, 12: \u03a3\u03c3, no! a;  "
        split = probe.replace("\n", " ").split(" ")
        if self._ids(self.whole, [probe])[0] != b"".join(self._ids(self.whole, split)):
            raise ValueError("this tokenizer's tokens may cross a space")
        if self._ids(self.whole, split) != self._words(split):
            self.marks = None

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        return [array.array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        if self.marks is None:
            return self._ids(self.whole, words)
        known, plain = self.cores, {}
        parts: list[tuple[str, bytes] | None] = []
        other: list[str] = []
        for w in words:
            low = w.lower()
            core = low.rstrip(MARKS)
            if core.isalpha() and (core.isascii() or max(w) < "\u0100"):
                plain[core] = known.get(core)
                mark = low[len(core):]
                if mark not in self.marks:
                    self.marks[mark] = self._ids(self.whole, [mark])[0]
                parts.append((core, self.marks[mark]))
            else:
                other.append(w)
                parts.append(None)
        new = [c for c, b in plain.items() if b is None]
        plain.update(zip(new, self._ids(self.letters, new), strict=True))
        if len(known) > CACHED_WORDS:
            known.clear()
        known.update(plain)
        rest = iter(self._ids(self.whole, other))
        return [next(rest) if p is None else plain[p[0]] + p[1] for p in parts]

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of strings, one text after the other, and where
        each text begins (and the last ends)."""
        import pyarrow as pa
        from pyarrow import compute as pc

        lists = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        words, known = coded.dictionary.to_pylist(), self.words
        found = list(map(known.get, words))
        new = [w for w, b in zip(words, found, strict=True) if b is None]
        fresh = iter(self._words(new))
        index = coded.indices.to_numpy(zero_copy_only=False)
        again = (np.bincount(index, minlength=len(words)) > 1).tolist()
        if len(known) > CACHED_WORDS:
            known.clear()
            self.marks = self.marks and {"": b""}
        for k, b in enumerate(found):
            if b is None:
                found[k] = b = next(fresh)
                if again[k] and len(words[k]) <= CACHED_LENGTH:  # words met once seldom come back soon
                    known[words[k]] = b

        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        n = size[index]
        at = np.concatenate([[0], np.cumsum(n)])
        ids = pool[np.repeat((np.cumsum(size) - size)[index] - at[:-1], n) + np.arange(at[-1])]
        offsets = lists.offsets.to_numpy(zero_copy_only=False)
        return ids, at[offsets - offsets[0]]


def _open(path: str, write: bool):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    if write:
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(inner)
    return system.open_input_file(inner)


def write_planes(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, bits: int = 8) -> DataFrame:
    """Encode every text, append ``end_id``, write shards in ascending ``doc_id``
    order under ``path`` (a folder all executors and the driver share) and return
    the manifest: shard, file, n_docs, n_tokens.

    Documents are range-partitioned by id, so shards follow one another; NULL
    ids come first, and rows alike in id are ordered by text.  NULL text is
    empty and gives the end id alone.  An empty table gives an empty manifest.
    Other columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = worker_cache("encoders").get(tokenizer)
        if encoder is None:
            encoder = worker_cache("encoders")[tokenizer] = WordEncoder(tokenizer)
        out, ids, sizes = None, [], []
        for batch in batches:
            for lo, hi in slices(flat(batch.column(1))[1], SLICE):
                if out is None:
                    shard = TaskContext.get().partitionId()
                    file = f"{path}/shard-{shard:06d}-{uuid.uuid4().hex}.planes"
                    out = _open(file, True)
                    writer = PlaneWriter(out, bits)
                coded, at = encoder.encode(batch.column(1)[lo:hi])
                writer.add(np.insert(coded, at[1:], end_id))
                sizes.append(np.diff(at) + 1)
            ids.append(batch.column(0))
        if out is not None:
            writer.close(pa.table({"doc_id": pa.chunked_array(ids), "n_tokens": np.concatenate(sizes)}))
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "file": [file], "n_docs": pa.array([sum(map(len, sizes))], pa.int64()),
                "n_tokens": pa.array([writer.total], pa.int64())})

    # Small batches: what a worker holds of the text then does not depend on the session.
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}):
        return stage(rows.mapInArrow(write, MANIFEST), "manifest", f"{path}/manifest")


def read_planes(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """One row per document from the files that the manifest names: doc_id, start
    (ids of all documents before it), n_tokens, ids_crc32."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # One row per shard, not per document.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    tasks = max(1, manifest.count())

    def load(batches):
        import pyarrow as pa

        for batch in batches:
            for file, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
                with _open(file, False) as f:
                    reader = PlaneReader(f)
                    docs = reader.documents()
                    sizes = docs["n_tokens"].to_numpy()
                    begin = np.concatenate([[0], np.cumsum(sizes)])
                    sums = np.empty(len(sizes), np.int64)
                    for k, (at, n) in enumerate(zip(begin, sizes, strict=False)):
                        total = 0
                        for piece in reader.read(int(at), int(n)):
                            total = zlib.crc32(piece, total)
                        sums[k] = total
                    found = pa.table({"doc_id": docs["doc_id"], "start": start + begin[:-1], "n_tokens": sizes, "ids_crc32": sums})
                    yield from found.to_batches(max_chunksize=10_000)

    return shards.repartitionByRange(tasks, "shard").mapInArrow(load, f"doc_id {id_type}, {DOCUMENT}")


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, bits: int = 8) -> DataFrame:
    """Write ``docs`` to plane files in the shared folder and read them back."""
    path = scratch(docs.sparkSession, "planes")
    write_planes(docs, path, tokenizer, end_id, bits)
    return read_planes(docs.sparkSession, path, docs.schema["doc_id"].dataType.simpleString())
