"""Vector bin packing of tokenised examples into training sequences.

A sequence has limits in three dimensions at once: tokens, segments (pieces of
examples) and loss-bearing tokens.  A sequence is filled by the dot-product
heuristic: of the pieces at hand that fit, the one whose demand has the largest
inner product with the room that is left, each dimension weighed by how scarce
it is among the pieces at hand.  Where nothing fits and room is left, a piece is
cut to the room.

Each task packs the examples of its own input split from a bounded pool, so
texts and ids never move between tasks, and neither a frequent key nor a group
of copies gathers anywhere.  What the limits or the end of the input leave short
is trimmed to a power of two, which needs no padding; the rest goes back to the
pool.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import flat, slices, worker_cache
from clickmart.llm.token_planes import MARKS, SLICE, WordEncoder

POOL = 2048               # pieces to choose from; a task holds no more
FLUSH = 2000              # pieces of one output batch
PIECE = "start bigint, length bigint, loss bigint, ids binary, mask binary, doc_tokens bigint, sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss: int = 2048
    waste: int = 8        # padding tokens of a sequence that are not worth a cut

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1 or self.waste < 0:
            raise ValueError("limits are at least 1 and waste at least 0")


def parted(texts, encoder: WordEncoder):
    """Texts of the same ids and fewer different words: A-Z in lower case, and a
    space between a letter and a mark.  Only where the encoder has found that the
    tokenizer lowers case and keeps letters apart from marks."""
    from pyarrow import compute as pc

    if encoder.marks is None:
        return texts
    return pc.replace_substring_regex(pc.ascii_lower(texts), f"(\\pL)([{MARKS}])", "\\1 \\2")


class Piece:
    """Ids of an example from ``start`` on, and which of them bear loss."""

    __slots__ = ("doc", "start", "ids", "mask", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, mask: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.mask, self.total = doc, start, ids, mask, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:n], self.mask[:n], self.total),
                Piece(self.doc, self.start + n, self.ids[n:], self.mask[n:], self.total))

    def fitting(self, tokens: int, loss: int) -> int:
        """Length of the longest beginning within so many tokens and loss-bearing ones."""
        n = min(tokens, len(self.ids))
        if int(np.count_nonzero(self.mask[:n])) <= loss:
            return n
        return int(np.searchsorted(np.cumsum(self.mask[:n], dtype=np.int64), loss, "right"))


class Packer:
    """Fills sequences from a pool; ``done`` gets every sequence, a list of pieces."""

    def __init__(self, limits: Limits, done):
        self.limits, self.done = limits, done
        self.tokens, self.loss = np.zeros(POOL, np.int64), np.zeros(POOL, np.int64)
        self.pieces: list[Piece | None] = [None] * POOL
        self.free = list(range(POOL - 1, -1, -1))

    def add(self, piece: Piece) -> None:
        """An example, of any length: what exceeds a limit by itself is cut off first."""
        while True:
            n = piece.fitting(self.limits.tokens, self.limits.loss)
            if n == len(piece.ids):
                break
            head, piece = piece.cut(n)
            if n == self.limits.tokens:
                self.done([head])
            else:
                self._hold(head)
        self._hold(piece)

    def _hold(self, piece: Piece) -> None:
        while not self.free:
            self._fill()
        k = self.free.pop()
        self.pieces[k], self.tokens[k], self.loss[k] = piece, len(piece.ids), np.count_nonzero(piece.mask)

    def _take(self, k: int) -> Piece:
        piece, self.pieces[k] = self.pieces[k], None
        self.tokens[k] = self.loss[k] = 0
        self.free.append(k)
        return piece

    def _fill(self) -> None:
        cap = self.limits
        most = (cap.tokens, cap.segments, cap.loss)
        room = list(most)
        held = POOL - len(self.free)
        scarce = [float(total) / held / m for total, m in zip((self.tokens.sum(), held, self.loss.sum()), most, strict=True)]
        out: list[Piece] = []
        while room[1] and (room[0] > cap.waste or not out):
            gain = [s * r / m / m for s, r, m in zip(scarce, room, most, strict=True)]
            score = gain[0] * self.tokens + gain[1] + gain[2] * self.loss
            score[(self.tokens > room[0]) | (self.loss > room[2]) | (self.tokens == 0)] = -1.0
            k = int(score.argmax())
            if score[k] < 0:
                if len(self.free) == POOL:
                    break
                k = int(self.tokens.argmax())  # nothing fits whole: the longest is cut
                n = self.pieces[k].fitting(room[0], room[2])
                if n == 0:
                    break
                head, rest = self._take(k).cut(n)
                self._hold(rest)
                piece = head
            else:
                piece = self._take(k)
            out.append(piece)
            room = [room[0] - len(piece.ids), room[1] - 1, room[2] - int(np.count_nonzero(piece.mask))]
        used = cap.tokens - room[0]
        if room[0] > cap.waste:
            self._trim(out, used - (1 << used.bit_length() - 1))
        self.done(out)

    def _trim(self, out: list[Piece], surplus: int) -> None:
        """Give the last ``surplus`` tokens back to the pool."""
        while surplus:
            piece = out.pop()
            n = len(piece.ids) - surplus
            if n > 0:
                head, piece = piece.cut(n)
                out.append(head)
            surplus -= len(piece.ids)
            self._hold(piece)

    def finish(self) -> None:
        while len(self.free) < POOL:
            self._fill()


def as_examples(docs: DataFrame) -> DataFrame:
    """Plain documents (doc_id, text) as examples of one part that bears loss."""
    part = F.struct(F.col("text").alias("text"), F.lit(True).alias("loss"))
    return docs.select("doc_id", F.array(part).alias("parts"))


def pack(examples: DataFrame, tokenizer: str, end_id: int = 1, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """Pieces of sequences: doc_id, start (the example's ids before the piece),
    length, loss (loss-bearing tokens), ids (binary, little-endian unsigned
    32-bit), mask (one bit an id, little-endian, 1 where it bears loss),
    doc_tokens, sequence_id, offset (place in the sequence).

    ``examples`` has doc_id and parts, an array of (text, loss): the texts follow
    one another, ``end_id`` ends each example and bears loss as its last part
    does.  A sequence with fewer than ``limits.tokens - limits.waste`` tokens has
    a power of two of them.  NULL or empty parts give the end id alone, which
    bears loss; NULL text is empty, NULL loss is none; equal rows, also those
    with equal or NULL ids, are examples of their own; an empty table gives no
    rows.  Other columns are not read.  Sequence ids hold the number of the input
    split above 32 bits; the same files and settings give the same sequences.
    """
    from pyspark.sql import types as T

    rows = examples.select("doc_id", "parts")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = worker_cache("encoders").get(tokenizer)
        if encoder is None:
            encoder = worker_cache("encoders")[tokenizer] = WordEncoder(tokenizer)
        names = [f.split()[0] for f in ["doc_id", *PIECE.split(", ")]]
        found: list[tuple] = []
        number, id_type = TaskContext.get().partitionId() << 32, None

        def done(pieces: list[Piece]) -> None:
            nonlocal number
            at = 0
            for p in pieces:
                n = len(p.ids)
                found.append((p.doc, p.start, n, int(np.count_nonzero(p.mask)), p.ids.tobytes(),
                              np.packbits(p.mask, bitorder="little").tobytes(), p.total, number, at))
                at += n
            number += 1

        def out():
            columns = list(zip(*found, strict=True))
            found.clear()
            types = [id_type] + [pa.binary() if n in ("ids", "mask") else pa.int64() for n in names[1:]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        packer = Packer(limits, done)
        for batch in batches:
            ids, parts = batch.column(0), batch.column(1)
            id_type = ids.type
            docs = ids.to_pylist()
            first = np.concatenate([[0], np.cumsum(parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            inner = parts.flatten()
            texts, loss = inner.field("text"), inner.field("loss").fill_null(False).to_numpy(zero_copy_only=False)
            if inner.null_count:
                whole = inner.is_valid().to_numpy(zero_copy_only=False)
                texts, loss = pa.array([t if w else None for t, w in zip(texts.to_pylist(), whole, strict=True)], texts.type), loss & whole
            texts = texts.fill_null("")
            for lo, hi in slices(flat(texts)[1][first], SLICE):
                a, b = int(first[lo]), int(first[hi])
                coded, at = encoder.encode(parted(texts[a:b], encoder)) if b > a else (np.zeros(0, "<u4"), np.zeros(1, np.int64))
                bears = np.repeat(loss[a:b], np.diff(at))
                ends = at[first[lo:hi + 1] - a]
                for k in range(hi - lo):
                    x, y = int(ends[k]), int(ends[k + 1])
                    last = bool(loss[first[lo + k + 1] - 1]) if first[lo + k + 1] > first[lo + k] else True
                    ids, mask = np.empty(y - x + 1, "<u4"), np.empty(y - x + 1, bool)
                    ids[:-1], ids[-1], mask[:-1], mask[-1] = coded[x:y], end_id, bears[x:y], last
                    packer.add(Piece(docs[lo + k], 0, ids, mask, y - x + 1))
                    if len(found) >= FLUSH:
                        yield out()
        packer.finish()
        if found:
            yield out()

    fields = T.StructType.fromDDL(f"x int, {PIECE}").fields[1:]
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", examples.schema["doc_id"].dataType), *fields]))
