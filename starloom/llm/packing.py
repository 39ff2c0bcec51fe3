"""Packing of tokenised documents by vector bin packing.

Every document becomes token ids plus an end id; it is cut into pieces,
and pieces go into sequences under three limits at once: tokens, segments
(pieces) and loss-bearing tokens.  A piece of the full token limit is a
sequence by itself.  The rest is packed bin by bin with the dot-product
heuristic: of the pieces that still fit, take the one whose size vector
(each coordinate relative to its limit) has the largest dot product with
the room left in the bin.  A bin that nothing fits any more is filled by
cutting the largest piece (the rest of it goes back to the pool) unless
the gap is below ``MIN_CUT`` tokens.

Each task packs the documents it reads, with a pool of at most ``POOL``
pieces, so nothing is shuffled and memory does not grow with the input.
The last, partly filled sequence of a task is cut into sequences whose
sizes are powers of two, which need no padding.  ``sequence_id`` holds the
task's partition number in its upper bits: it is unique, and a task that
is run again after the loss of an executor gives the same ids.

Edge cases: a null or empty text is the end id alone; repeated documents
are packed each; a very long text is cut into pieces like any other; an
empty table gives no rows; an id may be null; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.encode import encoder
from starloom.llm.words import slices

MAX_TOKENS = 4096
MAX_SEGMENTS = 512
MAX_LOSS = 4096
MIN_CUT = 8
POOL = 8192
PER_TASK = 1 << 33

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long, ids array<int>")


class Piece:
    """Tokens ``start`` to ``start + len(ids)`` of a document; those from ``loss_from`` on bear loss."""

    __slots__ = ("doc", "ids", "loss", "start", "total")

    def __init__(self, doc, start: int, total: int, ids: np.ndarray, loss_from: int):
        self.doc, self.start, self.total, self.ids = doc, start, total, ids
        self.loss = max(0, start + len(ids) - max(start, loss_from))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        loss_from = self.start + len(self.ids) - self.loss
        return (Piece(self.doc, self.start, self.total, self.ids[:n], loss_from),
                Piece(self.doc, self.start + n, self.total, self.ids[n:], loss_from))


class Packer:
    """Streaming vector bin packing: ``add`` pieces, take whole sequences out."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                 max_loss: int = MAX_LOSS, min_cut: int = MIN_CUT, pool: int = POOL):
        if min(max_tokens, max_segments, max_loss) < 1:
            raise ValueError("every limit must be at least 1")
        self.limit = np.array([max_tokens, max_segments, max_loss], np.float64)
        self.min_cut, self.room = min_cut, pool
        self.pieces: list[Piece] = []
        self.tokens = np.zeros(0, np.int64)
        self.loss = np.zeros(0, np.int64)

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Sequences made by the arrival of a piece of any length."""
        most, least_loss = int(self.limit[0]), int(self.limit[2])
        while len(piece.ids) > most or piece.loss > least_loss:
            n = min(most, len(piece.ids))
            free = len(piece.ids) - piece.loss  # tokens without loss come first
            n = min(n, max(0, free) + least_loss)
            head, piece = piece.cut(n)
            yield [head]
        if len(piece.ids) == most:
            yield [piece]
            return
        self.pieces.append(piece)
        if len(self.pieces) >= self.room:
            yield from self.pack(self.room // 2)

    def pack(self, leave: int) -> Iterator[list[Piece]]:
        """Fill bins until at most ``leave`` pieces are left in the pool."""
        t = np.array([len(p.ids) for p in self.pieces], np.int64)
        loss = np.array([p.loss for p in self.pieces], np.int64)
        pool = list(self.pieces)
        alive = np.arange(len(pool))
        while len(alive) > leave:
            left = self.limit.copy()
            chosen: list[Piece] = []
            while len(alive) and left[1] >= 1:
                fits = (t[alive] <= left[0]) & (loss[alive] <= left[2])
                if fits.any():
                    weight = left / self.limit**2
                    score = np.where(fits, t[alive] * weight[0] + weight[1] + loss[alive] * weight[2], -1.0)
                    k = int(score.argmax())
                    i = alive[k]
                    alive = np.delete(alive, k)
                    chosen.append(pool[i])
                    left -= (t[i], 1, loss[i])
                    continue
                gap = int(left[0])
                if gap >= self.min_cut:
                    k = int(t[alive].argmax())
                    head, rest = pool[alive[k]].cut(min(gap, len(pool[alive[k]].ids) - 1))
                    if head.loss <= left[2] and len(head.ids):
                        chosen.append(head)
                        i = alive[k]
                        pool[i], t[i], loss[i] = rest, len(rest.ids), rest.loss
                break
            yield chosen
        self.pieces = [pool[i] for i in alive]

    def finish(self) -> Iterator[list[Piece]]:
        """The rest of the pool; the last sequence in powers of two."""
        last: list[Piece] | None = None
        for done in self.pack(0):
            if last is not None:
                yield last
            last = done
        used = sum(len(p.ids) for p in last or [])
        if not last or used == int(self.limit[0]):
            if last:
                yield last
            return
        todo = last[::-1]
        for bit in reversed(range(used.bit_length())):
            if not used >> bit & 1:
                continue
            need, part = 1 << bit, []
            while need:
                piece = todo.pop()
                if len(piece.ids) > need:
                    piece, rest = piece.cut(need)
                    todo.append(rest)
                part.append(piece)
                need -= len(piece.ids)
            yield part


def packing_task(path: str, end_id: int, with_ids: bool, limits: dict[str, int]
                 ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        packer = Packer(**limits)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) * PER_TASK
        rows: list[tuple] = []

        def put(sequences: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    ids = p.ids.astype("<u4")
                    rows.append((p.doc, p.start, len(ids), zlib.crc32(ids.tobytes()), p.total,
                                 sequence, offset, p.loss, ids.astype(np.int32) if with_ids else None))
                    offset += len(ids)
                sequence += 1

        for batch in batches:
            for part in slices(batch, "text"):
                ids, off = enc.encode(part.column("text"))
                docs, free = part.column("doc_id").to_pylist(), part.column("loss_from").to_pylist()
                for d, doc in enumerate(docs):
                    own = np.empty(off[d + 1] - off[d] + 1, np.uint32)
                    own[:-1] = ids[off[d]:off[d + 1]]
                    own[-1] = end_id
                    own = own.astype(np.uint16) if end_id < 1 << 16 and enc.dtype == np.uint16 else own
                    put(packer.add(Piece(doc, 0, len(own), own, free[d] or 0)))
                if len(rows) >= 4096:
                    yield to_batch(rows)
                    rows.clear()
        put(packer.finish())
        if rows:
            yield to_batch(rows)
    return run


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PIECES.split(", ")]
    cols = list(zip(*rows, strict=True))
    arrays = [pa.array(c, pa.int64()) for c in cols[:-1]] + [pa.array(cols[-1], pa.list_(pa.int32()))]
    return pa.RecordBatch.from_arrays(arrays, names)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", loss_from: Column | None = None, with_ids: bool = False,
                   **limits: int) -> DataFrame:
    """One row per piece (columns of ``PIECES``).  ``loss_from`` gives the
    first loss-bearing token of a document (instruction data: the length of
    its prompt); without it every token bears loss.  ``limits``:
    max_tokens, max_segments, max_loss, min_cut, pool."""
    first = (loss_from if loss_from is not None else F.lit(0)).cast("long")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      first.alias("loss_from"))
    out = src.mapInArrow(packing_task(tokenizer, end_id, with_ids, limits), PIECES)
    return out if with_ids else out.drop("ids")
