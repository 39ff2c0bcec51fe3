"""Product codes of vectors, assigned through memoised grid cells.

A vector's components become integers floor(256 x) and are cut into equal
parts; every part position has a codebook of at most ``ENTRIES`` entries.
To find the nearest entry of a part, its coarse grid cell is hashed.  The
first time a task meets a cell, the smallest and the largest distance of
every entry to the cell's box are computed: an entry whose smallest
distance exceeds the smallest of the largest distances is nearest nowhere
in the box.  The others are kept under the cell's hash, and only those are
evaluated exactly, for this part and all later ones of that cell.  A kept
cell's coordinates are compared too, so two cells with one hash cost time,
not results.  Cells are as wide as 1 / ``GRID`` of the codebook's extent.

Training is Spark's: every round is one map over the vectors whose tasks
emit sums and counts per entry, one small aggregate, and an exchange of the
codebooks (as many numbers as ``ENTRIES`` vectors have) with the driver.

Edge cases: rows whose vector is null or empty, holds a null or non-finite
component, has a length that the parts do not divide, or another length
than the usable vector of the smallest id, are dropped.  Null ids come
last; of equal ids the smaller vector comes first; repeated rows are coded
each.  Fewer vectors than entries give smaller codebooks, an empty table
gives no rows.  Null labels are one label.  Extra columns are ignored,
whatever their names; there are no texts.  A component so large that a
squared distance would not fit a long stops the job with an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import mix
from starloom.session import cut_lineage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
GRID = 8
KEEP_CELLS = 1 << 16
SALTS = 16


class CellMemo:
    """Nearest entries of one codebook; ``evaluated`` counts exact distances."""

    def __init__(self, book: np.ndarray, grid: int = GRID, keep: int = KEEP_CELLS):
        self.book = book
        self.width = max(1, int((book.max(axis=0) - book.min(axis=0)).max()) // grid)
        self.keep = keep
        self.evaluated = 0
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes
        self.slot = np.zeros(0, np.int64)  # their places in the arrays below
        self.cells = np.zeros((0, self.book.shape[1]), np.int64)
        self.from_ = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.entries = np.zeros(0, np.int64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every row of ``x``; ties to the lower index."""
        cell = np.floor_divide(x, self.width)
        key = np.zeros(len(x), np.uint64)
        for column in cell.T:
            key = mix(key ^ column.astype(np.uint64)) + np.uint64(1)
        known, first, back = np.unique(key, return_index=True, return_inverse=True)
        slot = self._slots(known, cell[first])[back]
        same = (self.cells[slot] == cell).all(axis=1)
        entry, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        rows = np.flatnonzero(same)
        if len(rows):
            size = self.size[slot[rows]]
            lead = np.cumsum(size) - size
            entries = self.entries[np.repeat(self.from_[slot[rows]] - lead, size) + np.arange(size.sum())]
            entry[rows], distance[rows] = self._exact(x, rows, size, entries)
        rows = np.flatnonzero(~same)
        if len(rows):
            n = len(self.book)
            entry[rows], distance[rows] = self._exact(x, rows, np.full(len(rows), n), np.tile(np.arange(n), len(rows)))
        return entry, distance

    def _exact(self, x, rows, size, entries) -> tuple[np.ndarray, np.ndarray]:
        self.evaluated += len(entries)
        lead = np.cumsum(size) - size
        squares = ((np.repeat(x[rows], size, axis=0) - self.book[entries]) ** 2).sum(axis=1)
        least = np.minimum.reduceat(squares, lead)
        hit = np.flatnonzero(squares == np.repeat(least, size))
        who = np.repeat(np.arange(len(rows)), size)[hit]
        best = np.zeros(len(rows), np.int64)
        best[who[::-1]] = entries[hit[::-1]]  # a cell's entries ascend: the lowest is written last
        return best, least

    def _slots(self, known: np.ndarray, cell: np.ndarray) -> np.ndarray:
        if len(self.keys) + len(known) > self.keep:
            self._forget()
        at = np.searchsorted(self.keys, known)
        have = np.zeros(len(known), bool)
        if len(self.keys):
            have = self.keys[np.minimum(at, len(self.keys) - 1)] == known
        new = np.flatnonzero(~have)
        if len(new):
            may = self._undominated(cell[new])
            size, base = may.sum(axis=1), len(self.size)
            self.from_ = np.concatenate([self.from_, len(self.entries) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.entries = np.concatenate([self.entries, np.nonzero(may)[1]])
            self.cells = np.concatenate([self.cells, cell[new]])
            self.keys = np.insert(self.keys, at[new], known[new])
            self.slot = np.insert(self.slot, at[new], base + np.arange(len(new)))
            at = np.searchsorted(self.keys, known)
        return self.slot[at]

    def _undominated(self, cell: np.ndarray) -> np.ndarray:
        """Which entries can be nearest somewhere in each cell's box (cells x entries)."""
        near = np.zeros((len(cell), len(self.book)), np.int64)
        far = np.zeros_like(near)
        for column, at in zip(cell.T, self.book.T, strict=True):
            lo = (column * self.width)[:, None] - at[None, :]
            hi = lo + (self.width - 1)
            near += np.maximum(np.maximum(lo, -hi), 0) ** 2
            far += np.maximum(np.abs(lo), np.abs(hi)) ** 2
        return near <= far.min(axis=1, keepdims=True)


def usable(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors of a batch, and floor(256 x) of them."""
    lists = batch.column("vec")
    at = lists.offsets.to_numpy()
    rows = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (np.diff(at) == dim))
    values = lists.values.to_numpy(zero_copy_only=False)  # a null component is NaN
    x = values[at[rows][:, None] + np.arange(dim)]
    finite = np.isfinite(x).all(axis=1)
    return rows[finite], whole_numbers(x[finite], dim)


def whole_numbers(x: np.ndarray, dim: int) -> np.ndarray:
    x = np.floor(x.astype(np.float64) * SCALE)
    # dim * (2 * most)**2 stays below 2**62.
    if len(x) and np.abs(x).max() >= math.floor(math.sqrt(2**58 / dim)):
        raise ValueError("a vector component is too large for exact squared distances")
    return x.astype(np.int64)


def sums_of_entries(books: np.ndarray) -> Callable:
    """Map: per part, entry and place in the part, the number and sum of the assigned parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        memos = [CellMemo(b) for b in books]
        total = np.zeros(books.shape, np.int64)
        many = np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = usable(batch, parts * width)[1].reshape(-1, parts, width)
            for p in range(parts if len(x) else 0):
                entry, _ = memos[p].nearest(x[:, p])
                np.add.at(total[p], entry, x[:, p])
                many[p] += np.bincount(entry, minlength=entries)
        p, e = np.nonzero(many)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(p, width), pa.int32()), pa.array(np.repeat(e, width), pa.int32()),
             pa.array(np.tile(np.arange(width), len(p)), pa.int32()),
             pa.array(np.repeat(many[p, e], width), pa.int64()), pa.array(total[p, e].ravel(), pa.int64())],
            ["part", "entry", "place", "n", "total"])
    return run


def codes_of(books: np.ndarray) -> Callable:
    """Map: the code and the error of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = books.shape
        memos = [CellMemo(b) for b in books]
        for batch in batches:
            rows, x = usable(batch, parts * width)
            if not len(rows):
                continue
            x = x.reshape(-1, parts, width)
            code = np.zeros((len(x), parts), np.uint8)
            error = np.zeros(len(x), np.int64)
            for p in range(parts):
                entry, distance = memos[p].nearest(x[:, p])
                code[:, p] = entry
                error += distance
            text, n = code.tobytes().hex(), 2 * parts
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), batch.column("label").take(pa.array(rows)),
                 pa.array([text[i:i + n] for i in range(0, n * len(x), n)], pa.string()),
                 pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def smallest_vectors(src: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The usable vectors of the smallest ids, all of one length."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ((x - x) == 0))
    ok = src.where(F.coalesce((F.size("vec") > 0) & (F.size("vec") % parts == 0) & finite, F.lit(False)))
    order = [F.col("vec_id").asc_nulls_last(), "vec"]
    first = [r.vec for r in ok.orderBy(*order).limit(entries).select("vec").collect()]
    if any(len(v) != len(first[0]) for v in first):
        same = ok.where(F.size("vec") == len(first[0]))
        first = [r.vec for r in same.orderBy(*order).limit(entries).select("vec").collect()]
    return np.array(first, np.float64)


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
                 ) -> tuple[DataFrame, np.ndarray | None]:
    """(``vec_id, label, code, error`` of every usable vector, the final
    codebooks as an array of parts x entries x width).  Codebooks are None
    if no vector is usable."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    of = vectors.schema[vec_col].dataType.elementType
    vec = F.col(vec_col) if isinstance(of, T.FloatType | T.DoubleType) else F.col(vec_col).cast("array<double>")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vec.alias("vec"))
    label_type = src.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label_type}, code string, error long"
    first = smallest_vectors(src, parts, entries)
    if not len(first):
        return src.where("false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    dim = first.shape[1]
    first = whole_numbers(first, dim)
    books = np.ascontiguousarray(first.reshape(len(first), parts, dim // parts).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = src.mapInArrow(sums_of_entries(books), "part int, entry int, place int, n long, total long") \
            .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        books = books.copy()
        for r in sums.collect():  # one row per number of the codebooks
            books[r.part, r.entry, r.place] = int(r.total) // r.n
    return src.mapInArrow(codes_of(books), schema), books


def codebooks_digest(books: np.ndarray | None) -> str:
    numbers = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the sum of the errors of its label.  The sums
    meet the rows on (label, salt), so a label with a third of all rows is
    spread over ``SALTS`` groups where the sums are too many to broadcast."""
    coded = cut_lineage(coded, "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")) \
        .withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salted = coded.withColumn("row_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("row_salt") == F.col("salt"))) \
        .select("vec_id", "label", "code", "error", "label_error")
