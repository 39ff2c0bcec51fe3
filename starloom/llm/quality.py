"""Quality classifier: a linear hinge-loss model over n-gram indicators
scaled by naive Bayes log-count ratios (NBSVM).

Indicators are the word 1- and 2-grams of a text and the 1- to 3-grams of
its word shapes (runs of lower case, upper case, digits and each sign
collapsed; a word equal to the one before it has the shape "="), hashed
into 2**20 columns.  The ratio of a column is log((p / |p|) / (q / |q|)) of
its smoothed document counts in good and bad documents.  The scaled
indicators, normalised to unit length, feed dual coordinate descent on the
L1 hinge loss.  Margins become scores by a logistic fit on the training
documents.

Training uses at most ``MAX_TRAIN`` labelled documents (those with the
smallest hash of their id) and of those, in that order, as many as have
``MAX_COLUMNS`` indicators together (at least one document), so it fits one
task at every input size; the features are computed by Spark.  The driver
gets the model only (8 MB).  Scoring is one map over all documents.

Edge cases: null and empty texts have no indicators and score by the bias;
null or contradicting labels are not used; with no usable label of one of
the classes the score is a constant (the smoothed share of good documents);
repeated documents score alike; a very long text is scored whole, by itself;
an empty table gives no rows; other columns travel in ``row`` and may have
any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import Words, hash_spans, mix, slices, split_words

MAX_TRAIN = 8000
MAX_COLUMNS = 1 << 25
BITS = 20
SMOOTH = 1.0
COST = 1.0
EPOCHS = 12
SEED = 7
SLICE = 1 << 20  # bytes of text whose n-grams are held at a time

SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[0x30:0x3A] = ord("9")
SHAPE[0x41:0x5B] = ord("X")
SHAPE[0x61:0x7B] = ord("x")
SHAPE[0x80:] = ord("x")
SAME = np.uint64(0x6A09E667F3BCC909)


def shape_hashes(w: Words) -> np.ndarray:
    """Hash of every word's shape."""
    kind = SHAPE[w.buf]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[w.start] = True
    new[-8:] = True  # keep the padding
    before = np.concatenate([[0], np.cumsum(new)])
    return hash_spans(kind[new], before[w.start], before[w.end], seed=1)


def grams(h: np.ndarray, doc: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the n-grams that lie in one text."""
    if len(h) < n:
        return doc[:0], h[:0]
    out = np.full(len(h) - n + 1, salt, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k])
    ok = doc[:len(out)] == doc[n - 1:]
    return doc[:len(out)][ok], out[ok]


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, column) pairs, ordered by text."""
    w = split_words(texts)
    h, s = w.hashes(), shape_hashes(w)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    s = np.where(again, SAME, s)
    parts = [grams(h, w.doc, 1, 1), grams(h, w.doc, 2, 2),
             grams(s, w.doc, 1, 3), grams(s, w.doc, 2, 4), grams(s, w.doc, 3, 5)]
    pairs = np.concatenate([(d.astype(np.uint64) << np.uint64(BITS)) | (g >> np.uint64(64 - BITS))
                            for d, g in parts])
    pairs = np.unique(pairs)
    return (pairs >> np.uint64(BITS)).astype(np.int64), (pairs & np.uint64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # per column: coefficient times ratio
    squares: np.ndarray  # per column: squared ratio, for the length of a document
    bias: float
    slope: float
    shift: float

    def score(self, texts: pa.Array) -> np.ndarray:
        doc, col = indicators(texts)
        n = len(texts)
        dot = np.bincount(doc, self.weights[col], n)
        size = np.sqrt(np.bincount(doc, self.squares[col], n))
        margin = dot / np.maximum(size, 1e-9) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def constant(share: float) -> Model:
    none = np.zeros(1 << BITS, np.float32)
    return Model(none, none, 0.0, 0.0, float(np.log(share / (1 - share))))


def fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """NBSVM on lists of distinct columns with their labels."""
    y = np.where(good, 1.0, -1.0)
    if not len(y) or good.all() or not good.any():
        return constant((good.sum() + 1.0) / (len(y) + 2.0))
    width = 1 << BITS
    p, q = np.full(width, SMOOTH), np.full(width, SMOOTH)
    for r, g in zip(rows, good, strict=True):
        (p if g else q)[r] += 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ends = np.cumsum([len(r) for r in rows])
    values = np.split(np.empty(ends[-1], np.float32), ends[:-1])
    for r, unit in zip(rows, values, strict=True):
        v = ratio[r]
        unit[:] = v / max(np.sqrt(v @ v), 1e-9)
    # Rarer class and commoner class weigh alike.
    cost = np.where(good, COST * len(y) / (2 * good.sum()), COST * len(y) / (2 * (~good).sum()))
    w, bias, alpha = np.zeros(width), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            r, v = rows[i], values[i]
            slope = y[i] * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / 2.0, 0.0), cost[i])  # a unit vector and a constant: length 2
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[r] += step * v
                bias += step
                alpha[i] = new
    margin = np.array([w[r] @ v for r, v in zip(rows, values, strict=True)]) + bias
    slope, shift = logistic(margin, good, cost)
    return Model((w * ratio).astype(np.float32), (ratio**2).astype(np.float32), float(bias), slope, shift)


def logistic(margin: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Newton fit of score = 1 / (1 + exp(-(slope * margin + shift))), lightly ridged."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    beta = np.array([1.0, 0.0])
    target = np.where(good, 1 - 1e-3, 1e-3)
    for _ in range(25):
        prob = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (prob - target)) + 1e-2 * beta
        hess = (x * (weight * prob * (1 - prob))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.linalg.solve(hess, grad)
    return float(max(beta[0], 1e-3)), float(beta[1])


def held_out(id_col: str) -> Column:
    """Rows that training never sees: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_train: int = MAX_TRAIN, max_columns: int = MAX_COLUMNS) -> Model:
    usable = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).where(~held_out("id"))
    each = usable.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("hi")).where("y = hi")
    chosen = each.orderBy(F.xxhash64("id"), "id").limit(max_train).select("id", "y")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                doc, col = indicators(part.column("text"))
                cuts = np.searchsorted(doc, np.arange(1, part.num_rows))
                data = [x.astype(np.uint32).tobytes() for x in np.split(col, cuts)]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"),
                                                  pa.array(data, pa.binary())], ["id", "y", "columns"])

    # At most max_train ids are broadcast, so the texts stay where they are.
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(chosen), "id").select("id", "y", "text")
    sample = picked.mapInArrow(features, "id long, y int, columns binary") \
        .orderBy(F.xxhash64("id"), "id", F.xxhash64("columns")).limit(max_train) \
        .select("y", F.col("columns").alias("data"))

    def fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, good, held = [], [], 0
        for batch in batches:  # in order, all in one task
            for data, y in zip(batch.column("data").to_pylist(), batch.column("y").to_pylist(), strict=True):
                held += len(data) // 4
                if held <= max_columns or not rows:
                    rows.append(np.frombuffer(data, np.uint32))
                    good.append(y == 1)
        m = fit(rows, np.array(good, bool))
        yield pa.RecordBatch.from_pylist([{"weights": m.weights.tobytes(), "squares": m.squares.tobytes(),
                                           "numbers": [m.bias, m.slope, m.shift]}])

    fitted = sample.mapInArrow(fit_sample, "weights binary, squares binary, numbers array<double>").collect()
    if not fitted:
        return constant(0.5)
    (m,) = fitted
    return Model(np.frombuffer(m.weights, np.float32), np.frombuffer(m.squares, np.float32), *m.numbers)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of the document as a struct) and ``score``."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")  # the text is in it, so it is sent once
            for part in slices(pa.RecordBatch.from_arrays([row, row.field(place)], ["row", "text"]),
                               "text", SLICE):
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(model.score(part.column("text")), pa.float64())],
                    ["row", "score"])

    src = docs.select(F.struct("*").alias("row"))
    kind = f"row {src.schema['row'].dataType.simpleString()}, score double"
    return src.mapInArrow(run, kind)
