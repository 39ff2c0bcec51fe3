"""Removal of repeated token windows (Rabin-Karp, counted in Spark).

Every window of ``width`` consecutive words gets a Rabin-Karp hash of 80
bits.  A word goes when it lies in a window whose word sequence also starts
in a document with a smaller id; windows are judged on the input.

Documents are dealt into chunks by a hash, once.  A chunk keeps one entry
per distinct window (its smallest document), sorts the entries and sends
them, bucketed by hash range and packed as compressed columns of hash
differences and document ids, to the buckets.  A bucket returns one bit per
entry: does a smaller document elsewhere hold the window?  The chunk meets
its bits again (Spark reuses the exchange that dealt the texts), merges the
repeated windows into maximal intervals and cuts them out.  A window that
a third of all documents share is one entry per chunk, not one per
occurrence, and only bits travel back.

Two different windows share 80 bits with probability 8e-25, so over 8e9
windows (30 GB of documents) 3e-5 false matches are expected.

Edge cases: a null text has no words; a document shorter than the window
keeps all its words; documents with equal ids never remove each other's
words; documents with a null id are kept whole and remove nothing;
repeated rows give one row each; very long texts are windowed whole; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import Words, mix, slices, split_words, window_hashes

WIDTH = 50
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
PART_BYTES = 4 << 20
BASE_1 = 0x5851F42D4C957F2D
BASE_2 = 0x14057B7EF767814F | 1
SECOND = np.uint64(0xA0761D6478BD642F)
ENTRY = 18  # bytes of an entry: hash difference 8, second hash 2, document id 8

RESULT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
          "removed array<struct<lo:int,hi:int>>, kept string")


@dataclass
class Windows:
    """Windows of the documents of a chunk, ordered by document id: two
    hashes, document (number and id) and first word of each."""

    parts: list[Words]
    ids: list[np.ndarray]
    rows: list[np.ndarray]
    key: np.ndarray
    second: np.ndarray
    doc_id: np.ndarray
    part: np.ndarray
    word: np.ndarray


def windows(chunk: pa.Table, width: int) -> Windows:
    ids = chunk.column("doc_id").combine_chunks()
    order = np.argsort(ids.fill_null(0).to_numpy(zero_copy_only=False), kind="stable")
    batch = pa.RecordBatch.from_arrays(
        [ids.take(pa.array(order)), chunk.column("text").combine_chunks().take(pa.array(order))],
        ["doc_id", "text"])
    out = Windows([], [], [], *[[] for _ in range(5)])
    row = 0
    for n, part in enumerate(slices(batch, "text", PART_BYTES)):
        w = split_words(part.column("text"))
        own = part.column("doc_id")
        known = own.is_valid().to_numpy(zero_copy_only=False)
        number = own.fill_null(0).to_numpy(zero_copy_only=False)
        h = w.hashes()
        key = window_hashes(h, width, BASE_1)
        second = window_hashes(mix(h ^ SECOND), width, BASE_2) >> np.uint64(48)
        d = w.doc[:len(key)]
        ok = np.flatnonzero((d == w.doc[width - 1:]) & known[d]) if len(key) else np.zeros(0, np.int64)
        out.parts.append(w)
        out.ids.append(own)
        out.rows.append(order[row:row + part.num_rows])
        out.key.append(key[ok])
        out.second.append(second[ok].astype(np.uint16))
        out.doc_id.append(number[d[ok]].astype(np.int64))
        out.part.append(np.full(len(ok), n, np.int32))
        out.word.append(ok.astype(np.int64))
        row += part.num_rows
    for name, kind in (("key", np.uint64), ("second", np.uint16), ("doc_id", np.int64),
                       ("part", np.int32), ("word", np.int64)):
        setattr(out, name, np.concatenate([*getattr(out, name), np.zeros(0, kind)]))
    return out


def entries(w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Windows in hash order, and where among them each distinct window
    begins (with its smallest document, since documents ascend)."""
    order = np.argsort(w.key, kind="stable")
    key, second = w.key[order], w.second[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
    return order, np.flatnonzero(new)


def bucket_of(key: np.ndarray, n_buckets: int) -> np.ndarray:
    """Ranges of the hash: buckets ascend with it."""
    return ((key >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def pack(key: np.ndarray, second: np.ndarray, doc_id: np.ndarray) -> bytes:
    n = len(key)
    block = np.empty((n, ENTRY), np.uint8)
    block[:, :8] = np.diff(key, prepend=np.uint64(0)).view(np.uint8).reshape(n, 8)
    block[:, 8:10] = second.view(np.uint8).reshape(n, 2)
    block[:, 10:] = doc_id.view(np.uint8).reshape(n, 8)
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(block.T).tobytes(), asbytes=True)


def unpack(n: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = pa.Codec("zstd").decompress(data, n * ENTRY, asbytes=True)
    block = np.frombuffer(raw, np.uint8).reshape(ENTRY, n).T
    take = lambda a, b, kind: np.ascontiguousarray(block[:, a:b]).view(kind).reshape(n)
    return np.cumsum(take(0, 8, np.uint64)), take(8, 10, np.uint16), take(10, 18, np.int64)


def sender(width: int, n_buckets: int):
    def run(key: tuple, chunk: pa.Table) -> pa.Table:
        w = windows(chunk, width)
        order, first = entries(w)
        lead = order[first]
        k, s, d = w.key[lead], w.second[lead], w.doc_id[lead]
        buckets, at = np.unique(bucket_of(k, n_buckets), return_index=True)
        cuts = [*at, len(k)]
        rows = [(int(b), cuts[i + 1] - cuts[i],
                 pack(k[cuts[i]:cuts[i + 1]], s[cuts[i]:cuts[i + 1]], d[cuts[i]:cuts[i + 1]]))
                for i, b in enumerate(buckets)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()),
                         "chunk": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "n": pa.array([r[1] for r in rows], pa.int64()),
                         "entries": pa.array([r[2] for r in rows], pa.binary())})
    return run


def mark_repeated(key: tuple, rows: pa.Table) -> pa.Table:
    """One bit per entry: is the window also in a document with a smaller id?"""
    sizes = rows.column("n").to_pylist()
    data = [unpack(n, x) for n, x in zip(sizes, rows.column("entries").to_pylist(), strict=True)]
    k, s, d = (np.concatenate([x[i] for x in data]) for i in range(3))
    order = np.argsort(k, kind="stable")
    new = np.ones(len(k), bool)
    new[1:] = k[order][1:] != k[order][:-1]
    if (~new[1:] & (s[order][1:] != s[order][:-1])).any():  # equal in the first hash only
        order = np.lexsort((s, k))
        new[1:] = (k[order][1:] != k[order][:-1]) | (s[order][1:] != s[order][:-1])
    first = np.flatnonzero(new)
    least = np.repeat(np.minimum.reduceat(d[order], first), np.diff(first, append=len(k)))
    later = np.empty(len(k), bool)
    later[order] = d[order] > least
    out = []
    for chunk, part in zip(rows.column("chunk").to_pylist(),
                           np.split(later, np.cumsum(sizes)[:-1]), strict=True):
        if part.any():
            out.append((chunk, key[0].as_py(), np.packbits(part).tobytes()))
    return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()),
                     "bucket": pa.array([x[1] for x in out], pa.int64()),
                     "bits": pa.array([x[2] for x in out], pa.binary())})


def remover(width: int, n_buckets: int, with_text: bool):
    def run(key: tuple, chunk: pa.Table, marks: pa.Table) -> pa.Table:
        w = windows(chunk, width)
        order, first = entries(w)
        lead = order[first]
        later = np.zeros(len(first), bool)
        bucket = bucket_of(w.key[lead], n_buckets)
        for b, bits in zip(marks.column("bucket").to_pylist(), marks.column("bits").to_pylist(),
                           strict=True):
            lo, hi = np.searchsorted(bucket, [b, b + 1])
            later[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo)
        size = np.diff(first, append=len(order))
        gone = np.repeat(later, size) | (w.doc_id[order] > np.repeat(w.doc_id[lead], size))
        gone = order[gone]
        out = []
        for n, (words, ids) in enumerate(zip(w.parts, w.ids, strict=True)):
            start = w.word[gone[w.part[gone] == n]]
            mark = np.zeros(len(words) + 1, np.int32)
            np.add.at(mark, start, 1)
            np.add.at(mark, start + width, -1)
            out.append(result(words, ids, np.cumsum(mark)[:-1] > 0, with_text))
        return pa.concat_tables(out)
    return run


def result(w: Words, ids: pa.Array, removed: np.ndarray, with_text: bool) -> pa.Table:
    """Rows of the documents of a slice, given which of their words go."""
    keep = np.flatnonzero(~removed)
    size = w.end[keep] - w.start[keep] + 1  # with the space after it
    done = np.cumsum(size)
    total = int(done[-1]) if len(done) else 0
    data = w.buf[np.repeat(w.start[keep] - (done - size), size) + np.arange(total)]
    data[done - 1] = 0x20
    text = data.tobytes()
    at = np.concatenate([[0], done])[np.searchsorted(keep, w.first)]  # where each text begins
    kept = [text[a:max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]
    spans, gone = [], []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], removed[a:b].view(np.int8), [0]])))
        spans.append([{"lo": int(x), "hi": int(y)} for x, y in edge.reshape(-1, 2)])
        gone.append(int(removed[a:b].sum()))
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    return pa.table({"doc_id": ids, "n_words": pa.array(np.diff(w.first), pa.int64()),
                     "n_removed": pa.array(gone, pa.int64()),
                     "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                     "removed": pa.array(spans, kind),
                     "kept": pa.array([x.decode() if with_text else None for x in kept], pa.string())})


def remove_repeated(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
                    text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document (columns of ``RESULT``): removed intervals of
    word numbers, end exclusive, and the kept words joined by one space."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks, n_buckets = max(1, -(-size // CHUNK_BYTES)), max(1, -(-size // BUCKET_BYTES))
    dealt = src.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("long"))
    sent = dealt.groupBy("chunk").applyInArrow(
        sender(width, n_buckets), "bucket long, chunk long, n long, entries binary")
    marks = sent.groupBy("bucket").applyInArrow(mark_repeated, "chunk long, bucket long, bits binary")
    return dealt.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(
        remover(width, n_buckets, with_text), RESULT)
