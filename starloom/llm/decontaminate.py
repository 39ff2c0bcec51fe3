"""Benchmark decontamination by Wu-Manber search over words.

Every window of ``width`` consecutive words of a benchmark text is a
pattern (a text of fewer words is one pattern of its own length).  Patterns
of one length share a shift table, indexed by the hash of a block of two
words: it tells how far the search may jump when the window ends in that
block.  Where the shift is zero the block ends some pattern; the bucket of
its suffix hash names the patterns, and they are compared with the text
word by word, byte by byte.  Many search positions (one for every
``SEGMENT`` words) advance together, so the loop runs over arrays.

The search is one map over the documents.  Patterns travel with the task:
a block of patterns comes from at most ``BLOCK_BYTES`` of benchmark text,
and a larger benchmark is searched block by block, with the hits of a
document merged by an aggregate.

Edge cases: null and empty texts have no words (never contaminated);
repeated documents give one row each; an item without words matches
nothing; items sharing an id count once; windows of items with a null id
mark words but are not listed; very long texts are searched whole; an empty
benchmark hits nothing; other columns are ignored (``flag_contaminated``
carries them in ``row``), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import NOT_ALNUM, Words, mix, slices, spans_equal, split_words

WIDTH = 10
SEGMENT = 512
BLOCK_BYTES = 4 << 20
BLOCK_BASE = 0x9E3779B97F4A7C15


class Patterns:
    """Benchmark windows of one length: shift table, suffix buckets, texts."""

    def __init__(self, words: Words, hashes: np.ndarray, starts: np.ndarray, length: int):
        # One pattern per distinct window: the first of its word-hash rows.
        rows = hashes[starts[:, None] + np.arange(length)]
        _, first, group = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        self.words, self.length = words, length
        self.group = group.reshape(-1)  # pattern number of every given window
        self.starts, self.rows = starts[first], rows[first]
        self.block = min(2, length)
        ends = np.arange(self.block - 1, length)
        blocks = block_hash(self.rows.reshape(-1), self.block)
        per = len(self.rows) * length
        bits = max(12, min(24, int(np.ceil(np.log2(8 * max(per, 1))))))
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, length - self.block + 1, np.uint8 if length < 256 else np.int32)
        for e in ends:
            slot = blocks[e::length][:len(self.rows)] >> self.down
            np.minimum.at(self.shift, slot, length - 1 - e)
        suffix = blocks[length - 1::length]
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.by_suffix = suffix[order], order

    def find(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word of a match, pattern) of all occurrences."""
        lead = w.first[w.doc] + self.length - 1  # first possible end in the word's text
        seg = np.concatenate([np.arange(a, b, SEGMENT) for a, b in
                              zip(w.first[:-1], w.first[1:], strict=True) if b - a >= self.length]
                             or [np.zeros(0, np.int64)])
        if not len(seg):
            return seg, seg
        stop = np.minimum(seg + SEGMENT, w.first[w.doc[seg] + 1])
        at = np.maximum(seg, lead[seg])
        block = block_hash(h, self.block)
        ends, found = [], []
        live = at < stop
        at, stop = at[live], stop[live]
        while len(at):
            value = block[at]
            jump = self.shift[value >> self.down]
            hit = np.flatnonzero(jump == 0)
            if len(hit):
                lo = np.searchsorted(self.suffix, value[hit], "left")
                many = np.searchsorted(self.suffix, value[hit], "right") - lo
                end = np.repeat(at[hit], many)
                nth = np.arange(len(end)) - np.repeat(np.cumsum(many) - many, many)
                pattern = self.by_suffix[np.repeat(lo, many) + nth]
                for j in range(self.length):  # hashes first, then the bytes
                    ok = h[end - self.length + 1 + j] == self.rows[pattern, j]
                    end, pattern = end[ok], pattern[ok]
                for j in range(self.length):
                    a, b = end - self.length + 1 + j, self.starts[pattern] + j
                    ok = spans_equal(w.buf, w.start[a], w.end[a], self.words.buf,
                                     self.words.start[b], self.words.end[b])
                    end, pattern = end[ok], pattern[ok]
                ends.append(end)
                found.append(pattern)
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        none = np.zeros(0, np.int64)
        return (np.concatenate(ends or [none]), np.concatenate(found or [none]))


def block_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the block of ``width`` words that ends at each word."""
    if width == 1:
        return mix(h)
    out = h.copy()
    out[1:] += h[:-1] * np.uint64(BLOCK_BASE)
    return mix(out)


class Search:
    """All patterns of a block of benchmark items, by length."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int):
        w = split_words(pa.array([t for _, t in items], pa.string()), NOT_ALNUM, lower=True)
        h = w.hashes()
        sizes = np.diff(w.first)
        self.parts: list[tuple[Patterns, list[np.ndarray]]] = []
        for length in sorted({min(width, int(s)) for s in sizes if s}):
            starts, owner = [], []
            for i, s in enumerate(sizes):
                if s and min(width, s) == length:
                    starts.append(np.arange(w.first[i], w.first[i] + s - length + 1))
                    owner.append(np.full(s - length + 1, i))
            p = Patterns(w, h, np.concatenate(starts), length)
            who = np.concatenate(owner)
            order = np.argsort(p.group, kind="stable")
            cuts = np.searchsorted(p.group[order], np.arange(len(p.starts) + 1))
            owners = [np.unique([items[k][0] for k in who[order[a:b]] if items[k][0] is not None])
                      for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            self.parts.append((p, owners))

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[list[int]]]:
        """Per text: number of words, hit words (as spans of word numbers) and item ids."""
        w = split_words(texts, NOT_ALNUM, lower=True)
        h = w.hashes()
        mark = np.zeros(len(w) + 1, np.int32)
        items: list[set[int]] = [set() for _ in range(len(texts))]
        for p, owners in self.parts:
            end, pattern = p.find(w, h)
            np.add.at(mark, end - p.length + 1, 1)
            np.add.at(mark, end + 1, -1)
            if len(end):
                pairs = np.unique(np.stack([w.doc[end], pattern]), axis=1)
                for d, k in pairs.T:
                    items[d].update(int(x) for x in owners[k])
        hit = np.cumsum(mark)[:-1] > 0
        spans = []
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].view(np.int8), [0]])))
            spans.append(edge.reshape(-1, 2))
        return np.diff(w.first), spans, [sorted(x, key=str) for x in items]


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated, items, spans`` (items sorted as strings;
    spans of hit words, end exclusive)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tests = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(item_text).alias("text"))
    n = n_blocks(tests, block_bytes)
    if n == 1:
        return finish(src.mapInArrow(scanner(_items(tests), width), HITS))
    merged = in_blocks(src, tests, width, n)
    # Repeated documents were scanned once each per block: give them back their rows.
    rows = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("rows") / n).cast("int"))))
    return finish(rows)


def flag_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                      id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (all columns of the document as a struct) and ``contaminated``."""
    src = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      F.col(text_col).alias("text"))
    tests = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(item_text).alias("text"))
    n = n_blocks(tests, block_bytes)
    if n == 1:
        kind = f"row {src.schema['row'].dataType.simpleString()}, {HITS}"
        hits = src.mapInArrow(scanner(_items(tests), width), kind)
        return hits.select("row", (F.size("spans") > 0).alias("contaminated"))
    merged = in_blocks(src.drop("row"), tests, width, n).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("d"), "key")
    both = src.withColumn("k", text_key()).join(
        merged, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("key")), "left")
    return both.select("row", F.col("key").isNotNull().alias("contaminated"))


def n_blocks(tests: DataFrame, block_bytes: int) -> int:
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // block_bytes))


def text_key():
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def in_blocks(src: DataFrame, tests: DataFrame, width: int, n: int) -> DataFrame:
    """Hits of every block of the benchmark, merged per document (id and
    text); ``rows`` counts its rows over all blocks."""
    placed = tests.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    keyed = src.withColumn("key", text_key())
    found = None
    for b in range(n):
        part = _items(placed.where(F.col("block") == b).drop("block"))
        one = keyed.mapInArrow(scanner(part, width), "key string, " + HITS)
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("doc_id", "key").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.count("*").alias("rows"))
    return merged.withColumn("spans", F.expr(_UNION))


# Union of sorted spans: extend the last one while the next begins inside it.
_UNION = """aggregate(spans, cast(array() as array<struct<lo:int,hi:int>>), (acc, s) ->
  if(size(acc) = 0 or s.lo > acc[size(acc) - 1].hi, concat(acc, array(s)),
     concat(slice(acc, 1, size(acc) - 1), array(named_struct(
       'lo', acc[size(acc) - 1].lo, 'hi', greatest(acc[size(acc) - 1].hi, s.hi))))))"""

HITS = "doc_id long, n_words long, spans array<struct<lo:int,hi:int>>, items array<long>"


def _items(tests: DataFrame) -> list[tuple[int | None, str | None]]:
    """A block of benchmark items (its size is bounded by the caller)."""
    return [tuple(r) for r in tests.where(F.octet_length("text") > 0).collect()]


def scanner(items: list[tuple[int | None, str | None]], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, width)
        for batch in batches:
            for part in slices(batch, "text"):
                n_words, spans, found = search.scan(part.column("text"))
                size = np.array([len(s) for s in spans], np.int64)
                flat = np.concatenate(spans) if len(spans) else np.zeros((0, 2), np.int64)
                lohi = pa.StructArray.from_arrays(
                    [pa.array(flat[:, 0], pa.int32()), pa.array(flat[:, 1], pa.int32())], ["lo", "hi"])
                cols = {"doc_id": part.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                        "spans": pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), lohi),
                        "items": pa.array(found, pa.list_(pa.int64()))}
                for name in ("key", "row"):
                    if name in part.schema.names:
                        cols = {name: part.column(name)} | cols
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
    return run


def finish(hits: DataFrame) -> DataFrame:
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.hi - s.lo)")
    listed = F.expr("array_join(array_sort(transform(items, i -> cast(i as string))), ',')")
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), "items", "spans")
