"""Exact n-gram Jaccard join with a count-vector R-tree.

A document's set is its distinct shingles of ``SHINGLE`` lower-cased words.
Documents with equal sets are collapsed first.  Two sets a, b link when
100 |a & b| >= 85 |a | b|, that is 185 |a & b| >= 85 (|a| + |b|).

*Where pairs can meet.*  Under any fixed order of all shingles, two linked
sets share one of their first |a| - ceil(.85 |a|) + 1 shingles.  The order
puts shingles that many documents have last; how frequent they are comes
from a fixed-size count sketch over all documents (its errors only cost
time).  Sets that share such a shingle form a block.

*Which pairs can link.*  Shingles are hashed into groups and a set becomes
the point of its group counts; the overlap of two sets is at most the sum
of the coordinate minima of their points.  The points of a block are put
in an R-tree whose nodes, up to the root, hold the upper corner and the
sizes of their points, and pairs are searched from the root down with that
bound (a block of up to ``LEAF`` points is one leaf), in both rounds.
Blocks larger than ``TILE`` are split into tiles that meet pairwise.

*Verification.*  Surviving pairs are intersected shingle by shingle.  The
first round keeps the rows of the blocks with any surviving partner and
verifies the pair with the smallest one (so a group of near copies is
compared with one of them); sets that it joins into one component need no further comparison,
so the second round searches only for pairs between different components.
There the blocks that share sets are searched as one (so a set travels
once), the shingles travel along, every surviving pair is verified where
it is found unless its sets have been joined meanwhile, and only
links that join something leave the task.

Sets and shingles are compared by 64-bit hashes.  With 1e8 different sets
two share a hash with probability 3e-4.

Edge cases: null and empty texts have no words: an empty set, linked with
nothing; a text of one to three words is one shingle; repeated rows give
one row each; a null id never names a component unless all ids of the
component are null; very long texts are sets of all their shingles; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.words import Words, mix, slices, split_words, window_hashes
from starloom.session import cut_lineage

SHINGLE = 4
PERCENT = 85
BASE = 0x9FB21C651E98DF25
SKETCH_BITS = 18
SEGMENTS = 16
FAN_IN = 64
TILE = 1024
TILE_SHINGLES = 1 << 19
BUCKET_SHINGLES = 1 << 20
LEAF = 32
FAN_OUT = 8
SLAB = 512
PER_GROUP = 4
FILTER_BITS = 17  # words of 64 bits: one MB

POINTS = ("doc_id long, at long, n long, set_id long, groups binary, task int, segment int, counts binary")


def shingle_sets(w: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a slice."""
    h = w.hashes()
    whole = window_hashes(h, size, BASE)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a:b - size + 1]))
        elif b > a:  # the whole sequence, apart from all full shingles
            out.append(mix(window_hashes(h[a:b], int(b - a), BASE) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    total = mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def group_counts(s: np.ndarray) -> np.ndarray:
    """Point of a set: about ``PER_GROUP`` shingles in each of 2**k groups,
    with more groups if a count would not fit a byte."""
    k = max(int(len(s) // PER_GROUP).bit_length(), 3)
    while True:
        counts = np.bincount((s & np.uint64((1 << k) - 1)).astype(np.int64), minlength=1 << k)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        k += 1


def fold(counts: np.ndarray, size: int) -> np.ndarray:
    """The same point with fewer groups (groups are nested)."""
    return counts.reshape(-1, size).sum(axis=0, dtype=np.int32)


def counter_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def points_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(split_words(part.column("text"), lower=True), size)
                sketch += np.bincount(counter_of(np.concatenate([*sets, np.zeros(0, np.uint64)])),
                                      minlength=len(sketch))
                n = len(sets)
                yield _points(part.column("doc_id"), part.column("at"), [len(s) for s in sets],
                              [set_id(s) if len(s) else None for s in sets],
                              [group_counts(s).tobytes() if len(s) else None for s in sets],
                              [None] * n, [None] * n, [None] * n)
        none = [None] * SEGMENTS
        yield _points(none, none, none, none, none, [task] * SEGMENTS, list(range(SEGMENTS)),
                      [x.tobytes() for x in np.split(sketch, SEGMENTS)])
    return run


def _points(*cols) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
        [c.split()[0] for c in POINTS.split(", ")])


def sum_sketches(sketches: DataFrame) -> np.ndarray:
    """Sum of the tasks' sketches, ``FAN_IN`` at a time; its size is fixed."""
    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in rows.column("counts").to_pylist())
        first = rows.slice(0, 1)
        return pa.table({"task": pa.array([first["task"][0].as_py() // FAN_IN], pa.int32()),
                         "segment": first["segment"], "counts": pa.array([total.tobytes()], pa.binary())})

    left = (sketches.agg(F.max("task")).first()[0] or 0) + 1
    while left > 1:
        sketches = sketches.groupBy("segment", F.floor(F.col("task") / FAN_IN)).applyInArrow(
            add, "task int, segment int, counts binary")
        left = -(-left // FAN_IN)
    parts = dict(sketches.select("segment", "counts").collect())  # SEGMENTS rows of a fixed size
    empty = np.zeros((1 << SKETCH_BITS) // SEGMENTS, np.int64)
    return np.concatenate([np.frombuffer(parts[i], np.int64) if i in parts else empty
                           for i in range(SEGMENTS)])


def keys_task(size: int, percent: int, counts: np.ndarray):
    """The first shingles of every set, rarest first: (key, set_id, n)."""
    least = percent // (100 - percent) + (percent % (100 - percent) > 0)  # smaller sets link equal ones only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, ids, sizes = [], [], []
                for s in shingle_sets(split_words(part.column("text"), lower=True), size):
                    n = len(s)
                    if n < least or (i := set_id(s)) in seen:
                        continue
                    seen.add(i)
                    if len(seen) > 1 << 20:
                        seen.clear()
                    first = n + percent * n // -100 + 1
                    order = np.lexsort((s, counts[counter_of(s)]))[:first]
                    keys.append(s[order].view(np.int64))
                    ids.append(np.full(first, i))
                    sizes.append(np.full(first, n))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x), pa.int64()) for x in (keys, ids, sizes)],
                        ["key", "set_id", "n"])
    return run


def bit_filter(ids: DataFrame) -> np.ndarray:
    """A bit array of fixed size in which the bits of the ids are set."""
    word = F.expr(f"shiftrightunsigned(set_id, {64 - FILTER_BITS})")
    rows = ids.groupBy(word.alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(set_id & 63 as int)))").alias("bits")).collect()
    out = np.zeros(1 << FILTER_BITS, np.int64)
    if rows:
        out[[r.word for r in rows]] = [r.bits for r in rows]
    return out


def sets_task(size: int, bits: np.ndarray):
    """The shingles of the sets that the bit array lets through (all that it was made of)."""
    def passes(i: int) -> bool:
        return bool(int(bits[(i % 2**64) >> (64 - FILTER_BITS)]) >> (i & 63) & 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = {set_id(s): s for s in
                        shingle_sets(split_words(part.column("text"), lower=True), size) if len(s)}
                sets = {i: s for i, s in sets.items() if passes(i)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sets), pa.int64()), pa.array([s.tobytes() for s in sets.values()], pa.binary())],
                    ["set_id", "data"])
    return run


class CountTree:
    """R-tree over count vectors.  Every node holds the upper corner of its
    points and their smallest and largest size; leaves have up to ``LEAF``
    points, inner nodes ``FAN_OUT`` nodes of the level below."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        order = np.argsort(sizes, kind="stable")
        for a in range(0, len(order), SLAB):  # sort-tile: by size, then by the widest coordinate
            slab = order[a:a + SLAB]
            axis = int(points[slab].var(axis=0).argmax())
            order[a:a + SLAB] = slab[np.argsort(points[slab, axis], kind="stable")]
        self.points, self.sizes, self.order = points, sizes, order
        first = np.arange(0, len(order), LEAF)
        self.levels = [(np.maximum.reduceat(points[order], first), np.minimum.reduceat(sizes[order], first),
                        np.maximum.reduceat(sizes[order], first))]
        while len(self.levels[-1][1]) > FAN_OUT:
            upper, least, most = self.levels[-1]
            first = np.arange(0, len(least), FAN_OUT)
            self.levels.append((np.maximum.reduceat(upper, first), np.minimum.reduceat(least, first),
                                np.maximum.reduceat(most, first)))

    def search(self, point: np.ndarray, n: int) -> np.ndarray:
        """Rows whose overlap bound with the point reaches the threshold."""
        p = self.percent
        near = np.arange(len(self.levels[-1][1]))
        for level in range(len(self.levels) - 1, -1, -1):  # from the root down
            upper, least, most = self.levels[level]
            near = near[(100 * n >= p * least[near]) & (100 * most[near] >= p * n)]
            bound = np.minimum(upper[near], point).sum(axis=1)
            near = near[may_link(bound, n, np.maximum(least[near], -(-p * n // 100)), p)]
            fan, below = (FAN_OUT, len(self.levels[level - 1][1])) if level else (LEAF, len(self.order))
            near = (near[:, None] * fan + np.arange(fan)).ravel()
            near = near[near < below]
        rows = self.order[near]
        size = self.sizes[rows]
        rows = rows[(100 * n >= p * size) & (100 * size >= p * n)]
        bound = np.minimum(self.points[rows], point).sum(axis=1)
        return rows[may_link(bound, n, self.sizes[rows], p)]


def may_link(overlap, n, m, percent: int):
    """Can sets of n and m shingles with at most this overlap link?"""
    return (100 + percent) * overlap >= percent * (n + m)


class Blocks:
    """A bucket of blocks, rows ordered by block and set.  Sides 0 and 1 are
    two tiles of a block that meet, side 2 is a tile with itself."""

    def __init__(self, rows: pa.Table, percent: int):
        key = np.stack([rows.column(c).to_numpy() for c in ("key", "lo", "hi")])
        order = np.lexsort((rows.column("set_id").to_numpy(), key[2], key[1], key[0]))
        key = key[:, order]
        self.percent, self.key = percent, key[0]
        self.sets, self.n, self.comp, self.side = (
            rows.column(c).to_numpy()[order] for c in ("set_id", "n", "component", "side"))
        data = rows.column("data").combine_chunks().cast(pa.large_binary()).take(pa.array(order))
        self.at = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
        self.data = np.frombuffer(data.buffers()[2], np.uint8)
        self.first = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
        self.size = np.diff(self.first, append=len(order))

    def bytes_of(self, i: int) -> np.ndarray:
        return self.data[self.at[i]:self.at[i + 1]]

    def allowed(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        lo, hi = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        return ((self.comp[i] != self.comp[j]) & (self.sets[i] != self.sets[j])
                & (100 * lo >= self.percent * hi) & ((self.side[i] == 2) | (self.side[i] != self.side[j])))

    def near_pairs(self) -> np.ndarray:
        """Allowed pairs inside the blocks of one leaf, each pair of sets once."""
        block = np.repeat(np.arange(len(self.first)), self.size)
        small = np.where(self.size <= LEAF, self.size, 0)[block]
        found = [np.zeros((2, 0), np.int64)]
        for d in range(1, int(small.max(initial=0))):
            i = np.arange(len(block) - d)
            i = i[(block[i] == block[i + d]) & (small[i] > d)]
            found.append(np.stack([i, i + d])[:, self.allowed(i, i + d)])
        pairs = np.concatenate(found, axis=1)
        _, one = np.unique(np.sort(self.sets[pairs], axis=0), axis=1, return_index=True)
        return pairs[:, one]

    def large(self, points) -> Iterator[tuple[int, np.ndarray]]:
        """Row and its allowed partners by the trees of the blocks of more than one leaf."""
        for b in np.flatnonzero(self.size > LEAF):
            at = np.arange(self.first[b], self.first[b] + self.size[b])
            tree_of = at[self.side[at] != 1]
            asks = tree_of if self.side[at[0]] == 2 else at[self.side[at] == 1]
            if not len(tree_of) or not len(asks):
                continue
            point = {int(i): points(i) for i in at}
            least = min(len(x) for x in point.values())
            point = {i: fold(x, least) for i, x in point.items()}
            tree = CountTree(np.stack([point[int(i)] for i in tree_of]), self.n[tree_of], self.percent)
            for i in asks:
                hit = tree_of[tree.search(point[int(i)], int(self.n[i]))]
                hit = hit[(hit > i) | (self.side[i] != 2)]
                yield int(i), hit[self.allowed(np.full(len(hit), i), hit)]


def first_pairs(percent: int):
    """Rows of the blocks with any surviving partner, and the smallest one (data: points)."""
    def run(rows: pa.Table) -> pa.Table:
        blocks = Blocks(rows, percent)
        near = blocks.near_pairs()
        out = [near[:, bounded(blocks, *near)]]
        out += [np.stack([np.full(len(hit), i), hit]) for i, hit in blocks.large(blocks.bytes_of)]
        i, j = np.concatenate(out, axis=1)
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
        order = np.lexsort((blocks.sets[j], i))
        _, one = np.unique(i[order], return_index=True)
        i, j = i[order][one], j[order][one]
        return pa.table({"key": pa.array(blocks.key[i], pa.int64()), "set_id": pa.array(blocks.sets[i], pa.int64()),
                         "n": pa.array(blocks.n[i], pa.int64()), "other": pa.array(blocks.sets[j], pa.int64())})
    return run


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets of shingles."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[at] == b).sum())


def joining_links(percent: int):
    """Links between different components that join something new (data: shingles)."""
    def run(rows: pa.Table) -> pa.Table:
        blocks = Blocks(rows, percent)
        parent: dict[int, int] = {}
        links: list[tuple[int, int]] = []

        def shingles(i: int) -> np.ndarray:
            return np.frombuffer(blocks.bytes_of(i).tobytes(), np.uint64)

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        def compare(i: int, partners) -> None:
            own = shingles(i)
            for j in partners:
                a, b = root(int(blocks.comp[i])), root(int(blocks.comp[j]))
                if a == b:
                    continue
                other = shingles(j)
                if may_link(overlap(own, other), len(own), len(other), percent):
                    parent[max(a, b)] = min(a, b)
                    links.append((int(blocks.sets[i]), int(blocks.sets[j])))

        points: dict[int, np.ndarray] = {}

        def point(i: int) -> np.ndarray:
            if i not in points:
                points[i] = group_counts(shingles(i))
            return points[i]

        for i, j in blocks.near_pairs().T:
            # One leaf: its points are bounded one by one.
            a, b = point(int(i)), point(int(j))
            least = min(len(a), len(b))
            if may_link(np.minimum(fold(a, least), fold(b, least)).sum(), blocks.n[i], blocks.n[j], percent):
                compare(int(i), [int(j)])
        points.clear()
        for i, hit in blocks.large(lambda i: group_counts(shingles(i))):
            compare(i, hit)
        return pa.table({"a": pa.array([min(x) for x in links], pa.int64()),
                         "b": pa.array([max(x) for x in links], pa.int64())})
    return run


def bounded(blocks: Blocks, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows the sum of coordinate minima leaves, width by width."""
    width = np.diff(blocks.at)
    bound = np.zeros(len(i), np.int64)
    least = np.minimum(width[i], width[j])

    def points(rows: np.ndarray, to: int) -> np.ndarray:
        out = np.empty((len(rows), to), np.int32)
        for own in np.unique(width[rows]):
            which = np.flatnonzero(width[rows] == own)
            full = blocks.data[blocks.at[rows[which]][:, None] + np.arange(own)]
            out[which] = full.reshape(len(which), -1, to).sum(axis=1, dtype=np.int32)
        return out

    for to in np.unique(least):
        every = np.flatnonzero(least == to)
        step = max(1, (1 << 22) // int(to))
        for k in range(0, len(every), step):
            part = every[k:k + step]
            bound[part] = np.minimum(points(i[part], to), points(j[part], to)).sum(axis=1)
    return may_link(bound, blocks.n[i], blocks.n[j], blocks.percent)


def search(placed: DataFrame, data: DataFrame, task, kind: str) -> DataFrame:
    """Distinct rows (of type ``kind``) that ``task`` finds in the buckets of open
    blocks.  ``placed``: key, set_id, n, component; blocks within one
    component are done.  ``data``: set_id and what the task needs of a set."""
    open_keys = placed.groupBy("key").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"),
                                          F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo <> hi").select("key", F.ceil(F.greatest(
            F.col("rows") / TILE, F.col("shingles") / TILE_SHINGLES)).cast("int").alias("tiles"))
    rows = cut_lineage(placed.join(open_keys, "key"), "open-blocks")
    total = rows.agg(F.sum(F.col("n") * F.col("tiles"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(max(1, total // BUCKET_SHINGLES)))
    tiled = rows.join(data, "set_id") \
        .withColumn("tile", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumn("side", F.expr("case when tile = other then 2 when tile < other then 0 else 1 end")) \
        .select("key", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
                "side", "set_id", "n", "component", "data")
    return tiled.groupBy(bucket).applyInArrow(task, kind).distinct()


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact overlap reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                ok.append(bool(may_link(overlap(s, t), len(s), len(t), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = sets.select(F.col("set_id").alias("a"), F.col("data").alias("x"))
    two = sets.select(F.col("set_id").alias("b"), F.col("data").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text", with_rows: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``; ``with_rows``
    adds ``at`` (xxhash64 of the text) and ``component`` (null without words),
    which tell documents of one id, or of none, apart."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    at = F.xxhash64("text") if with_rows else F.lit(None).cast("long")
    every = cut_lineage(src.withColumn("at", at).mapInArrow(points_task(size), POINTS), "points")
    counts = sum_sketches(every.where("segment is not null").select("task", "segment", "counts"))
    points = every.where("segment is null")

    # One exchange by key: the shared keys and their rows are found in it.
    keys = src.mapInArrow(keys_task(size, percent, counts), "key long, set_id long, n long") \
        .where("key is not null").repartition("key")
    # Blocks with the same members (sums of two hashes agree) are one block.
    shared = keys.groupBy("key").agg(
        F.min("set_id").alias("lo"), F.max("set_id").alias("hi"), F.sum("n").alias("rows"),
        F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("s1"),
        F.sum(F.xxhash64(F.lit(1), "set_id").cast("decimal(38,0)")).alias("s2")) \
        .where("lo <> hi").groupBy("lo", "hi", "rows", "s1", "s2").agg(F.min("key").alias("key")).select("key")
    rows = cut_lineage(keys.join(shared, "key").distinct(), "shared-keys")
    # Sets of too different sizes never link: a block is split into bands of
    # sizes, each set stands in two, and those with one set only are dropped.
    wide = float(np.log(100 / percent) * (1 + 1e-9))
    bands = rows.withColumn("band", F.explode(F.expr(
        f"array(floor(ln(n) / {wide!r}D), floor(ln(n) / {wide!r}D) + 1)"))) \
        .select(F.xxhash64("key", "band").alias("key"), "set_id", "n")
    useful = bands.groupBy("key").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")) \
        .where("lo <> hi").select("key")
    blocks = cut_lineage(bands.join(useful, "key"), "blocks")

    involved = blocks.select("set_id").distinct()
    known = cut_lineage(points.join(involved, "set_id", "left_semi").groupBy("set_id").agg(
        F.first("groups").alias("data")), "known-sets")
    live = cut_lineage(search(blocks.withColumn("component", F.col("set_id")), known, first_pairs(percent),
                              "key long, set_id long, n long, other long"), "live-rows")
    tried = live.select(F.least("set_id", "other").alias("a"), F.greatest("set_id", "other").alias("b")).distinct()

    # The shingles of the sets that have any partner (the others' pairs are all excluded).
    ends = cut_lineage(live.select("set_id").distinct(), "ends")
    sets = cut_lineage(src.mapInArrow(sets_task(size, bit_filter(ends)), "set_id long, data binary")
                       .join(ends, "set_id", "left_semi").dropDuplicates(["set_id"]), "shingle-sets")
    links = cut_lineage(verify(tried, sets, percent), "first-links")
    joined = components(links)

    # Sets of blocks that meet form a family; a set travels once per family, not once per block.
    ends_of = live.groupBy("key").agg(F.min("set_id").alias("a"))
    family = components(live.join(ends_of, "key").select("a", F.col("set_id").alias("b")))
    placed = live.select("set_id", "n").distinct() \
        .join(family.select(F.col("node").alias("set_id"), F.col("component").alias("key")), "set_id") \
        .join(joined.withColumnRenamed("node", "set_id"), "set_id", "left") \
        .withColumn("component", F.coalesce("component", "set_id"))
    more = cut_lineage(search(placed, sets, joining_links(percent), "a long, b long"), "more-links")
    joined = components(links.union(more))

    # Back to the documents.
    least = points.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    named = least.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left") \
        .withColumn("component", F.coalesce("component", "set_id"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    names = named.join(smallest, "component").select("set_id", "component_id", "component")
    more = ["at", "component"] if with_rows else []
    full = points.where("set_id is not null").join(names, "set_id") \
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", *more)
    return full.unionByName(points.where("set_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "at",
        F.lit(None).cast("long").alias("component")).select(full.columns))
