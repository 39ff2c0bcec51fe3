"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Vectors are compared inside their label only.  Equal vectors are collapsed
to one first.  The rest of a label is dealt into tiles of about ``TILE``
vectors, and every pair of tiles of the label meets once.  A unit vector u
is quantised to integers q of -127..127 with u = s q + e; since
|u| = 1, |<u,v> - s_u s_v <q_u,q_v>| <= |e_u| + |e_v| (1 + |e_u|).  The tile
product over the integers (exact: products of a block of 1024 coordinates
stay below 2**24) plus that bound leaves few pairs, and only those are
computed in double precision.  A tile pair returns the number of links of
its vectors and a spanning forest of them, never the pairs.  Components of
the forests of all tiles are the components of the links.

Edge cases: vectors that are null, zero, or hold a null, NaN or infinite
component link with nothing, nor do vectors of a null label; vectors of
different lengths do not link; repeated ids give one row each (they are
compared as separate vectors and share the component id of their id); a
null id is kept as a row of its own with a null component; other columns are
ignored, whatever their names; there are no texts.  Vectors of any finite size
are compared: extreme ones are scaled by their largest component first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.session import cut_lineage

THRESHOLD = 0.98
TILE = 2048
EXACT_BLOCK = 1024
PAIRS_AT_ONCE = 1 << 16


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors in double precision, their int8 form, scale and error bound."""
    with np.errstate(over="ignore", under="ignore"):
        size = np.linalg.norm(x, axis=1, keepdims=True)
    far = ~((size > 1e-100) & (size < 1e100)).ravel()  # their squares leave the range of doubles
    if far.any():
        x, size = x.copy(), size.copy()
        x[far] /= np.abs(x[far]).max(axis=1, keepdims=True)
        size[far] = np.linalg.norm(x[far], axis=1, keepdims=True)
    unit = x / size
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return unit, q, scale, error


def integer_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows: float32 holds every block's sum exactly."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_BLOCK):
        out += a[:, i:i + EXACT_BLOCK].astype(np.float32) @ b[:, i:i + EXACT_BLOCK].astype(np.float32).T
    return out


def tile_links(x: np.ndarray, y: np.ndarray, same: bool, threshold: float
               ) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (of x, of y) of the pairs with cosine >= threshold; for
    a tile with itself each pair once, x before y."""
    ux, qx, sx, ex = quantise(x)
    uy, qy, sy, ey = (ux, qx, sx, ex) if same else quantise(y)
    most = integer_product(qx, qy) * sx[:, None] * sy[None, :]
    most += ex[:, None] + ey[None, :] * (1 + ex[:, None])
    i, j = np.nonzero(most >= threshold)
    if same:
        i, j = i[i < j], j[i < j]
    ok = np.zeros(len(i), bool)
    for k in range(0, len(i), PAIRS_AT_ONCE):
        s = slice(k, k + PAIRS_AT_ONCE)
        ok[s] = np.einsum("ij,ij->i", ux[i[s]], uy[j[s]]) >= threshold
    return i[ok], j[ok]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Edge (node, smallest node) of a spanning forest of the links: labels
    shrink along links until they are stable."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def tile_pair(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        part = rows.column("tile").to_numpy()
        which = np.unique(part)
        dim = rows.column("dim")[0].as_py()
        data = rows.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        own, rep = rows.column("own").to_numpy(), rows.column("rep").to_numpy()
        many = rows.column("copies").to_numpy()
        a = np.flatnonzero(part == which[0])
        b = a if own[0] else np.flatnonzero(part == which[-1])
        if not own[0] and len(which) < 2:
            i = j = np.zeros(0, np.int64)
        else:
            i, j = tile_links(data[a], data[b], bool(own[0]), threshold)
        i, j = a[i], b[j]
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, i, many[j])
        np.add.at(links, j, many[i])
        root = forest(len(rep), i, j)
        hit = np.flatnonzero(links > 0)
        return pa.table({"rep": pa.array(rep[hit], pa.int64()), "links": pa.array(links[hit], pa.int64()),
                         "root": pa.array(rep[root[hit]], pa.int64())})
    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vec_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vec_col).cast("array<double>").alias("vec"),
                         F.col(label_col).alias("label"))
    finite = F.expr("forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    usable = (F.col("label").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False))
              & F.coalesce(F.expr("exists(vec, x -> x <> 0)"), F.lit(False)))
    # -0.0 and 0.0 are one value; the key stands for the whole vector.
    plain = F.expr("transform(vec, x -> x + 0.0D)")
    src = src.withColumn("key", F.when(usable, F.sha2(F.to_json(F.struct(plain.alias("v"))), 256)))
    src = cut_lineage(src.select("vec_id", "label", "key", F.when(usable, plain).alias("vec")), "vectors")

    groups = cut_lineage(src.where("key is not null").groupBy("label", "key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vec").alias("vec"),
        F.xxhash64("label", "key").alias("rep")), "vector-groups")
    kinds = groups.groupBy("label", F.size("vec").alias("dim")).agg(F.count("*").alias("n")) \
        .select("label", "dim", F.ceil(F.col("n") / F.lit(tile)).cast("int").alias("tiles"))
    dealt = groups.withColumn("dim", F.size("vec")).join(kinds, ["label", "dim"]).withColumn(
        "tile", F.pmod(F.col("rep"), F.col("tiles")).cast("int"))
    meet = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "dim", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
        (F.col("tile") == F.col("other")).alias("own"), "tile", "rep", "copies", "vec")
    # A tile meets itself in group (t, t) only; in (t, u) two different tiles meet.
    found = cut_lineage(meet.groupBy("label", "dim", "lo", "hi").applyInArrow(
        tile_pair(threshold), "rep long, links long, root long"), "vector-links")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    state = groups.select("label", "key", "least", "copies", "rep").join(links, "rep", "left") \
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    smallest = state.groupBy("component").agg(F.min("least").alias("component_id"))
    state = state.join(smallest, "component").select(
        "label", "key", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = src.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    linked = src.where("key is not null").join(state, ["label", "key"]).select(
        "vec_id", "n_links", "component_id")
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
