"""Surrogate ids without collisions (O-21, O-66b).

An id is the hash of its natural key.  Where two natural keys have one hash,
the one that had the id first, else the smaller key, keeps it; the other is
hashed again with a number of the attempt until its id is free.  Ids once
given never change, so a table that stores natural keys with their ids is
its own registry.

Every attempt is one aggregate and two anti joins over the keys that have no
id yet; without collisions there is one attempt.  Ids that are new are
checked against all known ones, which are read as one column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import stable_key
from starloom.session import cut_lineage

KeyFn = Callable[..., Column]


def salted_key(*parts: str, attempt: int = 0) -> Column:
    """``stable_key`` at the first attempt; later ones add their number."""
    return stable_key(*parts, F.lit(f"#{attempt}")) if attempt else stable_key(*parts)


def assign_ids(keys: DataFrame, natural: Sequence[str], id_col: str, known: DataFrame | None = None,
               key_fn: KeyFn = salted_key) -> DataFrame:
    """``natural..., id`` of the distinct natural keys of ``keys``: the known id or a
    new one.  ``known``: natural..., id, each natural key and each id once."""
    natural = list(natural)
    spark = keys.sparkSession
    cond = [F.col(f"k.{c}").eqNullSafe(F.col(f"o.{c}")) for c in natural]
    mine = cut_lineage(keys.select(*natural).distinct(), "id-keys")
    if known is None:
        old, left = None, mine
    else:
        known = known.select(*natural, id_col)
        old = mine.alias("k").join(known.alias("o"), cond).select(*[F.col(f"k.{c}") for c in natural], f"o.{id_col}")
        left = mine.alias("k").join(known.alias("o"), cond, "left_anti")
    given, attempt = [], 0
    left = cut_lineage(left, "id-left")
    while not left.isEmpty():
        tried = left.withColumn(id_col, key_fn(*natural, attempt=attempt))
        first = tried.groupBy(id_col).agg(F.min(F.struct(*natural)).alias("n")).select("n.*", id_col)
        for taken in ([known] if known is not None else []) + given:
            first = first.join(taken.select(id_col), id_col, "left_anti")
        given.append(cut_lineage(first.select(*natural, id_col), "id-given"))
        won = given[-1].alias("o")
        left = cut_lineage(left.alias("k").join(won, cond, "left_anti"), "id-left")
        attempt += 1
    out = old
    for part in given:
        out = part if out is None else out.unionByName(part)
    return out if out is not None else mine.withColumn(id_col, F.lit(None).cast("long"))
