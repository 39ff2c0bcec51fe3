"""Keyed upsert ("INSERT ... ON CONFLICT DO UPDATE") as DataFrame
operations (O-12..O-15, O-18..O-21).

``merge_upsert(target, source, keys)`` returns the merged table with a
``merge_action`` column (insert / update / keep):

1. The source is reduced to one row per key ("last wins" under an explicit
   order) with a partial aggregate, so a key holding a third of the batch
   is combined map-side rather than gathered into one task.  Rows with a
   NULL key component are never deduplicated: like SQL UNIQUE, a NULL
   key conflicts with nothing and is inserted every time.
2. One full outer join of target and source on the keys yields the merged
   rows and the action of each, so the counters come from the same pass
   (``df.observe`` or one ``groupBy(_merge_action)``).

Columns listed in ``keep_from_target`` (generated surrogate ids) keep the
target's value on update; new rows take the source's value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "merge_action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"


def _all_keys_present(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def dedupe_last(source: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                count_as: str | None = None) -> DataFrame:
    """One row per non-NULL key, the greatest by (order_by..., rest...);
    rows with a NULL key component pass through untouched.  One grouped
    pass: a row without a key gets a number of its own to be grouped by.
    ``count_as`` adds how many source rows each row stands for."""
    keys = list(keys)
    order = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in source.columns if c not in keys and c not in order]
    payload = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [F.col(c) for c in rest]
    own = F.when(_all_keys_present(keys), F.lit(-1)).otherwise(F.monotonically_increasing_id())
    agg = source.withColumn("_own", own).groupBy(*keys, "_own").agg(
        F.max(F.struct(*(payload or [F.lit(0)]))).alias("_w"), F.count(F.lit(1)).alias("_n"))
    deduped = agg.select(*keys, *[F.col(f"_w._o{i}").alias(c) for i, c in enumerate(order)],
                         *[F.col(f"_w.{c}") for c in rest], "_n")
    return deduped.select(*source.columns, *([F.col("_n").alias(count_as)] if count_as else []))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] | None = None, keep_from_target: Sequence[str] = (),
                 newer_only: bool = False, deduped: bool = False) -> DataFrame:
    """Merged table (target columns, in target order) + ``merge_action``.

    ``order_by`` columns may be source-only (a revision number, a load
    timestamp); they decide "last wins" and are then dropped.  With
    ``newer_only`` they are columns of the target as well, and a source row
    replaces a target row only if it does not come before it in that order
    (then by row value), so the result does not depend on how rows are dealt
    out to batches.  ``deduped``: the source already has one row per key."""
    keys = list(keys)
    cols = target.columns
    order = [c for c in (order_by or []) if c in source.columns]
    shared = [c for c in cols if c in source.columns]
    src = source.select(*shared, *[c for c in order if c not in shared])
    if not deduped:
        src = dedupe_last(src, keys, order)
    src = src.select(*shared)

    # Rows with a NULL key never match; they are spread by their content so
    # that they do not all meet in one task of the join.
    def spread(df: DataFrame) -> Column:
        return F.when(~_all_keys_present(keys), F.xxhash64(*df.columns))

    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"),
                      F.coalesce(spread(target), F.lit(0)).alias("_t_spread"))
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in src.columns], F.lit(True).alias("_in_s"),
                   F.coalesce(spread(src), F.lit(0)).alias("_s_spread"))
    cond = F.col("_t_spread") == F.col("_s_spread")
    for k in keys:
        cond = cond & (F.col(f"_t_{k}") == F.col(f"_s_{k}"))
    j = t.join(s, cond, "full_outer")
    in_s = F.col("_in_s").isNotNull()
    in_t = F.col("_in_t").isNotNull()
    if newer_only:
        rank = [*order, *[c for c in shared if c not in keys and c not in order]]
        in_s = in_s & (~in_t | (F.struct(*[F.col(f"_s_{c}").alias(c) for c in rank])
                                >= F.struct(*[F.col(f"_t_{c}").alias(c) for c in rank])))
    out = []
    for c in cols:
        tc = F.col(f"_t_{c}")
        if c not in src.columns:
            out.append(tc.alias(c))
        elif c in keep_from_target:
            out.append(F.when(in_t, tc).otherwise(F.col(f"_s_{c}")).alias(c))
        else:
            out.append(F.when(in_s, F.col(f"_s_{c}")).otherwise(tc).alias(c))
    action = F.when(in_s & in_t, UPDATE).when(in_s, INSERT).otherwise(KEEP).alias(ACTION)
    return j.select(*out, action)


def upsert_metrics(source: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: processed (source rows), inserted, updated, avoided
    (= processed - inserted; repeats inside one batch count as avoided),
    total_after (O-18).  One global aggregate over both inputs, no join."""
    side = "_side"
    s = source.select(F.lit("source").alias(side), F.lit(None).cast("string").alias(ACTION))
    m = merged.select(F.lit("merged").alias(side), F.col(ACTION))
    u = s.unionByName(m)
    return u.groupBy().agg(
        F.count(F.when(F.col(side) == "source", 1)).alias("processed"),
        F.count(F.when(F.col(ACTION) == INSERT, 1)).alias("inserted"),
        F.count(F.when(F.col(ACTION) == UPDATE, 1)).alias("updated"),
        F.count(F.when(F.col(side) == "merged", 1)).alias("total_after"),
    ).select("processed", "inserted", "updated",
             (F.col("processed") - F.col("inserted")).alias("avoided"), "total_after")


def merge_actions(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-row insert/update flag of the source rows (O-19)."""
    return merged.filter(F.col(ACTION) != KEEP).select(*keys, ACTION)
