"""Integrity checks: database constraints re-aimed as Spark jobs
(O-29, O-30, O-70..O-74).

Each check returns a DataFrame of violations (or a summary row per rule);
an empty result means the constraint holds.  All of them are aggregate
first: foreign keys are reduced to distinct values with counts before
the anti join, so the join sees one row per key value, not the fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their multiplicity (O-70)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
              .filter(F.col("rows") > 1))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: how many rows are NULL in it (O-71), from a
    single aggregate pass."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return agg.unpivot([], cols, "column_name", "null_rows")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return null_counts(df, cols).filter(F.col("null_rows") > 0)


def orphan_keys(fact: DataFrame, fk: Sequence[str], dim: DataFrame,
                pk: Sequence[str] | None = None) -> DataFrame:
    """Foreign-key values of ``fact`` with no match in ``dim`` and how
    many fact rows carry each (O-72).  NULL foreign keys are not orphans
    (as in SQL)."""
    fk = list(fk)
    pk = list(pk or fk)
    present = None
    for c in fk:
        present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
    counts = fact.filter(present).groupBy(*fk).agg(F.count(F.lit(1)).alias("rows"))
    keys = dim.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)]).distinct()
    return counts.join(keys, fk, "left_anti")


def fk_summary(rules: Mapping[str, tuple[DataFrame, Sequence[str], DataFrame, Sequence[str]]]
               ) -> DataFrame:
    """One row per named foreign key: orphan key values and orphan rows."""
    out = None
    for name, (fact, fk, dim, pk) in rules.items():
        o = orphan_keys(fact, fk, dim, pk).agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        o = o.select(F.lit(name).alias("foreign_key"), "orphan_keys", "orphan_rows")
        out = o if out is None else out.unionByName(o)
    return out


def limit_violations(df: DataFrame, max_length: Mapping[str, int] | None = None,
                     precision: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Per rule, how many values break a VARCHAR length or a NUMERIC(p, s)
    precision (values that do not fit become NULL under try_cast) (O-73)."""
    aggs, labels = [], []
    for c, n in (max_length or {}).items():
        aggs.append(F.count(F.when(F.length(F.col(c)) > n, 1)).alias(f"r{len(labels)}"))
        labels.append((c, f"varchar({n})"))
    for c, (p, s) in (precision or {}).items():
        bad = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
        aggs.append(F.count(F.when(bad, 1)).alias(f"r{len(labels)}"))
        labels.append((c, f"decimal({p},{s})"))
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                 F.col(f"r{i}").alias("violations")) for i, (c, rule) in enumerate(labels)])))


def date_gate(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Rows whose date lies in [lo, hi], both included (O-29).  The bounds
    are literals so the predicate reaches the Parquet scan."""
    c = F.col(col)
    return df.filter((c >= F.lit(lo).cast("date")) & (c < F.date_add(F.lit(hi).cast("date"), 1)))


def allowed_dates(lo: Column, hi: Column) -> Column:
    """Every date from lo to hi, both included, as an array (O-30)."""
    return F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))


def missing_dates(df: DataFrame, date_col: str) -> DataFrame:
    """Dates between the first and last date of ``df`` that have no row
    (O-30 used as a completeness check).  The calendar is generated from
    one min/max row; its size is bounded by the date span, not the data."""
    d = df.select(F.to_date(F.col(date_col)).alias("date"))
    span = d.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    cal = span.select(F.explode(allowed_dates(F.col("lo"), F.col("hi"))).alias("date"))
    return cal.join(d.distinct(), "date", "left_anti")


def grid_completeness(actual: DataFrame, expected: DataFrame, keys: Sequence[str],
                      group: Sequence[str]) -> DataFrame:
    """Per group: expected grid points, points present, points missing
    (expected LEFT ANTI actual) (O-74)."""
    keys = list(keys)
    have = actual.select(*keys).distinct().withColumn("_have", F.lit(1))
    j = expected.select(*keys).join(have, keys, "left")
    return j.groupBy(*group).agg(
        F.count(F.lit(1)).alias("expected"),
        F.count("_have").alias("present"),
        F.count(F.when(F.col("_have").isNull(), 1)).alias("missing"))
