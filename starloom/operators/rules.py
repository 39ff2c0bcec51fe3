"""Declared rules per row (O-70, O-71, O-73): all rules of a table in one
projection, an array of the broken ones per row.

A row that breaks a rule is set apart with the names of its rules; the
others go on.  The gates of ``operators.load`` stay behind this as a last
check of what is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.contracts import CONTRACTS, VARCHAR_LIMITS

BROKEN = "_broken"


def contract_rules(table: str, df: DataFrame) -> dict[str, Column]:
    """Per declared rule of a table the condition of a row that breaks it: NOT NULL
    columns holding NULL, VARCHAR columns holding longer text and values that
    their declared type cannot hold.  ``df``: rows before the cast to the contract."""
    rules = {}
    for f in CONTRACTS[table].fields:
        given = F.col(f.name) if f.name in df.columns else F.lit(None)
        fits = given.try_cast(f.dataType)
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            rules[f"{f.name} fits {f.dataType.simpleString()}"] = given.isNotNull() & fits.isNull()
        if not f.nullable:
            rules[f"{f.name} not null"] = fits.isNull()
    return rules | length_rules(VARCHAR_LIMITS.get(table, {}))


def length_rules(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"{c} varchar({n})": F.length(F.col(c)) > n for c, n in limits.items()}


def narrowest(tables: Sequence[str]) -> dict[str, int]:
    """The smallest VARCHAR limit that a column has in any of the tables."""
    out: dict[str, int] = {}
    for t in tables:
        for c, n in VARCHAR_LIMITS.get(t, {}).items():
            out[c] = min(n, out.get(c, n))
    return out


def column_rules(not_null: Sequence[str] = (), max_length: Mapping[str, int] | None = None,
                 precision: Mapping[str, tuple[int, int]] | None = None) -> dict[str, Column]:
    """Rules of any table, in the order given."""
    rules = {f"{c} not null": F.col(c).isNull() for c in not_null} | length_rules(max_length or {})
    for c, (p, s) in (precision or {}).items():
        rules[f"{c} fits decimal({p},{s})"] = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
    return rules


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that a row breaks, in their order (none: empty)."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])) if rules \
        else F.array().cast("array<string>")


def split_rows(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, the others with ``_broken``)."""
    marked = df.withColumn(BROKEN, broken_rules(rules))
    return marked.where(F.size(BROKEN) == 0).drop(BROKEN), marked.where(F.size(BROKEN) > 0)
