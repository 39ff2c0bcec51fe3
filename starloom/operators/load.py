"""Loading tables: keyed upsert into versioned Parquet tables with
insert/update counters, partition-scoped rewrites and one switch per step
(O-11, O-16, O-17, O-18, O-20, O-37).

* ``stage_upsert`` merges a source into a (possibly absent) table.  Only
  the partitions the batch touches are read and rewritten: the dates of
  the source plus the dates of target rows whose key occurs in the source
  (a key may move to another date; where the date is part of the key it
  cannot, and the target is not searched).
* ``stage_replacement`` rewrites whole partitions, for tables derived from
  others: the rows of a touched date are computed anew, so what their
  sources lost or moved goes as well.
* The source is evaluated once: the counters and the contract gate
  (NOT NULL, VARCHAR, values that do not fit their type) are observed while
  it is written.  Nothing is visible before ``Tables.publish``.
* ``load_star`` stages all seven tables, checks uniqueness and foreign
  keys, and only then publishes all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.contracts import CONTRACTS, PRIMARY_KEYS, cast_to_contract
from starloom.operators.rules import contract_rules
from starloom.operators.upsert import ACTION, INSERT, dedupe_last, merge_upsert
from starloom.operators.versions import Tables, part_text
from starloom.session import cut_lineage

ROWS = "_rows"


@dataclass
class LoadResult:
    table: str
    processed: int
    inserted: int
    updated: int
    skipped: bool = False
    deleted: int = 0
    dropped: int = 0  # source rows that the table does not take
    touched: list = field(default_factory=list)

    @property
    def avoided(self) -> int:
        return self.processed - self.inserted


def at_once(*steps: Callable) -> list:
    """Results of independent steps, whose jobs share the cluster (one thread
    each, so that no step leaves cores idle at its end)."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return [j.result() for j in [pool.submit(s) for s in steps]]


class IntegrityError(RuntimeError):
    pass


class Gate:
    """The rules of a contract, observed on a source while it is first written.

    Only whether a rule is broken matters: a stage that runs again may count a
    row twice."""

    def __init__(self, contract: str | None):
        self.contract, self.seen, self.rules = contract, Observation(), []

    def watch(self, source: DataFrame) -> DataFrame:
        """The source, cast to its contract; other columns stay."""
        if not self.contract:
            return source
        rules = contract_rules(self.contract, source)
        self.rules = list(rules)
        seen = source.observe(self.seen, *[F.count(F.when(c, 1)).alias(f"r{i}") for i, c in enumerate(rules.values())])
        schema = CONTRACTS[self.contract]
        return cast_to_contract(seen, schema, keep=[c for c in source.columns if c not in schema.names])

    def check(self) -> None:
        """After the write of at least one row: raises if a rule was broken."""
        if self.rules:
            got = self.seen.get
            broken = [(self.contract, rule) for i, rule in enumerate(self.rules) if got[f"r{i}"]]
            if broken:
                raise IntegrityError(f"contract violations: {broken}")


def check_repeats(name: str, most: int) -> None:
    if most > 1:
        raise IntegrityError(f"keys that occur more than once: {name}")


def most_repeats(rows: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the most frequent key; a key with a NULL part is like no other."""
    return rows.select(*keys).dropna().groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def _moved_from(target: DataFrame, source: DataFrame, keys: Sequence[str], part: str) -> list:
    """Partitions of target rows whose key occurs in the source: one value per
    partition (bounded by the calendar), to become a choice of folders."""
    return [r[0] for r in target.select(*keys, part).join(source.select(*keys).distinct(), list(keys), "left_semi")
            .select(part).distinct().collect()]


def stage_upsert(tables: Tables, name: str, source: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] | None = None, partition_col: str | None = None,
                 keep_from_target: Sequence[str] = (), newer_only: bool = False,
                 contract: str | None = None, unique: bool = False) -> LoadResult:
    """Merge ``source`` into the table and stage the result.  An empty source
    is skipped (O-20).  ``newer_only`` (see ``merge_upsert``) keeps the
    ``order_by`` columns in the table; ``unique`` rejects a source that
    repeats a key.  The result names the partitions that were rewritten."""
    keys, order = list(keys), list(order_by or [])
    gate = Gate(contract)
    given = gate.watch(source)
    deduped = dedupe_last(given, keys, order, count_as=ROWS)
    cols = [c for c in given.columns if newer_only or c not in order]
    sizes = [F.sum(ROWS).alias("processed"), F.max(ROWS).alias("most")]
    if not tables.exists(name):
        # First load: every distinct key is an insert; no merge needed.
        seen = Observation()
        written = tables.write(name, deduped.select(*cols, ROWS), partition_col, keys, (seen, sizes), [ROWS])
        rows = tables.count(written)
        if not rows:
            return LoadResult(name, 0, 0, 0, skipped=True)
        gate.check()
        check_repeats(name, seen.get["most"] if unique else 0)
        tables.stage(name, written)
        return LoadResult(name, seen.get["processed"], rows, 0, touched=sorted(written) if partition_col else [])
    src = cut_lineage(deduped, f"source-{name}")
    n, (processed, most) = src.count(), src.agg(*sizes).first()
    if not n:
        return LoadResult(name, 0, 0, 0, skipped=True)
    gate.check()
    check_repeats(name, most if unique else 0)
    src = src.drop(ROWS)
    touched = None
    if partition_col:
        touched = {r[0] for r in src.select(partition_col).distinct().collect()}  # one per partition
        if partition_col not in keys:  # else a key cannot move between partitions
            touched |= set(_moved_from(tables.read(name), src, keys, partition_col))
    target = tables.read(name, touched).select(*cols)
    merged = merge_upsert(target, src, keys, order, keep_from_target, newer_only, deduped=True)
    seen = Observation()
    inserts = [F.count(F.when(F.col(ACTION) == INSERT, 1)).alias("inserted")]
    written = tables.write(name, merged, partition_col, keys, (seen, inserts), [ACTION])
    tables.stage(name, written, touched)
    # With newer_only an earlier row replaces nothing; it counts as an update of its key.
    inserted = seen.get["inserted"]
    return LoadResult(name, processed, inserted, n - inserted, touched=sorted(map(part_text, touched or [])))


def stage_replacement(tables: Tables, name: str, source: DataFrame, keys: Sequence[str], partition_col: str,
                      values: Sequence[str], contract: str | None = None) -> LoadResult:
    """Stage ``source``, one row per key, as the whole content of the partitions ``values``.

    The rows are written as they come; that no key repeats is checked on the
    written keys, so whole rows are neither sorted nor moved for it.  The
    counters compare its keys with those of the content replaced."""
    gate = Gate(contract)
    written = tables.write(name, gate.watch(source), partition_col, keys)
    values = sorted(map(part_text, values))
    if not set(written) <= set(values):
        raise IntegrityError(f"{name}: rows outside the partitions to replace: {sorted(set(written) - set(values))}")
    rows, updated, deleted = tables.count(written), 0, 0
    if rows:
        gate.check()
        check_repeats(name, most_repeats(tables.open(written), keys))
    old = sorted(tables.partitions(name) & set(values))
    if old:
        before = tables.read(name, old).select(*keys)
        if rows:
            updated = before.join(tables.open(written).select(*keys), list(keys), "left_semi").count()
        deleted = before.count() - updated
    tables.stage(name, written, values)
    return LoadResult(name, rows, rows - updated, updated, deleted=deleted, touched=values)


def stage_days(tables: Tables, name: str, rows: DataFrame, partition_col: str, days: Sequence[str],
               clustered: bool = False) -> None:
    """Full refresh (O-11): ``rows`` become the whole content of the partitions
    ``days``; a day without rows goes.  ``clustered``: see ``Tables.write``."""
    tables.stage(name, tables.write(name, rows, partition_col, clustered=clustered), days)


def upsert_table(spark: SparkSession, root: str, name: str, source: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] | None = None, partition_col: str | None = None,
                 keep_from_target: Sequence[str] = (), newer_only: bool = False,
                 contract: str | None = None) -> LoadResult:
    """Upsert one table below ``root`` and publish it."""
    tables = Tables(spark, root)
    result = stage_upsert(tables, name, source, keys, order_by, partition_col, keep_from_target, newer_only, contract)
    if not result.skipped:
        tables.publish()
    return result


def results_frame(spark: SparkSession, results: Sequence[tuple[int, LoadResult]]) -> DataFrame:
    """Counters as a small DataFrame (one row per table and run)."""
    rows = [(run, r.table, r.processed, r.inserted, r.updated, r.avoided) for run, r in results]
    return spark.createDataFrame(
        rows, "run int, table string, processed long, inserted long, updated long, avoided long")


FACT_FKS = {
    "fact_energy": [("date_id", "date_dim"), ("time_id", "time_dim"),
                    ("turbine_id", "turbine_dim"), ("status_id", "status_dim")],
    "fact_weather": [("date_id", "date_dim"), ("time_id", "time_dim"),
                     ("location_id", "location_dim")],
}


def contract_violations(tables: dict[str, DataFrame]) -> list[tuple[str, str, int]]:
    """(table, rule, rows) for every broken rule of the contracts, one aggregate
    per table in a single job; at most one row per rule.  Give it the rows
    before they are cast to the contract."""
    parts = None
    for name, df in tables.items():
        rules = contract_rules(name, df)
        if not rules:
            continue
        row = df.agg(*[F.count(F.when(c, 1)).alias(f"r{i}") for i, c in enumerate(rules.values())])
        cols = [F.struct(F.lit(r).alias("rule"), F.col(f"r{i}").alias("rows"))
                for i, r in enumerate(rules)]
        part = row.select(F.lit(name).alias("table_name"),
                          F.inline(F.array(*cols))).filter(F.col("rows") > 0)
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return []
    return [(r["table_name"], r["rule"], r["rows"]) for r in parts.collect()]


def require_contract(tables: dict[str, DataFrame]) -> None:
    broken = contract_violations(tables)
    if broken:
        raise IntegrityError(f"contract violations: {broken}")


def require_unique(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Raise if a key occurs twice in one of the tables (one job; at most one
    row per table comes back)."""
    repeated = None
    for name, (df, keys) in tables.items():
        part = (df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(name).alias("table_name"), "n"))
        repeated = part if repeated is None else repeated.unionByName(part)
    broken = [(r[0], r[1]) for r in repeated.where("n > 0").collect()]
    if broken:
        raise IntegrityError(f"keys that occur more than once: {sorted(broken)}")


def require_foreign_keys(facts: dict[str, DataFrame], dims: dict[str, DataFrame]) -> None:
    """Raise if a fact refers to a key its dimension lacks.  One pass per
    fact: all its keys are reduced to distinct (rule, value) pairs, which
    meet the dimensions' in one anti join."""
    used = known = None
    for fact, fks in FACT_FKS.items():
        pairs = facts[fact].select(F.inline(F.array(*[
            F.struct(F.lit(f"{fact}.{c}").alias("fk"), F.col(c).cast("string").alias("k"))
            for c, _ in fks]))).where("k is not null").distinct()
        used = pairs if used is None else used.unionByName(pairs)
        for c, dim in fks:
            ids = dims[dim].select(F.lit(f"{fact}.{c}").alias("fk"),
                                   F.col(PRIMARY_KEYS[dim][0]).cast("string").alias("k"))
            known = ids if known is None else known.unionByName(ids)
    broken = [r[0] for r in used.join(known, ["fk", "k"], "left_anti").select("fk").distinct().collect()]
    if broken:
        raise IntegrityError(f"foreign keys without a dimension row: {sorted(broken)}")


def stage_star(tables: Tables, dims: dict[str, DataFrame], facts: dict[str, DataFrame],
               dates: Sequence[str] | None = None) -> list[LoadResult]:
    """Stage dimensions and facts and check the foreign keys of what was staged.

    Dimensions are merged: rows that no fact names any more stay, as in the
    reference.  Facts are merged by their key, or, given ``dates``, are the
    whole content of those dates.  They are partitioned by date, so other days
    are not read.  ``facts`` come from ``build_facts(..., for_load=True)``: the
    weather fact holds one row per id.

    Independent jobs are submitted from parallel threads and share the
    cluster.  The contract (O-54, O-71, O-73) and the uniqueness of the
    dimension ids (O-70) are checked on the rows as they are written, the
    foreign keys (O-72) on the staged files, i.e. the future content."""
    def dim(n: str) -> LoadResult:
        return stage_upsert(tables, n, dims[n], PRIMARY_KEYS[n], contract=n, unique=True)

    def fact(n: str) -> LoadResult:
        if dates is None:
            return stage_upsert(tables, n, facts[n], PRIMARY_KEYS[n], partition_col="date_id", contract=n)
        return stage_replacement(tables, n, facts[n], PRIMARY_KEYS[n], "date_id", dates, contract=n)

    results = at_once(*[partial(dim, n) for n in dims], *[partial(fact, n) for n in facts])
    seen = {r.table: r for r in results if tables.exists(r.table)}
    if set(FACT_FKS) <= set(seen):
        require_foreign_keys({n: tables.read(n, seen[n].touched) for n in FACT_FKS},
                             {n: tables.read(n) for n in dims})
    return results


def load_star(spark: SparkSession, root: str, dims: dict[str, DataFrame],
              facts: dict[str, DataFrame]) -> list[LoadResult]:
    """Stage dimensions and facts and publish all of them in one step (O-16, O-17)."""
    tables = Tables(spark, root)
    results = stage_star(tables, dims, facts)
    tables.publish()
    return results
