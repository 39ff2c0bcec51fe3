"""Interaction audit of document filters by relations of failing ids.

Which filters a document fails is stored as one id table per filter.  A
filter order only matters through the set of filters applied before each
step (the prefix), so all orders are answered from the relations of all
prefix sets:

* survivors of a prefix = survivors of the prefix without its last filter,
  left-anti its id table;
* removed by filter f after prefix P = id table of f, left-semi survivors
  of P; redundant = id table of f, left-anti survivors of P; label losses
  are counts over the removed.

The relations are kept as rows (prefix, id) and extended by one filter a
level, so four levels of one anti, one semi and one anti join answer the 32
prefixes of five filters.  Documents that pass every filter survive every
prefix: they are counted, not joined.  Only ids are shuffled after the one
scan of the texts.

A document is a row.  Its key is (doc_id, hash of the row's other inputs);
rows equal in all of these are one key with a count, so repeated ids are
audited apart and repeated rows count each.

Edge cases: a null text is empty (no words: under the least number, no
other failure); null languages are the part ''; a null id is neither
smaller than another nor has it smaller ones, and has no labels; a document
counts as labelled if any row of ``labels`` with its id says 1; an empty
table has no parts and gives no rows; very long texts are read as wholes;
extra columns are ignored, whatever their names.  Copies of one text may be
a third of all documents: the earliest of each repeated text meets its
copies on (digest, salt).
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_lineage

LEAST_WORDS = 200
SALTS = 16
KEY = ["doc", "at"]
COUNTS = ["removed", "redundant", "good_lost", "toxic_lost"]


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions A to D; ``text`` is not null."""
    words = F.transform(F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))),
                        lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("kinds")))[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"words": words, "C": 100 * capitals > 3 * F.length(text), "D": text.rlike("[#$%&*|]")}


def document_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      part_col: str = "lang") -> DataFrame:
    """``doc, at, part, n, A, B, C, D, E``: per key the number of its rows and
    the filters it fails (doc is null where the id is)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text, part).alias("at"), part.alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"),
                       *[c.alias(n) for n, c in text_filters(text).items()])
    read = read.select("doc", "at", "part", "digest", (F.col("words.n") < LEAST_WORDS).alias("A"),
                       (100 * F.col("words.kinds") < 50 * F.col("words.n")).alias("B"), "C", "D")
    read = cut_lineage(read.groupBy(*read.columns).agg(F.count("*").alias("n")), "audit-read")
    # Copies: the smallest id of every text that several keys have.
    first = read.groupBy("digest").agg(F.min("doc").alias("least"), F.max("doc").alias("most")) \
        .where("least < most").select(F.col("digest").alias("copied"), "least",
                                      F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    salted = read.withColumn("row_salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    return salted.join(first, (F.col("digest") == F.col("copied")) & (F.col("row_salt") == F.col("salt")), "left") \
        .select("doc", "at", "part", "n", "A", "B", "C", "D", F.coalesce(F.col("doc") > F.col("least"), F.lit(False)).alias("E"))


def with_labels(failures: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``good`` (a label quality = 1) and ``toxic`` (toxic = 1) and gives null ids a key."""
    marks = labels.groupBy(F.col(id_col).cast("long").alias("of")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = failures.join(marks, F.col("doc") == F.col("of"), "left")
    return joined.select(F.coalesce("doc", F.lit(0)).alias("doc"),
                         F.when(F.col("doc").isNull(), F.xxhash64("at")).otherwise(F.col("at")).alias("at"), "part", "n",
                         *[c for c in failures.columns if c not in (*KEY, "part", "n")],
                         F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def failing_ids(marked: DataFrame, names: list[str]) -> DataFrame:
    """The id tables of all filters: ``filter`` (its number), key, part and what its losses count."""
    each = [F.when(F.col(c), F.lit(i)) for i, c in enumerate(names)]
    return cut_lineage(marked.select(
        F.explode(F.array_compact(F.array(*each))).alias("filter"), *KEY, "part", "n",
        (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic")), "audit-failing")


def prefix_losses(fails: DataFrame, filters: int) -> DataFrame:
    """``part, prefix, filter, removed, redundant, good_lost, toxic_lost``: what each
    filter does after each prefix (a bit set of filters), where it does anything."""
    sums = {"n": "removed", "good": "good_lost", "toxic": "toxic_lost"}
    zero = F.lit(0).cast("long")
    out = fails.groupBy("part", F.lit(0).alias("prefix"), "filter").agg(
        *[F.sum(c).alias(a) for c, a in sums.items()], zero.alias("redundant"))
    alive = fails.select(F.lit(0).alias("prefix"), *KEY).distinct()
    for level in range(1, filters):
        # Each prefix set is reached once, by adding its filters in ascending order.
        longer = F.expr(f"explode(filter(sequence(0, {filters - 1}), f -> shiftright(prefix, f) = 0))")
        grown = alive.select("prefix", *KEY, longer.alias("filter")).join(fails, ["filter", *KEY], "left_anti")
        alive = cut_lineage(grown.select(F.expr("prefix + shiftleft(1, filter)").alias("prefix"), *KEY),
                            f"audit-survivors-{level}")
        sets = [p for p in range(1 << filters) if p.bit_count() == level]
        before = F.expr(f"filter(array({', '.join(map(str, sets))}), p -> p & shiftleft(1, filter) = 0)")
        asked = fails.withColumn("prefix", F.explode(before))
        removed = asked.join(alive, ["prefix", *KEY], "left_semi").groupBy("part", "prefix", "filter").agg(
            *[F.sum(c).alias(a) for c, a in sums.items()], zero.alias("redundant"))
        redundant = asked.join(alive, ["prefix", *KEY], "left_anti").groupBy("part", "prefix", "filter").agg(
            *[zero.alias(a) for a in sums.values()], F.sum("n").alias("redundant"))
        out = out.unionByName(removed).unionByName(redundant)
    return out.groupBy("part", "prefix", "filter").agg(*[F.sum(c).alias(c) for c in COUNTS])


def orders_of(spark, names: list[str]) -> DataFrame:
    """``filter_order, step, filter, prefix`` of every order of the filters."""
    rows = []
    for order in permutations(range(len(names))):
        word = "".join(names[f] for f in order)
        rows += [(word, k + 1, f, sum(1 << g for g in order[:k])) for k, f in enumerate(order)]
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, prefix int")


def audit(marked: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, filter order and step: ``part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``marked``: doc, at (not null), part, n, good, toxic and a boolean per
    filter, named by one letter each."""
    spark, filters = marked.sparkSession, len(names)
    marked = cut_lineage(marked, "audit-marked")
    cells = [(p, f) for f in range(filters) for p in range(1 << filters) if not p >> f & 1]
    parts = marked.groupBy("part").agg(F.sum("n").alias("docs"))
    losses = cut_lineage(prefix_losses(failing_ids(marked, names), filters), "audit-losses")
    every = F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(f).alias("filter")) for p, f in cells])
    table = parts.select("part", "docs", F.explode(every).alias("c")).select("part", "docs", "c.*") \
        .join(losses, ["part", "prefix", "filter"], "left").na.fill(0, COUNTS)
    alone = table.where(F.col("prefix") == F.expr(f"{(1 << filters) - 1} - shiftleft(1, filter)")) \
        .select("part", "filter", F.col("removed").alias("unique_fails"))
    steps = table.join(F.broadcast(orders_of(spark, names)), ["prefix", "filter"])  # one row per order and step
    shares = steps.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    gone = steps.groupBy("part", "filter_order").agg(F.collect_list(F.struct("step", "removed")).alias("gone"))  # one per filter
    so_far = F.expr("aggregate(filter(gone, g -> g.step <= step), 0L, (s, g) -> s + g.removed)")
    return steps.join(alone, ["part", "filter"]).join(shares, ["part", "filter"]).join(gone, ["part", "filter_order"]) \
        .select("part", "filter_order", "step", (F.col("docs") - so_far).alias("kept"), "removed", "redundant",
                "unique_fails", "good_lost", "toxic_lost", "shapley")
