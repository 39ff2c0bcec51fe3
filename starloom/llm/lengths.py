"""Exact histogram of encoded lengths, and what its suffix sums answer.

Documents are encoded in one map that emits, per slice of texts, the
distinct lengths with their counts; Spark sums them.  From then on only
the histogram is handled: one row per distinct length, however many
documents there are.  Suffix sums over it give, for every context limit
L, the documents longer than L and the tokens kept when each document is
truncated to L.  They are computed in ranges of ``RANGE`` lengths, with
the totals of the ranges added, so no window spans the whole histogram.

Edge cases: null and empty texts have length 0; repeated rows count each;
a very long text is encoded whole, by itself; an empty table gives an empty
histogram; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.encode import encoder
from starloom.llm.words import slices
from starloom.session import cut_lineage

RANGE = 1024


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``n_tokens, n_docs``: how many documents have each encoded length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                _, off = enc.encode(part.column("text"))
                size, many = np.unique(np.diff(off), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(size, pa.int64()), pa.array(many, pa.int64())],
                                                 ["n_tokens", "n_docs"])
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n_tokens long, n_docs long")
    return counts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length L of the histogram: ``n_docs`` of that length,
    ``docs_longer`` (over L), ``docs_upto``, ``tokens_upto`` (of documents
    up to L), ``total_tokens`` and ``truncated_tokens`` (sum of min(length, L))."""
    histogram = cut_lineage(histogram, "length-histogram")  # documents are encoded once
    h = histogram.withColumn("part", F.floor(F.col("n_tokens") / RANGE))
    whole = h.groupBy("part").agg(F.sum("n_docs").alias("d"),
                                  F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    every = Window.orderBy("part")  # one row per RANGE lengths
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    after = every.rowsBetween(1, Window.unboundedFollowing)
    ranges = whole.select("part", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for c, w, n in
                                    (("d", before, "docs_before"), ("t", before, "tokens_before"),
                                     ("d", after, "docs_after"), ("t", after, "tokens_after"))],
                          F.col("t").alias("tokens_here"))
    inside = Window.partitionBy("part").orderBy("n_tokens")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = inside.rowsBetween(1, Window.unboundedFollowing)
    sums = h.join(ranges, "part").select(
        "n_tokens", "n_docs",
        (F.col("docs_before") + F.sum("n_docs").over(upto)).alias("docs_upto"),
        (F.col("tokens_before") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(upto)).alias("tokens_upto"),
        (F.col("docs_after") + F.coalesce(F.sum("n_docs").over(over), F.lit(0))).alias("docs_longer"),
        (F.col("tokens_before") + F.col("tokens_here") + F.col("tokens_after")).alias("total_tokens"))
    return sums.withColumn("truncated_tokens",
                           F.col("tokens_upto") + F.col("n_tokens") * F.col("docs_longer"))


def truncated_total(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``max_tokens, tokens, docs_cut`` for each context limit."""
    return histogram.select(F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("max_tokens"),
                            "n_tokens", "n_docs") \
        .groupBy(F.col("max_tokens").cast("long").alias("max_tokens")) \
        .agg(F.sum(F.least("n_tokens", "max_tokens") * F.col("n_docs")).alias("tokens"),
             F.sum(F.when(F.col("n_tokens") > F.col("max_tokens"), F.col("n_docs")).otherwise(0))
             .alias("docs_cut"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the least length that at least this share of
    documents does not exceed, from ``suffix_sums``."""
    each = sums.select(F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share"), "*")
    reached = F.col("docs_upto") >= F.col("share") * (F.col("docs_upto") + F.col("docs_longer"))
    return each.where(reached).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
