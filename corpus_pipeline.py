"""Training-data pipeline over ``documents``, in five stages:

1. quality classifier: documents it rejects go;
2. line dedup: repeated passages of two or more lines, of some length or a
   whole document, are cut out of the texts; documents of which nothing is
   left go;
3. n-gram Jaccard join: of each group of near duplicates (five words, 80 %)
   the document with the smallest id stays;
4. benchmark decontamination: documents that hold a window of a benchmark
   item go;
5. packing into sequences of at most 4096 tokens.

Every stage takes (spark, docs, sf_dir), works on all rows the one before
kept and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's result to the shared folder and
reads it back, so a lost executor costs no finished stage.

Null and empty texts are scored like other texts; if they stay they pass
the other stages (no lines to repeat, an empty shingle set, no words) and
are packed as an end token.  Very long texts are handled whole by
every stage.  Other columns stay as they are up to stage 4, whatever their
names.  Repeated rows (equal id and text) are one document from stage 3 on.  Of a group of near duplicates the row with the
smallest id stays, then the one with the smallest text hash; rows without an
id come last.  SQL can express neither the classifier nor the tokenizer,
so there is no oracle; tests compare the stages with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.decontaminate import flag_contaminated
from starloom.llm.jaccard import near_duplicates
from starloom.llm.lines import dedup_lines
from starloom.llm.packing import pack_documents
from starloom.llm.quality import score, train
from starloom.llm.queries import table, word_bpe
from starloom.llm.ship import ship
from starloom.session import cut_lineage, ensure_checkpoint_dir

# Near duplicates share 80 % of their five-word shingles.
SHINGLE, PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(ship(spark))
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where("score >= 0.5").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(ship(spark))
    cut = dedup_lines(docs).where("n_lines = 0 or n_removed < n_lines")
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    # A text that lost nothing keeps its columns as they were.
    return cut.select(*[F.when(F.col("n_removed") > 0, new[c]).otherwise(F.col(f"row.{c}")).alias(c)
                        if c in new else F.col(f"row.{c}").alias(c) for c in docs.columns])


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(ship(spark))
    groups = near_duplicates(docs, size=SHINGLE, percent=PERCENT, with_rows=True).select("doc_id", "at", "component")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    stays = groups.where("component is not null").groupBy("component").agg(F.min(place).alias("p")).select("p.*") \
        .unionByName(groups.where("component is null").select(place.alias("p")).distinct().select("p.*")) \
        .select(F.col("none").alias("k_none"), F.coalesce("doc_id", F.lit(0)).alias("k_id"), F.col("at").alias("k_at"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").isNull().alias("k_none"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k_id"), F.xxhash64("text").alias("k_at"))
    keys = ["k_none", "k_id", "k_at"]
    return keyed.join(stays, keys, "left_semi").dropDuplicates(keys).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(ship(spark))
    flagged = flag_contaminated(docs, table(spark, sf_dir, "benchmark"))
    return flagged.where(~F.col("contaminated")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(ship(spark))
    return pack_documents(docs, word_bpe(), end_id=2).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicate_groups),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the result is the packed pieces."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
