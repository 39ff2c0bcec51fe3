"""Registered queries of the llm operators: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.audit import audit, document_failures, with_labels
from starloom.llm.codes import codebooks_digest, vector_codes, with_label_errors
from starloom.llm.credentials import scan_credentials
from starloom.llm.decontaminate import decontaminate
from starloom.llm.jaccard import near_duplicates
from starloom.llm.lengths import length_histogram, suffix_sums
from starloom.llm.licenses import scan_licenses
from starloom.llm.lines import dedup_lines
from starloom.llm.packing import pack_documents
from starloom.llm.quality import held_out, score, train
from starloom.llm.sentencepieces import encode_documents
from starloom.llm.ship import ship
from starloom.llm.substrings import remove_repeated
from starloom.llm.vectors import near_vectors
from starloom.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return f(ship(spark), sf_dir)
        run.__doc__ = f.__doc__
        QUERIES[name] = run
        return f
    return register


def word_bpe() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def piece_bpe() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a model fitted on the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id").alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside every 50-word window that a document with a smaller id also has."""
    kept = remove_repeated(table(spark, sf_dir, "documents"), with_text=False)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_line_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that stay when repeated passages of lines go."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with weak parts where complementary parts co-occur."""
    return scan_credentials(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences whose whole text is a document or stands in it as a block or line."""
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op5_length_histogram")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact histogram of encoded lengths with the sums for every context limit."""
    return suffix_sums(length_histogram(table(spark, sf_dir, "documents"), word_bpe()))


@query("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a benchmark item."""
    hits = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op8_near_vectors")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with cosine >= 0.98: links, components and the one kept."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op9_pack")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), word_bpe(), end_id=2) \
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_sentencepieces")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, piece_bpe(), with_ids=False, with_text=False).select(
        F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


@query("op12_filter_audit")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, repeats and loses in every order, per language."""
    failures = document_failures(table(spark, sf_dir, "documents"))
    return audit(with_labels(failures, table(spark, sf_dir, "labels")), list("ABCDE"))


@query("op13_vector_codes")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, their errors and the digest of the codebooks."""
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error",
                                           F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
