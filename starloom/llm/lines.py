"""Removal of repeated passages of lines, as content-defined chunks.

A rolling hash runs over the hashes of a text's lines, two lines wide.  A
chunk goes on over the gap between two lines where the rolling hash there
occurs elsewhere in the corpus at an earlier place, and ends where it does
not: a boundary depends on the two lines beside it only, so an inserted or
deleted line moves no boundary but its own.  Chunks of two or more lines
are thus the longest passages made of lines that earlier places have in
the same succession; they are removed, if they hold at least ``LEAST_CHARS``
non-blank characters (blank lines, closing braces and short headings stay)
or are a whole document.  The first place (smallest id, then line) stays.

Boundaries that the hashes of one text alone choose (say local minima) are
not used: a passage of two lines has a single gap, so it is found only if
that gap is looked up, whatever its hash.

*Byte comparison.*  Places whose rolling hash occurs more than once send
their two lines; equal lines are combined before they travel.  A hash with
one pair of lines only is thereby compared; for a hash that different pairs
share, the first place is found anew per pair of lines.

All of it is DataFrame and SQL functions.  Hashes of all gaps and, once,
the texts are shuffled; the lines of repeated gaps are shuffled combined.

Edge cases: a null text stays null and has no lines; an empty text is one
empty line; texts of one line have no gap and stay; a place that overlaps
its first place (a line three times in a row) is not a repeat of it; rows
with equal id and text are one document (each row gets the same result,
none removes the other's lines); null ids come after all others, by the
hash of their text; very long texts are handled as wholes, a line each; an
empty table gives no rows; other columns travel in ``row`` and may have any
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import cut_lineage

LEAST_CHARS = 40
LAST_ID = 2**63 - 1
KEY = ["rank", "at"]


def gaps(text: str) -> Column:
    """Array of (no, hash) of a text column: the rolling hash between line ``no`` and the next."""
    return F.expr(rf"""transform(array(transform(split({text}, '\n'), x -> xxhash64(x))), h ->
        transform(slice(h, 2, size(h)), (x, i) -> named_struct('no', i, 'hash', xxhash64(get(h, i), x))))[0]""")


def place() -> Column:
    return F.struct(*KEY, "no")


def is_later(first: str) -> Column:
    """Does this row's place follow the place ``first`` without overlapping it?"""
    overlaps = (F.col("rank") == F.col(f"{first}.rank")) & (F.col("at") == F.col(f"{first}.at")) \
        & (F.col("no") < F.col(f"{first}.no") + 2)
    return (place() > F.col(first)) & ~overlaps


def repeated_gaps(src: DataFrame, text_col: str) -> DataFrame:
    """``rank, at, no`` of the gaps whose two lines occur at an earlier place,
    each once.  ``src``: rank, at, row."""
    each = src.select(*KEY, F.col(f"row.`{text_col}`").alias("text")).where("text is not null") \
        .select(*KEY, F.explode(gaps("text")).alias("g")).select(*KEY, "g.*")
    first = each.groupBy("hash").agg(F.count("*").alias("n"), F.min(place()).alias("first")) \
        .where("n > 1").select("hash", "first")
    shared = cut_lineage(each.join(first, "hash").select("hash", *KEY, "no", is_later("first").alias("later")).distinct(),
                         "shared-gaps")

    def lines_of(gaps: DataFrame) -> DataFrame:
        """``rank, at, no, hash, body``: the gaps with their two lines."""
        asked = gaps.groupBy(*KEY).agg(F.collect_list(F.struct("no", "hash")).alias("asked"))
        # The whole row is named, so every reader of the texts shares one exchange.
        body = F.expr(rf"""transform(array(row), r -> transform(array(split(r.`{text_col}`, '\n')), l ->
            transform(asked, x -> named_struct('no', x.no, 'hash', x.hash,
                      'body', concat(get(l, x.no), '\n', get(l, x.no + 1))))))[0][0]""")
        return src.join(asked, KEY).select(*KEY, F.explode(body).alias("b")).select(*KEY, "b.*")

    # Byte comparison: distinct lines of every shared hash.
    bodies = lines_of(shared).groupBy("hash", "body").agg(F.count("*").alias("n"))
    mixed = bodies.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    found = shared.where("later").join(mixed, "hash", "left_anti").select(*KEY, "no")
    # Different lines with one hash: the first place of each pair of lines.
    apart = lines_of(shared.join(mixed, "hash", "left_semi"))
    own = apart.groupBy("hash", "body").agg(F.min(place()).alias("first"))
    return found.unionByName(apart.join(own, ["hash", "body"]).where(is_later("first")).select(*KEY, "no"))


def passages(found: DataFrame) -> DataFrame:
    """``rank, at, chunks``: per document the first and last line of its chunks, in order."""
    inside = Window.partitionBy(*KEY).orderBy("no")  # one document's gaps
    ends = F.coalesce(F.col("no") > F.lag("no").over(inside) + 1, F.lit(True))
    return found.withColumn("chunk", F.sum(ends.cast("int")).over(inside)) \
        .groupBy(*KEY, "chunk").agg(F.min("no").alias("lo"), (F.max("no") + 1).alias("hi")) \
        .groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("chunks"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_chars: int = LEAST_CHARS) -> DataFrame:
    """``row`` (all columns of the document), ``n_lines``, ``n_removed``
    (lines) and ``kept`` (the text without repeated passages)."""
    src = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("rank"),
                      F.xxhash64(F.col(text_col), F.col(id_col).isNull()).alias("at"))
    chunks = passages(repeated_gaps(src, text_col))
    both = src.join(chunks, KEY, "left").withColumn("l", F.split(F.col(f"row.`{text_col}`"), "\n"))
    of_size = F.expr(rf"""filter(chunks, c -> c.lo = 0 and c.hi = size(l) - 1 or length(regexp_replace(
        array_join(slice(l, c.lo + 1, c.hi - c.lo + 1), ''), '[\\x20\\x09-\\x0D]+', '')) >= {int(least_chars)})""")
    stay = F.expr("""flatten(transform(sequence(0, size(gone)), k -> slice(l,
        coalesce(get(gone, k - 1).hi + 2, 1),
        coalesce(get(gone, k).lo, size(l)) - coalesce(get(gone, k - 1).hi + 1, 0))))""")
    cut = both.withColumn("gone", of_size).withColumn("stays", F.when(F.size("gone") > 0, stay))
    return cut.select("row", F.coalesce(F.array_size("l"), F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.array_size("l") - F.array_size("stays"), F.lit(0)).cast("long").alias("n_removed"),
                      F.when(F.col("stays").isNull(), F.col(f"row.`{text_col}`")).otherwise(F.array_join("stays", "\n")).alias("kept"))
