"""Secret scan with multipart credential linking.

Base spans are those of three fixed patterns.  Besides them the scan finds
weak parts: identifiers, secret-like values and endpoints, which alone
would be mostly noise.  All parts of a text are joined by interval: two
parts meet when their starts are at most ``SCOPE`` code points apart (an
equi-join on the text and on cells of ``SCOPE`` code points).  A weak part
is reported only when its complements co-occur in its scope:

* an identifier: with a base secret, or with a secret-like value and an endpoint;
* a secret-like value: with an identifier (access key or weak);
* an endpoint: with an identifier and a secret.

Weak parts that overlap a base span, and values inside an identifier or
endpoint, are dropped.  One projection finds all patterns in a text; its
sizes of matches and of the pieces between them are written, and positions
are prefix sums over them, one row per match.  Texts are read once and never
shuffled.  Everything is DataFrame and SQL functions.

Edge cases: a null text is empty and has no spans; rows with equal id and
text get the same result each; null ids are ids like others; very long
texts are searched whole, and a text with very many parts has one row per
part, which meets the parts of its neighbouring cells only; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import cut_lineage

SCOPE = 400

# Base patterns (kind, pattern, group that must be long enough, its least length).
# A run of a class is maximal, so its least length may stand in the pattern itself.
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
WEAK = [
    ("identifier", r"""(?i)(access[_-]?key[_-]?id|client[_-]?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 2, 3),
    ("value", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}={0,2}", 0, 16),
    ("endpoint", r"""(?i)\b[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+""", 0, 1),
]
KINDS = [k for k, *_ in BASE + WEAK]
# What every match of a kind holds; texts without it need no search.
SIGNS = {"assign": [":", "="], "access": ["AKIA"], "identifier": [":", "="], "endpoint": ["://"]}
KEY = ["doc", "at"]


def matches() -> Column:
    """Array of (kind, size, gap before, size of the group that must be long
    enough) of the matches in ``text``, in order within each kind."""
    text, found = F.col("text"), []

    def of_kind(number: int, length):
        def row(m, own):
            return F.struct(F.lit(number).alias("kind"), m["size"].alias("size"), m["gap"].alias("gap"), own.alias("own"))
        return (lambda m, g: row(m, length(g))) if length else (lambda m: row(m, m["size"]))

    for number, (kind, pattern, group, _) in enumerate(BASE + WEAK):
        may = F.lit(kind not in SIGNS)
        for sign in SIGNS.get(kind, []):
            may = may | F.contains(text, F.lit(sign))
        if kind == "value":
            may = text.rlike("[0-9]")
        whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        sized = F.zip_with(whole, F.split(text, pattern), lambda m, gap: F.struct(
            F.length(m).alias("size"), F.length(gap).alias("gap")))
        if group:
            each = F.zip_with(sized, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), of_kind(number, F.length))
        else:
            each = F.transform(sized, of_kind(number, None))
        # The piece behind the last match has no match.
        found.append(F.when(may & text.rlike(pattern), F.filter(each, lambda m: m["size"].isNotNull())))
    none = F.array().cast("array<struct<kind:int,size:int,gap:int,own:int>>")
    return F.flatten(F.array(*[F.coalesce(f, none) for f in found]))


def places(found: DataFrame) -> DataFrame:
    """One row per match: key, kind, start, end (code points)."""
    one = found.select(*KEY, F.posexplode("m").alias("no", "x")).select(*KEY, "no", "x.*").distinct()
    upto = Window.partitionBy(*KEY, "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.element_at(F.array(*[F.lit(n) for *_, n in BASE + WEAK]), F.col("kind") + 1)
    return one.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).where(F.col("own") >= least) \
        .select(*KEY, "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts whose complements co-occur (same columns as ``parts``)."""
    cell = parts.withColumn("cell", F.floor(F.col("start") / scope))
    weak = cell.where(F.col("kind") >= len(BASE))
    near = cell.select(*[F.col(c).alias(f"o_{c}") for c in [*KEY, "kind", "start", "end"]],
                       F.explode(F.expr("sequence(cell - 1, cell + 1)")).alias("o_cell"))
    meet = weak.join(near, weak["doc"].eqNullSafe(near["o_doc"]) & (weak["at"] == near["o_at"])
                     & (weak["cell"] == near["o_cell"])
                     & (F.abs(weak["start"] - near["o_start"]) <= scope))
    kind = {k: i for i, k in enumerate(KINDS)}
    over = (F.col("o_start") < F.col("end")) & (F.col("start") < F.col("o_end"))
    apart = ~over

    def seen(*kinds: str):
        return F.max(F.when(apart & F.col("o_kind").isin([kind[k] for k in kinds]), True)).isNotNull()

    flags = meet.groupBy(*KEY, "kind", "start", "end").agg(
        F.max(F.when(over & (F.col("o_kind") < len(BASE)), True)).isNotNull().alias("inside_base"),
        F.max(F.when(over & F.col("o_kind").isin(kind["identifier"], kind["endpoint"]), True))
        .isNotNull().alias("inside_part"),
        seen("access", "identifier").alias("identifier"), seen("assign", "hex").alias("strong"),
        seen("value").alias("value"), seen("endpoint").alias("endpoint"))
    secret = F.col("strong") | F.col("value")
    says = F.when(F.col("kind") == kind["identifier"], F.col("strong") | (F.col("value") & F.col("endpoint"))) \
        .when(F.col("kind") == kind["value"], F.col("identifier") & ~F.col("inside_part")) \
        .otherwise(F.col("identifier") & secret)
    return flags.where(says & ~F.col("inside_base")).select(*KEY, "kind", "start", "end")


def scan_credentials(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     scope: int = SCOPE) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_linked`` (spans: kind:start:end, comma-joined)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("at", F.xxhash64("text"))
    # The one pass over the texts; only sizes go on.
    found = cut_lineage(src.select(*KEY, matches().alias("m")), "secret-matches")
    parts = cut_lineage(places(found), "secret-parts")
    spans = parts.where(F.col("kind") < len(BASE)).unionByName(linked(parts, scope))
    names = F.array(*[F.lit(k) for k in KINDS])
    by_text = spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s")) \
        .withColumn("names", names)
    say = "transform({}, x -> concat(names[x.kind], ':', x.start, ':', x.end))"
    lists = by_text.select(
        F.col("doc").alias("d"), F.col("at").alias("a"),
        *[F.expr(f"size(filter(s, x -> x.kind = {i}))").alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)],
        F.expr(f"size(filter(s, x -> x.kind >= {len(BASE)}))").alias("n_linked"),
        F.array_join(F.expr(say.format(f"filter(s, x -> x.kind < {len(BASE)})")), ",").alias("base"),
        F.array_join(F.expr(say.format("s")), ",").alias("spans"))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select(*KEY).join(
        lists, F.col("doc").eqNullSafe(F.col("d")) & (F.col("at") == F.col("a")), "left").select(
        F.col("doc").alias("doc_id"), count("n_assign"), count("n_access"), count("n_hex"),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), count("n_linked"))
