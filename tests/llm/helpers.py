"""Small documents with every edge case, and plain-Python twins of the operators."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEST_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Extra columns have the names that operators use inside.
DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("row", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("doc", T.StringType()), T.StructField("at", T.LongType()),
    T.StructField("key", T.StringType()), T.StructField("kept", T.BooleanType()),
    T.StructField("spans", T.StringType()), T.StructField("ids", T.StringType())])


def words(seed: int, n: int, pool: int = 5000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool):x}" for _ in range(n)]


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: nulls, empty and blank texts, one word, a very long
    word and text, copies, near copies, shared passages, repeated rows."""
    base, passage = words(1, 300), words(2, 70)
    near = list(base)
    near[150] = "changed"
    rows: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "One TWO"),
        (7, " ".join(base)), (8, " ".join(base)), (9, " ".join(near)), (10, "\n".join(base)),
        (11, " ".join(words(3, 40) + passage)), (12, " ".join(passage + words(4, 40))),
        (13, " ".join(words(5, 10) + passage[:49] + words(6, 10))), (14, " ".join(["same"] * 200)),
        (15, " ".join(["same"] * 120)), (16, "x" * 70000 + " tail"), (17, " ".join(words(7, 30000))),
        (18, "é ß 日本語 ñandú ÀÉ\x0b\x0cend"), (20, " ".join(base).upper()), (20, " ".join(base).upper()),
        (21, " ".join(passage)), (21, "another text with the same id"), (None, " ".join(base)),
        (None, " ".join(passage)), (None, None), (2**40, " ".join(near[:200])), (-5, "negative id " + " ".join(passage)),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, None if t is None else len(t), "row", 0.25, 7, "doc", 3, "key", True, "s", "i") for i, t in rows],
        DOC_SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def spans_of(flags: list[bool]) -> int:
    return sum(flags)


def union_find(n: int):
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a: int, b: int) -> None:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    return root, join
