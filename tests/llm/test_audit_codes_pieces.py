"""Filter audit, vector codes and SentencePiece against brute force and the library."""

import hashlib
import math
import random
from fractions import Fraction
from itertools import permutations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from helpers import WORD, edge_texts, frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.audit import audit, document_failures, with_labels
from starloom.llm.codes import CellMemo, codebooks_digest, vector_codes, with_label_errors
from starloom.llm.sentencepieces import check_model, cut_texts, decode_ids, encode_documents, number_chunks

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


# ---- SentencePiece

def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    alphabet = list("ab 1.\n\té▁ß日\U0001F600\x00　​<s>�") + ["  ", "     ", "<0x0A>", "▁▁", "ing", "the "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    return [*texts, *(t for _, t in edge_texts()), None, "", " ", "  ", "▁", " " * 100, "x" * 5000, " a" * 70000,
            " ".join(f"w{i}" for i in range(70000)), "<s>", "</s> <unk>"]


def test_ids_and_texts_equal_the_library(spark):
    texts = odd_texts()
    docs = frame(spark, list(enumerate(texts)))
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.row.doc_id: r for r in encode_documents(docs.repartition(3), MODEL).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        decoded = sp.decode(ids)
        r = got[i]
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), decoded), (i, text)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert r.row.key == "key" and r.row.n_chars == (None if text is None else len(text))


def test_pieces_on_empty_tables_and_of_ids(spark):
    none = frame(spark, []).limit(0)
    assert encode_documents(none, MODEL).collect() == []
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lists = [[1, 264, 287, 2], [], None, [3 + 0xC3, 3 + 0x28], [3 + 0xF0, 264]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "text_no int, ids array<int>")
    assert [r.text for r in decode_ids(df, MODEL).orderBy("text_no").collect()] == \
        [None if x is None else sp.decode(x) for x in lists]


def test_many_small_blocks_buckets_and_groups(spark, monkeypatch):
    import starloom.llm.sentencepieces as module
    for name, value in (("BLOCK_BYTES", 3000), ("GROUP_BLOCKS", 7), ("BUCKET_BYTES", 2000)):
        monkeypatch.setattr(module, name, value)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [t for t in odd_texts() if t is None or len(t) < 10000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.row.doc_id: r.ids for r in encode_documents(docs, MODEL, with_text=False).collect()}
    assert got == {i: sp.encode(t or "", add_bos=True, add_eos=True) for i, t in enumerate(texts)}


def test_chunks_are_numbered_by_frequency():
    chunks, first = cut_texts(pa.array(["a b a c a", None, "", "  a"]))
    number, buf, start, size = number_chunks(chunks)
    distinct = [buf[s:s + n].tobytes() for s, n in zip(start, size, strict=True)]
    assert [distinct[i] for i in number] == [b" a", b" b", b" a", b" c", b" a", b"   a"]
    assert distinct[0] == b" a" and first.tolist() == [0, 5, 5, 5, 6]


def test_models_whose_pieces_cross_markers_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    spec = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        spec.ParseFromString(f.read())
    check_model(MODEL)
    spec.pieces[5000].piece = "of▁the"
    path = tmp_path / "crossing.model"
    path.write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        check_model(str(path))


# ---- Filter audit

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("part", T.StringType()),
                     T.StructField("n", T.LongType()), T.StructField("filter", T.StringType()),
                     T.StructField("digest", T.IntegerType())])


def audit_rows():
    rng = random.Random(9)
    rows = []
    for i in range(60):
        n = rng.choice([5, 199, 200, 260])
        words = [rng.choice(["same", f"w{rng.randrange(10**6)}"]) if i % 3 else f"v{j}" for j in range(n)]
        text = " ".join(words) + rng.choice(["", " AAAAAAAAAA" * 30, " #", " É"])
        rows.append((i, text, rng.choice(["en", "fr", None, ""])))
    rows += [(100 + i, rows[i % 3][1], "en") for i in range(40)]  # copies
    rows += [(200, None, "en"), (201, "", "de"), (202, " \t ", None), (None, rows[0][1], "en"), (None, None, None),
             (None, None, None), (7, "another text with the same id %", "en"), (3, *rows[3][1:]), (3, *rows[3][1:]),
             (300, "long " * 60000, "en"), (-5, rows[1][1], "fr")]
    return rows


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids: dict[str, list[int]] = {}
    for i, t, _ in rows:
        if i is not None:
            ids.setdefault(t or "", []).append(i)
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and any(j < i for j in ids.get(t, []))}
        docs.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        here = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = sum(f in d[1] for d in mine)
                total[f] += len(gone)
                here.append([part, "".join(order), step, len(left), len(gone), failing - len(gone),
                             sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone), f])
        out += [(*h[:9], total[h[9]]) for h in here]
    return sorted(out)


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 110, 2)] + [(4, None, None), (4, 1, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, "p", 5, "f", 1) for r in rows], DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(with_labels(document_failures(docs), marks), list("ABCDE")).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, labels)
    none = audit(with_labels(document_failures(docs.limit(0)), marks.limit(0)), list("ABCDE"))
    assert none.collect() == [] and none.columns[0] == "part"


# ---- Vector codes

VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType()),
                     T.StructField("salt", T.StringType())])


def brute_codes(rows, parts, entries, rounds):
    ok = [(i, v, g) for i, v, g in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ok = [(i, [math.floor(256 * Fraction(x)) for x in v], g) for i, v, g in ok]
    if not ok:
        return [], None
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])]
    w = len(ok[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in ok]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            mine: dict[int, list] = {}
            for c in cut:
                mine.setdefault(nearest(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(col) // len(mine[k]) for col in zip(*mine[k], strict=True)] if k in mine else e
                        for k, e in enumerate(book)]
    out = []
    for (i, _, g), c in zip(ok, cut, strict=True):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, g, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    total: dict = {}
    for _, g, _, e in out:
        total[g] = total.get(g, 0) + e
    return [(*r, total[r[1]]) for r in out], books


def vector_rows(n=300, dim=32):
    rng = random.Random(3)

    def number(scale):
        return float(np.float32(rng.gauss(0, scale)))
    rows = [(i, [number(0.2) for _ in range(dim)], rng.choice([1, 1, 2, None])) for i in range(n)]
    rows += [(n + 1, rows[0][1], 1), (n + 2, rows[0][1], 3), (5, rows[9][1], 2), (None, rows[2][1], 2), (n + 3, None, 1),
             (n + 4, [None, *rows[1][1][1:]], 1), (n + 5, [float("nan"), *rows[1][1][1:]], 1),
             (n + 6, [float("-inf"), *rows[1][1][1:]], 1), (n + 7, [], 1), (n + 8, [0.5] * (dim * 2), 1), (n + 9, [0.5] * 3, 1),
             (n + 10, [0.0] * dim, None), (n + 11, [-0.0] * dim, 1), (-7, [900.0] * dim, 9), (n + 12, [-0.001] * dim, 9)]
    return rows


@pytest.mark.parametrize("entries", [64, 3])
def test_codes_equal_brute_force(spark, entries):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "c", "s") for r in rows], VECS).repartition(4)
    coded, books = vector_codes(df, parts=8, entries=entries)
    expected, expected_books = brute_codes(rows, 8, entries, 2)
    assert books.tolist() == expected_books

    def order(r):
        return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted((tuple(r) for r in with_label_errors(coded).collect()), key=order) == sorted(expected, key=order)
    numbers = ",".join(str(x) for b in expected_books for e in b for x in e)
    assert codebooks_digest(books) == hashlib.sha256(numbers.encode()).hexdigest()


def test_codes_of_few_or_no_vectors(spark):
    df = spark.createDataFrame([(*r, "c", "s") for r in vector_rows(12)[:5]], VECS)
    coded, books = vector_codes(df)
    assert books.shape == (16, 5, 2) and coded.where("error = 0").count() == 5
    coded, books = vector_codes(df.limit(0))
    assert books is None and with_label_errors(coded).collect() == []
    with pytest.raises(Exception, match="too large"):
        vector_codes(spark.createDataFrame([(1, [1e12] * 16, 1, "c", "s")], VECS))[0].collect()


def test_memo_evaluates_few_entries_and_survives_ties():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 32, (20000, 4))).astype(np.int64)
    book = x[:64].copy()
    book[40] = book[3]  # equal entries: the lower index wins
    square = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    for memo in (CellMemo(book), CellMemo(book, keep=100)):
        parts = [memo.nearest(p) for p in np.array_split(x, 7)]
        assert (np.concatenate([e for e, _ in parts]) == square.argmin(axis=1)).all()
        assert (np.concatenate([d for _, d in parts]) == square.min(axis=1)).all()
        assert memo.evaluated < 0.5 * len(x) * len(book)
    memo = CellMemo(book)
    memo.nearest(x[:100])
    memo.cells[:] += 1  # as if other cells had these hashes
    assert (memo.nearest(x[:100])[0] == square[:100].argmin(axis=1)).all()
