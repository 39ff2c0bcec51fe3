"""Substring dedup, decontamination, Jaccard join, lines and licences against brute force."""

import hashlib

import pytest

from helpers import LOWER, TEST_WORD, WORD, edge_texts, frame, sha, union_find, words
from starloom.llm import decontaminate as deco
from starloom.llm import jaccard, licenses, lines, substrings


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- substring dedup ---------------------------------------------------------

def brute_substrings(docs, width):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - width + 1):
                at = tuple(w[k:k + width])
                first[at] = min(i, first.get(at, i))
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for k in range(len(w) - width + 1):
                if first[tuple(w[k:k + width])] < i:
                    gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [1, 5, 50])
def test_substrings(spark, width, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 1 << 14)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 1 << 15)
    docs = edge_texts()
    out = substrings.remove_repeated(frame(spark, docs), width)
    assert rows(out.select("doc_id", "n_words", "n_removed", "kept_sha256")) == brute_substrings(docs, width)
    for r in out.collect():
        assert sha(r.kept) == r.kept_sha256
        assert sum(s.hi - s.lo for s in r.removed) == r.n_removed
        assert all(a.hi < b.lo for a, b in zip(r.removed, r.removed[1:], strict=False))


def test_substrings_empty_table(spark):
    assert substrings.remove_repeated(frame(spark, [])).count() == 0


def test_equal_first_hash_is_told_apart_by_the_second():
    import numpy as np
    import pyarrow as pa
    k, s, d = np.array([5, 5, 9], np.uint64), np.array([1, 2, 1], np.uint16), np.array([3, 4, 6], np.int64)
    t = pa.table({"chunk": pa.array([0, 1], pa.int64()), "n": pa.array([3, 1], pa.int64()),
                  "entries": [substrings.pack(k, s, d), substrings.pack(k[1:2], s[1:2], d[1:2] + 4)]})
    out = substrings.mark_repeated((pa.scalar(7),), t).to_pylist()
    assert out == [{"chunk": 1, "bucket": 7, "bits": b"\x80"}]


# -- decontamination ---------------------------------------------------------

def brute_hits(docs, items, width):
    windows = {}
    for item, text in items:
        w = TEST_WORD.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(item)
    out = []
    for i, text in docs:
        w = TEST_WORD.findall((text or "").translate(LOWER))
        hit, who = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    who |= found
        who.discard(None)
        listed = ",".join(sorted(map(str, who)))
        out.append((i, len(w), len(hit), len(who), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [deco.BLOCK_BYTES, 300])
@pytest.mark.parametrize("width", [1, 3, 10])
def test_decontaminate(spark, width, block):
    docs = edge_texts()
    items = [(1, " ".join(words(2, 70)[10:40])), (2, "ONE, two"), (10, "one"), (3, None), (4, ""), (5, "?! --"),
             (6, " ".join(words(1, 300)[140:160])), (6, " ".join(words(1, 300)[20:35])), (None, "日本語 Ñandú"),
             (7, " ".join(words(2, 70)[10:40]).upper()), (8, "same " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = deco.decontaminate(frame(spark, docs), bench, width, block_bytes=block)
    got = rows(out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
    assert got == brute_hits(docs, items, width)
    flagged = deco.flag_contaminated(frame(spark, docs), bench, width, block_bytes=block)
    want = sorted(((r[0], r[5]) for r in got), key=repr)
    assert sorted(((r.row.doc_id, r.contaminated) for r in flagged.collect()), key=repr) == want


def test_decontaminate_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not [r for r in deco.decontaminate(frame(spark, edge_texts()), bench).collect() if r.contaminated]
    assert deco.decontaminate(frame(spark, []), bench).count() == 0


# -- Jaccard join ------------------------------------------------------------

def shingles(text, size=4):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute_groups(docs, size=4, percent=85):
    sets = [shingles(t, size) for _, t in docs]
    root, join = union_find(len(docs))
    for a in range(len(docs)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                join(a, b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(sets[k]), least.get(root(k))) for k, (i, _) in enumerate(docs)), key=repr)


def families():
    """Chains of near copies around the threshold, and unrelated texts that share a passage."""
    out = list(edge_texts())
    for f in range(4):
        text = words(100 + f, 80 + 30 * f)
        for k in range(12):
            text = list(text)
            text[(17 * k) % len(text)] = f"new{k}"
            if k % 3 == 0:
                text.insert(5, f"more{k}")
            out.append((1000 + 100 * f + k, " ".join(text)))
    shared = words(200, 30)
    out += [(3000 + k, " ".join(words(300 + k, 25) + shared)) for k in range(60)]
    return out


@pytest.mark.parametrize("tile,leaf", [(1024, 32), (8, 4)])
def test_jaccard(spark, tile, leaf, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", tile)
    docs = families()
    got = rows(jaccard.near_duplicates(frame(spark, docs)))
    assert got == brute_groups(docs)


def test_jaccard_empty_table(spark):
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0


def test_tree_finds_every_pair_the_bound_leaves():
    import numpy as np
    rng = np.random.default_rng(3)
    centre = rng.poisson(2, (6, 32))
    points = np.maximum(centre[rng.integers(0, 6, 300)] + rng.integers(-1, 2, (300, 32)), 0)
    sizes = points.sum(axis=1)
    tree = jaccard.CountTree(points, sizes, 85)
    for i in range(300):
        bound = np.minimum(points, points[i]).sum(axis=1)
        fits = (100 * sizes >= 85 * sizes[i]) & (85 * sizes <= 100 * sizes[i])
        want = np.flatnonzero(fits & jaccard.may_link(bound, sizes[i], sizes, 85))
        assert sorted(tree.search(points[i], int(sizes[i]))) == list(want)


# -- lines -------------------------------------------------------------------

def brute_lines(docs, order, least=lines.LEAST_CHARS):
    """Lines outside the passages that earlier places have, from the definition."""
    place = {(i, t): (2**63 - 1 if i is None else i, order[i, t]) for i, t in docs if t is not None}
    first: dict = {}
    for (i, t), at in place.items():
        ls = t.split("\n")
        for k, pair in enumerate(zip(ls, ls[1:], strict=False)):
            first[pair] = min((*at, k), first.get(pair, (*at, k)))
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, 0, 0, None))
            continue
        ls, chunk, gone = t.split("\n"), set(), set()
        for k in range(len(ls)):
            at = first.get(tuple(ls[k:k + 2]), None) if k + 1 < len(ls) else None
            if at and (*place[i, t], k) > at and not (at[:2] == place[i, t] and k < at[2] + 2):
                chunk |= {k, k + 1}
                continue
            if len("".join("".join(ls[c] for c in chunk).split())) >= least or len(chunk) == len(ls):
                gone |= chunk
            chunk = set()
        out.append((i, len(ls), len(gone), "\n".join(x for k, x in enumerate(ls) if k not in gone)))
    return sorted(out, key=repr)


def line_order(df):
    """Ties between texts of one id are broken by the hash the operator uses."""
    from pyspark.sql import functions as F
    return {(r.doc_id, r.text): r.h for r in
            df.select("doc_id", "text", F.xxhash64("text", F.col("doc_id").isNull()).alias("h")).collect()}


def line_docs():
    own = iter(range(10**6))
    page = [f"line {k} of the page" for k in range(40)]
    docs = [*edge_texts(), (100, "\n".join(page)), (101, "\n".join(["intro", *page, "end"])),
            (102, "\n".join([*page[:20], "inserted", *page[20:]])), (103, "\n".join(page)), (103, "\n".join(page)),
            (104, "\n".join(["a", "b"] * 30)), (None, "\n".join(page)), (None, "\n".join(page[3:9])),
            (110, "one line"), (111, "one line"), (112, ""), (113, ""), (114, "a\na\na"), (115, "b\nb\nb\nb\nb"),
            (116, "c\nd\nc\nd\nc"), (117, "p\n\n\n\nq\n"), (118, "p\n\n\n\nq\n"), (119, "\n".join(["long"] * 3000)),
            (120, "class A:\n    z\n\n\nclass B:\n    w"), (121, "def f():\n    z\n\n\ndef g():\n    w"),
            (122, "while c {\n  d\n  }\n}\n"), (123, "if e {\n  f\n  }\n}\nand more")]
    for n in (2, 3, 5, 9):  # passages of otherwise different documents
        for at in range(0, 30, 4):
            mine = [f"own {next(own)}" for _ in range(6)]
            docs.append((200 + next(own), "\n".join(mine[:3] + page[at:at + n] + mine[3:])))
    return docs


@pytest.mark.parametrize("least", [0, 20, lines.LEAST_CHARS, 10**6])
def test_lines(spark, least):
    df = frame(spark, line_docs()).repartition(5)
    out = lines.dedup_lines(df, least_chars=least)
    got = rows(out.select("row.doc_id", "n_lines", "n_removed", "kept"))
    assert got == brute_lines(line_docs(), line_order(df), least)
    if least == lines.LEAST_CHARS:
        by = {r[0]: r for r in got}
        assert by[103][1:] == (40, 40, "") and by[102][3] == "inserted" and by[101][3] == "intro\nend"
        assert by[118][2] == 6 and by[100][2] == 0 and by[114][3] == "a\na\na"
        assert not any(by[i][2] for i in (120, 121, 122, 123))  # blank lines and braces stay
        kept = [r for r in got if r[0] is not None and 200 <= r[0] < 10**6]
        assert all(r[1] - r[2] in (6, r[1]) for r in kept)


def test_different_lines_with_one_hash(spark, monkeypatch):
    from pyspark.sql import functions as F
    short = r"transform(array(split({t}, '\n')), l -> transform(slice(l, 2, size(l)), (x, i) -> " \
            "named_struct('no', i, 'hash', cast(length(x) % 3 as bigint))))[0]"
    monkeypatch.setattr(lines, "gaps", lambda t: F.expr(short.replace("{t}", t)))
    df = frame(spark, line_docs())
    got = rows(lines.dedup_lines(df).select("row.doc_id", "n_lines", "n_removed", "kept"))
    assert got == brute_lines(line_docs(), line_order(df))


def test_lines_empty_table(spark):
    assert lines.dedup_lines(frame(spark, [])).count() == 0


# -- licences ----------------------------------------------------------------

def test_licenses(spark):
    mit = dict(licenses.KNOWN[:1])["MIT"]
    odd = mit.upper().replace(",", " ,").replace("SUBLICENSE", "sub-licence").replace("\n\n", "\n \n")
    docs = [(1, mit), (2, "Copyright (c) 2020 Someone\n\n" + odd), (3, "intro\nLicensed under CC BY-NC 4.0.\nmore"),
            (4, "text\n\n" + dict(licenses.KNOWN)["MPL-2.0"].replace(". ", ".\n") + "\n\nmore"), (5, None), (6, ""), (7, "licence"),
            (8, mit.replace("without restriction", "with restriction")), (3, "intro\nLicensed under CC BY-NC 4.0.\nmore"),
            (9, "licenced under the apache licence version 2.0"), (None, "Licensed under CC0 1.0")]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, docs)).collect()}
    assert licenses.scan_licenses(frame(spark, docs)).count() == len(docs)
    assert got[1].whole_license == "MIT" and got[2].whole_license == "MIT"
    assert got[3].licenses == "CC-BY-NC-4.0" and got[3].whole_license is None and got[3].n_matches == 1
    assert got[4].licenses == "MPL-2.0"
    assert got[9].whole_license == "Apache-2.0" and got[None].whole_license == "CC0-1.0"
    assert all(got[i].licenses == "" and got[i].n_matches == 0 for i in (5, 6, 7, 8))
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_license_files(spark):
    from pathlib import Path
    known = dict(reversed(licenses.KNOWN))
    mit = "MIT License\n\nCopyright (c) 2021 Someone\n\n" + known["MIT"]
    bsd = "BSD 3-Clause License\n\nCopyright (c) 2021, Someone\nAll rights reserved.\n\n" \
        + known["BSD-3-Clause"].replace("\n\n2.", "\n2.").replace("\n\n1.", "\n1.").replace("\n\n3.", "\n3.")
    isc = "ISC License\n\nCopyright (c) 2021 Someone\n\n" + known["ISC"]
    files = [(p.stem, p.read_text()) for p in
             sorted((Path(licenses.__file__).parent / "license_texts").glob("*.txt"))]
    files += [("MIT", mit), ("BSD-3-Clause", bsd), ("ISC", isc)]
    alone = [(k, t) for k, (_, t) in enumerate(files)]
    inside = [(100 + k, f"An introduction.\n\nMore of it.\n\n{t.strip()}\n\nThe end.") for k, t in alone]
    cut = [(200, mit.replace("without restriction", "with restriction")), (201, "\n\n".join(mit.split("\n\n")[:3])),
           (202, "one\n\n" + mit + "\n\ntwo\n\n" + isc + "\n\nthree")]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, alone + inside + cut)).collect()}
    for k, (name, _) in enumerate(files):
        assert got[k].whole_license == name, name
        assert got[100 + k].whole_license is None and name in got[100 + k].licenses.split(","), name
    assert got[200].licenses == "" and got[201].licenses == "" and got[202].licenses == "ISC,MIT"


def brute_canonical(text):
    import regex
    text = regex.sub(licenses.COPYRIGHT_LINE, "", text).lower()
    for old, new in licenses.SPELLINGS:
        text = regex.sub(old, new, text)
    return regex.sub(r"[^\p{L}\p{N}]+", " ", text).strip()


def brute_licenses(docs):
    """Digest lookup without digests: canonical texts of documents, blocks, lines and runs of blocks."""
    import regex
    whole = licenses.whole_texts()
    names: dict = {}
    for name, t in licenses.KNOWN + whole + licenses.titled(whole):
        names.setdefault(brute_canonical(t), set()).add(name)
    blocks = lambda t: [c for c in map(brute_canonical, regex.split(licenses.BLOCKS, t)) if c]
    runs = {(tuple(blocks(t)), name) for name, t in whole if len(blocks(t)) > 1}
    out = []
    for i, t in docs:
        hits: dict = {}
        if t is not None:
            units = [("text", 0, t), *(("block", k, x) for k, x in enumerate(regex.split(licenses.BLOCKS, t))),
                     *(("line", k, x) for k, x in enumerate(t.split("\n")))]
            for unit, k, x in units:
                if (c := brute_canonical(x)) in names and c:
                    hits.setdefault((unit, k), set()).update(names[c])
            own = blocks(t)
            for k in range(len(own)):
                for run, name in runs:
                    if tuple(own[k:k + len(run)]) == run and len(own) > 1:
                        hits.setdefault(("run", k), set()).add(name)
        least = {k: min(v) for k, v in hits.items()}
        out.append((i, least.get(("text", 0)), ",".join(sorted(set(least.values()))), len(least)))
    return sorted(out, key=repr)


def test_licenses_equal_brute_force(spark):
    import random
    rng = random.Random(12)
    texts = [t for _, t in licenses.KNOWN] + [t for _, t in licenses.whole_texts() if len(t) < 12000]
    parts = ["an ordinary line", "Copyright (c) 2021 Someone", "All rights reserved.", "the licence of this", "permission",
             "Licensed under CC BY 4.0.", "MIT License"]
    docs = list(edge_texts())
    for i in range(100, 220):
        bits = []
        for _ in range(rng.randint(1, 5)):
            t = rng.choice([rng.choice(texts), rng.choice(parts)])
            if rng.random() < .3:
                t = rng.choice([t.upper(), t.replace(",", " ;"), t.replace("License", "Licence"), t.replace("\n\n", "\n \t\n"),
                                "\n\n".join(t.split("\n\n")[:2]), "# " + t, t.replace("the", "teh", 1)])
            bits.append(t)
        docs.append((i, rng.choice(["\n", "\n\n", "\n\n"]).join(bits)))
    docs += [(300, "permission of a long text\n" * 40000), docs[-1], docs[-1], (None, docs[-2][1])]
    out = licenses.scan_licenses(frame(spark, docs))
    assert rows(out.select("doc_id", "whole_license", "licenses", "n_matches")) == brute_licenses(docs)
    assert sum(r[3] for r in brute_licenses(docs)) > 100


def test_every_known_text_has_an_anchor():
    import re
    assert all(re.search(licenses.ANCHORS, text) for _, text in licenses.KNOWN)
    assert all(re.search(licenses.ANCHORS, text) for _, text in licenses.whole_texts())
