"""SentencePiece ids and texts by a table of distinct chunks.

In a model whose pieces hold white-space markers only at their beginning
(or hold nothing else), no merge crosses from a letter to a marker.  A
text, marked as the library marks it (one marker in front, a marker for
each space), is therefore the sequence of its chunks, a run of markers with
the word after it, and so are its ids.

* One map cuts the texts into chunks, in blocks of about ``BLOCK_BYTES`` of
  text.  One exchange carries its rows: per block its documents as numbers
  of chunks, the frequent ones first, and per block and bucket the distinct
  chunks.
* A bucket's chunks, of all blocks of a group, make one dictionary: each
  distinct chunk is segmented once, by the sentencepiece library.  A group
  has at most ``GROUP_BLOCKS`` blocks (64 GB of text), so a block sends a
  bounded number of messages whatever the size of the corpus; beyond that
  size a chunk is segmented once in each group.
* The ids return to their blocks and are joined there by position.  Each
  distinct chunk's ids are decoded once in a block, by the pieces' own
  texts, and the text of a document is joined from those.

A frequent word is one entry per block, whatever the number of its
occurrences.  Chunks are told apart by their bytes.  The map may run again
for lost rows: a block's name covers its content, so a table that came in
another order then could not be mixed up, but would stop the job.  Cut the
lineage first of documents that do not come from a table.

Edge cases: null and empty texts have the begin and end ids only and decode
to ''; texts of white space are chunks of markers only; a marker character
in a text is a space to the library, as here; a text longer than a block is
a block of its own; a very long word is one chunk; repeated rows and ids
give a row each; an empty table gives no rows; extra columns travel in
``row`` and may have any names.  A model that does not split at markers is
refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import hash_spans, slices, text_bytes

MARKER = "▁"
BLOCK_BYTES = 8 << 20
GROUP_BLOCKS = 8192
# Bytes of text whose distinct chunks make a bucket.
BUCKET_BYTES = 64 << 20


def check_model(model: str) -> None:
    """Refuse a model for which chunks do not have ids of their own."""
    from sentencepiece import sentencepiece_model_pb2
    spec = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as f:
        spec.ParseFromString(f.read())
    kind, normal = spec.trainer_spec, spec.normalizer_spec
    plain = (kind.model_type == kind.BPE and kind.byte_fallback and not kind.treat_whitespace_as_suffix
             and not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces
             and not normal.remove_extra_whitespaces)
    user = any(p.type == p.USER_DEFINED for p in spec.pieces)
    inside = any(MARKER in p.piece.lstrip(MARKER) for p in spec.pieces)
    if not plain or user or inside or not any(p.piece == MARKER for p in spec.pieces):
        raise ValueError("the pieces of this model may cross white-space markers")


def processor(model: str):
    """The process's sentencepiece processor for a model file."""
    import sentencepiece
    if model not in _PROCESSORS:
        _PROCESSORS[model] = sentencepiece.SentencePieceProcessor(model_file=model)
    return _PROCESSORS[model]


_PROCESSORS: dict = {}


def piece_texts(model: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces' texts one after another, and their offsets."""
    if model not in _TEXTS:
        sp = processor(model)
        texts = [b"" if sp.is_control(i) else bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i)
                 else sp.id_to_piece(i).replace(MARKER, " ").encode() for i in range(sp.get_piece_size())]
        _TEXTS[model] = (np.frombuffer(b"".join(texts), np.uint8), offsets([len(t) for t in texts]))
    return _TEXTS[model]


_TEXTS: dict = {}


def offsets(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``values[s:s + n]`` for every (s, n), one after another."""
    lead = np.cumsum(size) - size
    return values[np.repeat(start - lead, size) + np.arange(int(size.sum()))]


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes, behind their count."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()


def cut_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of the texts one after another (a marker is a space), and
    len + 1 numbers of each text's first chunk."""
    texts = texts.fill_null("").cast(pa.large_string())
    texts = pc.replace_substring(texts, MARKER, " ")
    empty, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    marked = pc.binary_join_element_wise(space, texts, empty)
    raw, off = text_bytes(pc.if_else(pc.equal(texts, empty), empty, marked))
    mark = raw == 0x20
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    begins[off[:-1][np.diff(off) > 0]] = True
    start = np.flatnonzero(begins)
    bounds = np.append(start, len(raw)).astype(np.int64)
    chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
    return chunks, np.searchsorted(start, off)


def number_chunks(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every chunk's number among the distinct ones, the frequent first; the
    bytes of the distinct ones (padded by 8), their starts and sizes."""
    if not len(chunks):
        none = np.zeros(0, np.int64)
        return none, np.zeros(8, np.uint8), none, none
    coded = chunks.dictionary_encode()
    code = coded.indices.to_numpy()
    order = np.argsort(-np.bincount(code), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    raw, off = text_bytes_of(coded.dictionary)
    size = np.diff(off)[order]
    buf = np.concatenate([gather(raw, off[:-1][order], size), np.zeros(8, np.uint8)])
    return rank[code], buf, np.cumsum(size) - size, size


def text_bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, off, data = values.buffers()
    off = np.frombuffer(off, np.int64)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def to_blocks(row_type: pa.DataType, groups: int, buckets: int) -> Callable:
    """Map: a row for each block (its documents; ``to`` is its name) and for
    each of its buckets (chunks; ``to`` is negative, the bucket in the group)."""
    rows_type = pa.list_(row_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal made
            table = pa.Table.from_batches(parts).combine_chunks()
            rows = table.column("row").combine_chunks().cast(row_type)
            chunks, first = cut_texts(table.column("text").combine_chunks())
            del table
            number, buf, start, size = number_chunks(chunks)
            of = (hash_spans(buf, start, start + size) % np.uint64(buckets)).astype(np.int64)
            row = [pack(np.diff(first)), pack(number), pack(of)]
            content = hashlib.sha256(b"".join([f"{task},{made}".encode(), buf.tobytes(), *row])).digest()
            name, group, made = int.from_bytes(content[:8], "little") >> 1, (task + made) % groups, made + 1
            messages = []
            for b in np.unique(of):
                mine = np.flatnonzero(of == b)
                data = gather(buf, start[mine], size[mine]).tobytes()
                messages.append((-1 - group * buckets - int(b), pack(size[mine]), pa.compress(data, codec="zstd", asbytes=True)))
            n = len(messages)
            return pa.RecordBatch.from_arrays(
                [pa.array([name, *(m[0] for m in messages)], pa.int64()), pa.array([name] * (n + 1), pa.int64()),
                 pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows).cast(rows_type),
                                   pa.nulls(n, rows_type)]),
                 pa.array([row[0], *(m[1] for m in messages)], pa.binary()),
                 pa.array([row[1], *(m[2] for m in messages)], pa.binary()),
                 pa.array([row[2]] + [None] * n, pa.binary())],
                ["to", "block", "rows", "sizes", "data", "buckets"])

        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                here = int(text_bytes(part.column("text"))[1][-1])
                if held and size + here > BLOCK_BYTES:
                    yield block(held)
                    held, size = [], 0
                held.append(part)
                size += here
        if held:
            yield block(held)
    return run


def segment(model: str) -> Callable:
    """Group: the ids of a bucket's chunks, each distinct chunk segmented once."""
    def run(key: tuple, messages: pa.Table) -> pa.Table:
        if key[0].as_py() >= 0:  # documents, which stay in this exchange
            return pa.table({c: pa.array([], t) for c, t in
                             (("block", pa.int64()), ("bucket", pa.int64()), ("sizes", pa.binary()), ("ids", pa.binary()))})
        sp = processor(model)
        sizes = [unpack(m) for m in messages.column("sizes").to_pylist()]
        raw = b"".join([pa.decompress(d, int(s.sum()), codec="zstd", asbytes=True)
                        for d, s in zip(messages.column("data").to_pylist(), sizes, strict=True)])
        bounds = offsets(np.concatenate(sizes))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                       [None, pa.py_buffer(bounds), pa.py_buffer(raw)]).dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        # The library puts the first marker itself, but encodes nothing as nothing.
        found = sp.encode([c[1:].decode() for c in distinct], num_threads=1)
        alone = [sp.piece_to_id(MARKER)]
        found = [f if len(c) > 1 else alone for c, f in zip(distinct, found, strict=True)]
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        many = np.array([len(f) for f in found], np.int64)
        lead, at = np.cumsum(many) - many, chunks.indices.to_numpy()
        out = []
        for a, n in zip(offsets([len(s) for s in sizes]), [len(s) for s in sizes]):  # noqa: B905
            mine = at[a:a + n]
            out.append((pack(many[mine]), pack(gather(ids, lead[mine], many[mine]))))
        return pa.table({"block": messages.column("block"), "bucket": pa.array([-key[0].as_py()] * len(out), pa.int64()),
                         "sizes": pa.array([x[0] for x in out], pa.binary()),
                         "ids": pa.array([x[1] for x in out], pa.binary())})
    return run


def assemble(model: str, row_type: pa.DataType, with_ids: bool, with_text: bool) -> Callable:
    """Group: the documents of a block, from its numbers and its chunks' ids."""
    def run(key: tuple, block: pa.Table, messages: pa.Table) -> pa.Table:
        sp = processor(model)
        if not block.num_rows or block.column("to")[0].as_py() < 0:  # chunks, which stay in this exchange
            if messages.num_rows:
                raise RuntimeError("the documents came in another order: cut their lineage first")
            return pa.table({"row": pa.array([], row_type), "n_tokens": pa.array([], pa.int64()),
                             "ids_sha256": pa.array([], pa.string()), "decoded_sha256": pa.array([], pa.string()),
                             "ids": pa.array([], pa.list_(pa.int32())), "decoded": pa.array([], pa.string())})
        bos, eos = (np.array([i], "<u4").tobytes() for i in (sp.bos_id(), sp.eos_id()))
        messages = messages.sort_by("bucket")
        size, ids = (np.concatenate([np.zeros(0, "<u4"), *map(unpack, messages.column(c).to_pylist())]).astype("<u4")
                     for c in ("sizes", "ids"))
        of = unpack(block.column("buckets")[0].as_py())
        if len(of) != len(size):
            raise RuntimeError("the documents came in another order: cut their lineage first")
        place = np.empty(len(of), np.int64)  # of each chunk among the chunks by bucket
        place[np.argsort(of, kind="stable")] = np.arange(len(of))
        size = size.astype(np.int64)
        lead = np.cumsum(size) - size
        blob, at = piece_texts(model)
        long = np.diff(at)[ids]
        text, text_at = gather(blob, at[ids], long).tobytes(), offsets(long)
        chunk_at = text_at[np.append(lead, len(ids))].tolist()
        texts = [text[a:b] for a, b in zip(chunk_at, chunk_at[1:])]  # noqa: B905
        number = place[unpack(block.column("data")[0].as_py())]
        sizes, digests, decoded, lists = [], [], [], []
        edge = offsets(unpack(block.column("sizes")[0].as_py()))
        for a, b in zip(edge, edge[1:]):  # noqa: B905
            mine = number[a:b]
            data = b"".join([bos, gather(ids, lead[mine], size[mine]).tobytes(), eos])
            words = b"".join([texts[i] for i in mine.tolist()])[1:]  # without the first marker
            sizes.append(len(data) // 4)
            digests.append((hashlib.sha256(data).hexdigest(), hashlib.sha256(words).hexdigest()))
            lists.append(np.frombuffer(data, "<u4").astype(np.int32) if with_ids else None)
            decoded.append(words.decode() if with_text else None)
        return pa.table({"row": block.column("rows").combine_chunks().flatten().cast(row_type),
                         "n_tokens": pa.array(sizes, pa.int64()),
                         "ids_sha256": pa.array([d[0] for d in digests], pa.string()),
                         "decoded_sha256": pa.array([d[1] for d in digests], pa.string()),
                         "ids": pa.array(lists, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())})
    return run


def partitions_of(pieces: int) -> int:
    """One piece of work per partition, up to 16 where there are very many."""
    return max(1, min(pieces, max(4096, pieces // 16)))


def encode_documents(docs: DataFrame, model: str, text_col: str = "text", with_ids: bool = True,
                     with_text: bool = True) -> DataFrame:
    """One row per document: ``row`` (its other columns), ``n_tokens``,
    ``ids`` with the begin and end ids, ``decoded`` (what the ids decode to)
    and the digests of both."""
    from pyspark.sql.pandas.types import to_arrow_type
    check_model(model)
    others = [c for c in docs.columns if c != text_col]
    src = docs.select(F.struct(*others).alias("row"), F.col(text_col).cast("string").alias("text"))
    row = src.schema["row"].dataType
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // (GROUP_BLOCKS * BLOCK_BYTES)))
    buckets = max(1, -(-size // (groups * BUCKET_BYTES)))
    # One exchange, read for the chunks and for the documents.
    n_blocks = -(-size // BLOCK_BYTES)
    dealt = src.mapInArrow(
        to_blocks(to_arrow_type(row), groups, buckets),
        f"to long, block long, rows array<{row.simpleString()}>, sizes binary, data binary, buckets binary") \
        .repartition(partitions_of(max(n_blocks, groups * buckets)), "to")
    ids = dealt.groupBy("to").applyInArrow(segment(model), "block long, bucket long, sizes binary, ids binary")
    return dealt.groupBy("to").cogroup(ids.groupBy("block")).applyInArrow(
        assemble(model, to_arrow_type(row), with_ids, with_text),
        f"row {row.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, "
        "ids array<int>, decoded string")


def decode_ids(ids: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``text``, what the library decodes ``ids_col`` to (null ids: null)."""
    from pyspark.sql.types import StringType, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        for batch in batches:
            found = [None if i is None else sp.decode(i) for i in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())],
                                             [*batch.schema.names, "text"])
    return ids.mapInArrow(run, StructType([*ids.schema.fields]).add("text", StringType()))
