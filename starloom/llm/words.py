"""Words of Arrow text columns as numpy arrays: byte spans and 64-bit hashes.

Helper of the text operators that work inside ``mapInArrow``.  A column of
texts is cut into slices of bounded bytes; each slice becomes one byte
array, and all per-word work (finding the words, hashing them) is done on
whole arrays.  A null text has no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# The arrays of a slice take some thirty times its bytes.
SLICE_BYTES = 1 << 20
LONG_WORD = 256
LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)

# Byte classes (fixed values): the white space of the task's word patterns,
# and the bytes outside a benchmark word.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[0x30:0x3A] = False
NOT_ALNUM[0x61:0x7B] = False
NOT_ALNUM[0x80:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of texts: ``buf[start[i]:end[i]]`` in text ``doc[i]``;
    the words of text ``d`` are numbers ``first[d]`` to ``first[d + 1]``."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return hash_spans(self.buf, self.start, self.end, seed)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and len + 1 offsets."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``most`` bytes (one row at least)."""
    _, off = text_bytes(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(off, off[row] + most, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def split_words(texts: pa.Array, gaps: np.ndarray = SPACES, lower: bool = False) -> Words:
    """Words are maximal runs of bytes outside ``gaps`` (a 256-entry mask)."""
    raw, off = text_bytes(texts)
    buf = np.zeros(len(raw) + 8, np.uint8)
    buf[:len(raw)] = LOWER[raw] if lower else raw
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = ~gaps[buf[:len(raw)]]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside[:-1]
    before[off] = False  # a text starts afresh
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = inside[1:]
    ends = off[1:] - 1
    after[ends[ends >= 0]] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(buf, start, end, doc, first)


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of every span of ``buf`` (padded by 8 bytes), eight bytes at a time."""
    size = end - start
    eight = np.ndarray((max(len(buf) - 7, 0),), dtype="<u8", buffer=buf, strides=(1,))
    h = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            + np.uint64((seed * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) % 2**64))
    live = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(live):
        part = eight[start[live] + at] & LOW_BYTES[np.minimum(size[live] - at, 8)]
        h[live] = mix(h[live] ^ part)
        at += 8
        live = live[size[live] > at]
    for i in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(buf[start[i]:end[i]].tobytes(), digest_size=8,
                                 salt=seed.to_bytes(8, "little")).digest()
        h[i] = np.uint64(int.from_bytes(digest, "little"))
    return h


def window_hashes(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp value of every ``width`` consecutive entries (polynomial
    modulo 2**64 with an odd base), mixed.  Length is len(h) - width + 1."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    power = powers(base, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * power[:n], out=total[1:])
    back = powers(pow(base, -1, 2**64), n + 1)
    return mix((total[width:] - total[:n - width + 1]) * back[:n - width + 1])


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n (kept between calls)."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, 1024), np.uint64)
        done = 1
        while done < len(have):
            step = min(done, len(have) - done)
            have[done:done + step] = have[:step] * np.uint64(pow(base, done, 2**64))
            done += step
        _POWERS[base] = have
    return have[:n]


def spans_equal(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray,
                b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Byte comparison of spans of ``a`` with spans of ``b`` (both padded by 8 bytes)."""
    size = a_end - a_start
    same = size == (b_end - b_start)
    live = np.flatnonzero(same)
    if not len(live):
        return same
    va = np.ndarray((len(a) - 7,), dtype="<u8", buffer=a, strides=(1,))
    vb = np.ndarray((len(b) - 7,), dtype="<u8", buffer=b, strides=(1,))
    for i in live[size[live] > LONG_WORD]:
        same[i] = (a[a_start[i]:a_end[i]] == b[b_start[i]:b_end[i]]).all()
    live = live[size[live] <= LONG_WORD]
    at = 0
    while len(live):
        keep = LOW_BYTES[np.minimum(size[live] - at, 8)]
        ok = (va[a_start[live] + at] ^ vb[b_start[live] + at]) & keep == 0
        same[live[~ok]] = False
        at += 8
        live = live[ok]
        live = live[size[live] > at]
    return same
