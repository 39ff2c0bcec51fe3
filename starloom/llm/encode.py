"""Token ids of text columns with a public tokenizer file.

``TextEncoder`` gives exactly what ``Tokenizer.encode(text,
add_special_tokens=False)`` gives.  For the word-level BPE files it works
on pieces: texts are cut where the tokenizer's own pattern always cuts
(white space, around digits, between a Latin letter and ASCII
punctuation), every distinct piece is encoded once, and the ids of a text
are gathered from the pieces.  The memory of encoded pieces is bounded;
it is keyed by a 64-bit hash, so at its bound of one million pieces two
different ones share a hash with a probability below 5e-8.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from starloom.llm.words import SPACES, hash_spans, text_bytes

# The pre-tokenizer pattern and normalizer for which the piece rule holds (fixed values).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
KEEP_PIECES = 1 << 20
JOIN_WORDS = 512

LETTER, DIGIT, PUNCT, OTHER = 1, 2, 3, 0
KIND = np.full(256, PUNCT, np.uint8)
KIND[0x80:] = OTHER
KIND[0x27] = OTHER  # an apostrophe may begin a contraction
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = LETTER
KIND[0x61:0x7B] = LETTER
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class TextEncoder:
    def __init__(self, path: str, keep: int = KEEP_PIECES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.keep = keep
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.by_piece = _splits_words(spec)
        self.letters = self.tok
        if self.by_piece:  # lower-cased Latin words: only the model and its byte alphabet are needed
            self.letters = Tokenizer.from_file(path)
            self.letters.normalizer = None
            self.letters.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(),
                 pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tok.get_vocab()
        self.dtype = np.uint16 if max(vocab.values()) < 1 << 16 else np.uint32
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.closes[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.where = np.zeros(0, np.int64)  # into from_/size
        self.from_ = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, len + 1 offsets); a null text is empty."""
        raw, off = text_bytes(texts)
        whole = np.ones(len(off) - 1, bool)
        if self.by_piece:
            whole[:] = False
            data = raw.tobytes()
            for token in self.special:  # texts that hold a special token's string
                at = data.find(token)
                while at >= 0:
                    whole[np.searchsorted(off, at, "right") - 1] = True
                    at = data.find(token, at + 1)
        if not whole.any():
            return self._encode_pieces(raw, off)
        parts: list[np.ndarray] = []
        for d in range(len(off) - 1):
            if whole[d]:
                text = raw[off[d]:off[d + 1]].tobytes().decode()
                parts.append(np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype))
            else:
                parts.append(self._encode_pieces(raw[off[d]:off[d + 1]],
                                                 np.array([0, off[d + 1] - off[d]]))[0])
        size = np.array([len(p) for p in parts], np.int64)
        return np.concatenate([*parts, np.zeros(0, self.dtype)]), np.concatenate([[0], np.cumsum(size)])

    def _encode_pieces(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        buf = np.zeros(len(raw) + 8, np.uint8)
        buf[:len(raw)] = LOWER[raw]
        start, end, plain = pieces(buf[:len(raw)], off)
        first = np.searchsorted(start, off)
        if not len(start):
            return np.zeros(0, self.dtype), first
        key, index, inverse = np.unique(hash_spans(buf, start, end), return_index=True,
                                        return_inverse=True)
        slot = self._slots(buf, key, start[index], end[index], plain[index])[inverse]
        size, lead = self.size[slot], self.from_[slot]
        done = np.cumsum(size)
        ids = self.ids[np.repeat(lead - (done - size), size) + np.arange(done[-1])]
        return ids, np.concatenate([[0], done])[first]

    def _slots(self, buf, key, start, end, plain) -> np.ndarray:
        """Where the ids of the pieces with these (sorted) keys are kept; encodes new ones."""
        if len(self.keys) + len(key) > self.keep:
            self._forget()
        at = np.searchsorted(self.keys, key)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == key
        else:
            known = np.zeros(len(key), bool)
        new = np.flatnonzero(~known)
        if len(new):
            sizes, ids = self._encode_new(
                [buf[start[i]:end[i]].tobytes().decode() for i in new], plain[new])
            base, count = len(self.ids), len(self.size)
            self.from_ = np.concatenate([self.from_, base + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.ids = np.concatenate([self.ids, ids])
            self.keys = np.insert(self.keys, at[new], key[new])
            self.where = np.insert(self.where, at[new], count + np.arange(len(new)))
            at = np.searchsorted(self.keys, key)
        return self.where[at]

    def _encode_new(self, words: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of new pieces.  Pieces of letters only are one word
        each, so many are encoded as one text and cut after the word ends."""
        sizes = np.zeros(len(words), np.int64)
        order: list[np.ndarray] = []  # pieces in the order of ``found``
        found: list[np.ndarray] = []
        letters = np.flatnonzero(plain)
        groups = [letters[i:i + JOIN_WORDS] for i in range(0, len(letters), JOIN_WORDS)]
        joined = self.letters.encode_batch_fast([" ".join([words[i] for i in g]) for g in groups],
                                                add_special_tokens=False)
        single = [np.flatnonzero(~plain)]
        for g, e in zip(groups, joined, strict=True):
            ids = np.array(e.ids, self.dtype)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(g) or ends[-1] != len(ids):
                single.append(g)
                continue
            sizes[g] = np.diff(ends, prepend=0)
            order.append(g)
            found.append(ids)
        alone = np.concatenate(single)
        for i, e in zip(alone, self.tok.encode_batch_fast([words[i] for i in alone],
                                                          add_special_tokens=False), strict=True):
            sizes[i] = len(e.ids)
            found.append(np.array(e.ids, self.dtype))
        order.append(alone)
        order, found = np.concatenate(order), np.concatenate([*found, np.zeros(0, self.dtype)])
        # From that order to the order of the pieces.
        lead = np.zeros(len(words), np.int64)
        lead[order] = np.cumsum(sizes[order]) - sizes[order]
        at = np.repeat(lead - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(found))
        return sizes, found[at]


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The process's encoder for a file: tasks of one Python worker share its pieces."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def pieces(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and "letters only" of the pieces of texts; lower-cases the Latin
    letters of two bytes (the caller has done the ASCII ones)."""
    n = len(buf)
    kind = KIND[buf]
    if n > 1:  # two-byte Latin letters (U+00C0 to U+00FF without the two signs)
        lead = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7))
        kind[lead] = LETTER
        kind[lead + 1] = LETTER
        second = buf[lead + 1]
        buf[lead + 1] = np.where(second < 0x9F, second | 0x20, second)  # U+00C0 to U+00DE
    inside = ~SPACES[buf]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    if n > 1:
        a, b = kind[:-1], kind[1:]
        cut[1:n] |= ((a == DIGIT) | (b == DIGIT) | ((a == LETTER) & (b == PUNCT))
                     | ((a == PUNCT) & (b == LETTER)) | (inside[:-1] != inside[1:]))
    edge = np.flatnonzero(cut)
    start, end = edge[:-1], edge[1:]
    keep = inside[start] if n else np.zeros(0, bool)
    start, end = start[keep], end[keep]
    odd = np.concatenate([[0], np.cumsum(kind != LETTER)])
    return start, end, odd[start] == odd[end]


def _splits_words(spec: dict) -> bool:
    """Does this tokenizer file have the word pattern and normalizers the piece rule needs?"""
    normal = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return ([x.get("type") for x in normal] == WORD_NORMALIZERS
            and pre[0].get("pattern", {}).get("Regex") == WORD_PATTERN
            and spec["model"].get("end_of_word_suffix") == "</w>")
