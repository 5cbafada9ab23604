"""The words of Arrow texts, by whole arrays: exact numbers within a slice, and 64-bit hashes across slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled about this many bytes at a time; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 19
_ODD = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of texts that lie end to end in ``data``: ``first`` byte and ``end`` (byte after) of each, and where
    each text's words ``begin`` among them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lowered: np.ndarray | None):
        self.lowered = lowered
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        word = is_word[data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last[:-1] &= ~word[1:] | edge[1:n]
        self.first, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.begin = np.searchsorted(self.first, offsets)
        self.letters = data[word] if lowered is None else lowered[data[word]]
        self.ends = np.cumsum(self.end - self.first)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words alone, and the words by number."""
        at = np.concatenate([[0], self.ends]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(self.ends), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(self.letters))])
        coded = words.dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary

    def hashes(self) -> np.ndarray:
        """xxh3 of each word's bytes."""
        from xxhash import xxh3_64_intdigest

        codes, words = self.codes()
        return np.fromiter(map(xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))[codes]

    def name(self, i: int) -> str:
        """A cryptographic digest of a text's word sequence."""
        from hashlib import blake2b

        a, b = self.begin[i], self.begin[i + 1]
        low = self.ends[a - 1] if a else 0
        d = blake2b(self.letters[low : self.ends[b - 1] if b else 0], digest_size=16)
        d.update(self.ends[a:b] - low)
        return d.hexdigest()


class WordHasher:
    """Cuts UTF-8 texts into words ``[^\\x20\\x09-\\x0D]+``; with ``lower`` A-Z count as a-z."""

    def __init__(self, lower: bool = False):
        self.lowered = None
        if lower:
            self.lowered = np.arange(256, dtype=np.uint8)
            self.lowered[65:91] += 32
        self.is_word = np.ones(256, bool)
        self.is_word[[32, *range(9, 14)]] = False

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
        """(first, last + 1, words) of slices of ``texts`` (no nulls)."""
        for a, b, data, offsets in self.pieces(texts):
            yield a, b, self.words(data, offsets)

    def pieces(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first, last + 1, bytes, offsets) of slices of ``texts``."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if len(texts) == 0:
            return
        large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
        offsets = np.frombuffer(texts.buffers()[1], np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
            yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            a = b

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        return Words(data, offsets, self.is_word, self.lowered)

    def of(self, texts: list[bytes]) -> Words:
        """The words of some texts as one slice."""
        return self.words(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` word hashes, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, k):
        h *= np.uint64(_ODD)
        h += words[j : n + j]
    return mixed(h)


def exact_windows(words: Words, k: int) -> list[np.ndarray]:
    """Each text's distinct runs of ``k`` words as sorted numbers, equal across the texts for equal runs of words alone;
    a text of fewer words, but not none, has its whole sequence as the only one."""
    codes, dictionary = words.codes()
    n_texts, size = len(words.begin) - 1, np.diff(words.begin)
    short = np.where(size > 0, np.maximum(k - size, 0), 0)
    # texts of fewer words are filled up with a number that no word has
    padded = np.zeros(len(codes) + int(short.sum()), np.int64)
    shift = np.cumsum(short) - short
    padded[np.arange(len(codes)) + np.repeat(shift, size)] = codes + 1
    start, count = words.begin[:-1] + shift, np.maximum(size + short - k + 1, 0)
    at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
    base = bound = len(dictionary) + 1
    key = padded[at]
    for j in range(1, k):
        if bound * base >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            bound = len(distinct)
        key, bound = key * base + padded[at + j], bound * base
    ends = np.cumsum(count)
    return [np.unique(key[ends[i] - count[i] : ends[i]]) for i in range(n_texts)]
