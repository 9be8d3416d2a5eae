"""Vectorised words, hashes and windows over the UTF-8 bytes of a batch of texts.

All functions work on whole Arrow batches with numpy: the texts of a chunk are
one byte array, words are (start, end) pairs, and hashes of words or of word
windows come from prefix sums of ``byte * P**i`` modulo 2**64, so that no
Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_U = np.uint64
_P, _Q = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)  # odd, so invertible modulo 2**64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Separators are blanks and controls \x09-\x0D only.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 9, 10, 11, 12, 13]] = False
#: Separators are all ASCII characters but digits and (lower-case) letters.
ALNUM = np.ones(256, bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False
#: As ALNUM, and digits separate too.
LETTERS = ALNUM.copy()
LETTERS[0x30:0x3A] = False

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0..n and their inverses; kept between batches."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        inverse = _U(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
            up[0] = down[0] = 1
            np.cumprod(up, out=up)
            np.cumprod(down, out=down)
        _powers[int(base)] = have = (up, down)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their n + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``most`` bytes of text, one row at least."""
    at = flat(batch.column(column))[1]
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans come by start."""
    if len(raw) <= CHUNK_BYTES:
        return _span_hashes(raw, start, end)
    out = np.empty(len(start), np.uint64)  # a hash doesn't depend on the span's place, so long texts go chunk by chunk
    cuts = np.r_[np.searchsorted(start, np.arange(0, len(raw), CHUNK_BYTES)), len(start)]
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if low < high:
            base = int(start[low])
            out[low:high] = _span_hashes(raw[base:int(end[low:high].max())], start[low:high] - base, end[low:high] - base)
    return out


def _span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _power(_P, len(raw))
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + _U(1)) * up[:len(raw)], out=total[1:])
        return mix((total[end] - total[start]) * down[start])


class Words:
    """The words of a chunk of texts."""

    def __init__(self, texts: pa.Array, is_word: np.ndarray):
        raw, self.at = flat(texts)
        self.raw = LOWER[raw]
        n = len(raw)
        inside = is_word[self.raw]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cut = self.at[:-1][self.at[:-1] < n]
        before[cut] = False
        after[cut[cut > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        #: word numbers of text i: first[i] .. first[i + 1] - 1
        self.first = np.searchsorted(self.start, self.at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.raw, self.start, self.end)

    def text(self, word: int) -> bytes:
        return self.raw[self.start[word]:self.end[word]].tobytes()

    def joined(self, word: int, n: int) -> bytes:
        return b" ".join(self.text(w) for w in range(word, word + n))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 places are missing."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    if len(hashes) <= CHUNK_BYTES + n:
        return _window_hashes(hashes, n)
    return np.concatenate([_window_hashes(hashes[low:low + CHUNK_BYTES + n - 1], n) for low in range(0, len(hashes) - n + 1, CHUNK_BYTES)])


def _window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    up, down = _power(_Q, len(hashes))
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[:len(hashes)], out=total[1:])
        return mix((total[n:] - total[:-n]) * down[:len(hashes) - n + 1] + _U(n))


def whole_windows(words: Words, n: int) -> np.ndarray:
    """Numbers of the words from which n words of the same text go on."""
    last = words.first[1:][words.doc] - n
    return np.flatnonzero(np.arange(len(words.doc)) <= last)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted different values; sorting beats numpy's hashing unique by far."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def by_doc(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by text number, then value: a fast sort, then a radix sort of small integers."""
    order = np.argsort(value)
    small = doc[order].astype(np.uint16) if not len(doc) or doc.max() < 1 << 16 else doc[order]
    return order[np.argsort(small, kind="stable")]


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each text's distinct n-word shingles, by text and hash.

    A text of fewer words, but not none, has its whole sequence as one.
    """
    hashes = words.hashes()
    at = whole_windows(words, n)
    doc, value = words.doc[at], window_hashes(hashes, n)[at] if len(at) else np.zeros(0, np.uint64)
    for short in range(1, n):
        own = np.flatnonzero(words.count == short)
        if len(own):
            doc = np.concatenate([doc, own])
            value = np.concatenate([value, window_hashes(hashes, short)[words.first[own]]])
    order = by_doc(doc, value)
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]
