"""Hashed byte n-grams of words, each different word of a chunk worked on once."""

from __future__ import annotations

import numpy as np

from lunchbox.llm import spans

_U = np.uint64
_BYTE = spans.mix(np.arange(1, 257, dtype=np.uint64))


def different(words: spans.Words) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each different word, and for each word which of them it is."""
    _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return first, which


def subwords(words: spans.Words, chosen: np.ndarray, sizes: tuple[int, ...], bucket_log: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``chosen``, bucket) of the chosen words and of their n-grams, with marks at both ends of a word."""
    length = words.end[chosen] - words.start[chosen]
    size = length + 2
    offset = np.r_[0, np.cumsum(size)]
    marked = np.empty(offset[-1], np.uint8)
    marked[offset[:-1]], marked[offset[1:] - 1] = ord("<"), ord(">")
    inner = np.arange(length.sum()) - np.repeat(np.r_[0, np.cumsum(length)][:-1], length)
    marked[np.repeat(offset[:-1] + 1, length) + inner] = words.raw[np.repeat(words.start[chosen], length) + inner]
    owner = np.repeat(np.arange(len(chosen), dtype=np.int32), size)
    place = np.arange(len(marked)) - offset[owner]
    values = _BYTE[marked]
    bucket = lambda hashes: (hashes >> _U(64 - bucket_log)).astype(np.int32)
    owners, buckets = [np.arange(len(chosen), dtype=np.int32)], [bucket(words.hashes()[chosen])]
    for n in sizes:
        at = np.flatnonzero(place + n <= size[owner])
        owners.append(owner[at])
        buckets.append(bucket(spans.window_hashes(values, n)[at] if len(at) else np.zeros(0, np.uint64)))
    return np.concatenate(owners), np.concatenate(buckets)
