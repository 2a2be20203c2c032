"""Sets of word-shingle hashes, for many texts at a time in numpy.

Words are runs of bytes other than space and U+0009..U+000D, ASCII letters lower-cased. A
shingle is five words in a row; a shorter text with words is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import ODD, mix64
from .suffix_family import _groups, _prefix_hash, _text_bytes

WORDS = 5
_SEEDS = mix64(np.arange(1, WORDS + 2, dtype=np.uint64) * ODD) | np.uint64(1)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of the texts lying end to end in ``data``."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    word = (data != 32) & ((data < 9) | (data > 13))
    inner = starts[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    before = np.empty(len(data), bool)  # is the byte before a byte of the same word
    before[0] = False
    before[1:] = word[:-1]
    before[inner] = False
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[inner - 1] = False
    begins = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    total, down = _prefix_hash(low)
    h = mix64((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64))
    return h, np.searchsorted(starts, begins, side="right") - 1


def shingle_sets(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, ascending."""
    w, text = word_hashes(data, starts)
    last = len(w) - WORDS + 1
    if last > 0:
        h = w[:last] * _SEEDS[0]
        for i in range(1, WORDS):
            h += w[i:last + i] * _SEEDS[i]
        h = mix64(h)
    bounds = np.searchsorted(text, np.arange(len(starts))).tolist()
    out = []
    for i, j in zip(bounds, bounds[1:]):
        if j - i >= WORDS:
            x = np.sort(h[i:j - WORDS + 1])
            keep = np.empty(len(x), bool)
            keep[0] = True
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        elif j > i:
            x = (w[i:j] * _SEEDS[:j - i]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(x + _SEEDS[WORDS:] * np.array([j - i], dtype=np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def column_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each row of a string column (null: empty)."""
    data, bounds = _text_bytes(column)
    for i, j in _groups(bounds, 400_000):
        yield from shingle_sets(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
