"""Words and shingles of whole texts as numpy arrays, taken straight from the
UTF-8 buffers of an Arrow batch.

A word is a maximal run of bytes other than space and 0x09-0x0D; those bytes
occur in UTF-8 only as themselves, so byte runs and code-point runs agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_WORD_MIX = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                      0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
#: Keys and multipliers of two states of a hash that have nothing in common.
_STATES = ((0x243F6A8885A308D3, 0x9E3779B97F4A7C15), (0x13198A2E03707344, 0xD1342543DE82EF95))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur's constants)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def span_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end).

    Eight bytes at a time are mixed into a keyed state that starts from the
    length; each step passes the whole state through ``mix64``, so no pattern of
    equal bytes cancels out.  The two ``state`` hashes are independent."""
    key, odd = _STATES[state]
    length = (ends - starts).astype(np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(text) + 1, "<u8", padded, strides=(1,))
    hashed = mix64(length.astype(np.uint64) * np.uint64(odd) + np.uint64(key))
    todo, done = np.arange(len(starts)), 0
    while True:
        left = length[todo] - done
        todo, left = todo[left > 0], left[left > 0]
        if not len(todo):
            return hashed
        word = eight[starts[todo] + done]
        part = left < 8
        word[part] &= (np.uint64(1) << (left[part].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        hashed[todo] = mix64((hashed[todo] ^ word) * np.uint64(odd) + np.uint64(key))
        done += 8


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool, state: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of consecutive texts, and the number of
    words before each text (len(texts) + 1 values)."""
    first = int(offsets[0])
    text = data[first:int(offsets[-1])]
    bounds = offsets - first
    if lower:
        text = _LOWER[text]
    word = _IS_WORD[text]
    if not word.any():
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(text))]
    begin[inner] = word[inner]
    starts = np.flatnonzero(begin)
    last = word.copy()
    last[:-1] &= ~word[1:] | begin[1:]
    return span_hashes(text, starts, np.flatnonzero(last) + 1, state), np.searchsorted(starts, bounds, "left")


def shingle_sets(column: pa.Array, k: int = 5, state: int = 0) -> Iterator[np.ndarray]:
    """For each text its sorted distinct k-word shingle hashes (a text of
    fewer words has one shingle of all its words, one without words none);
    A-Z are lower-cased.  ``state`` 1 gives hashes independent of those of 0."""
    data, offsets = utf8_buffers(column)
    mixes = np.resize(np.roll(_WORD_MIX, state), k) * np.arange(1, 2 * k, 2, dtype=np.uint64)
    for i, j in slices(offsets):
        words, counts = word_hashes(data, offsets[i:j + 1], True, state)
        if len(words) >= k:
            acc = words[:len(words) - k + 1] * mixes[0]
            for d in range(1, k):
                acc = acc + words[d:len(words) - k + 1 + d] * mixes[d]
            acc = mix64(acc)
        for a, b in zip(counts[:-1].tolist(), counts[1:].tolist()):
            if b - a >= k:
                yield np.unique(acc[a:b - k + 1])
            elif b > a:
                short = (words[a:b] * mixes[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield mix64(np.array([short], dtype=np.uint64))
            else:
                yield np.zeros(0, np.uint64)
