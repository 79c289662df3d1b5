"""Hashes of the words of many texts at once, from Arrow's buffers.

A word is a run of letters, digits and bytes beyond ASCII, or a run of ASCII
marks; white space parts words (by ``SPACED``, it alone). A-Z count as a-z. The hash of a word is the
mix of a polynomial of its bytes modulo 2**64, read off running sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes worked on at a time
BASE = np.uint64(0x100000001B3)
INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))

_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
for _span in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    _KIND[_span] = 1
SPACED = np.minimum(_KIND, 1)
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            table = np.full(n, base)
            table[0] = 1
            _powers[i] = np.cumprod(table)
    return _powers


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array without nulls, and where each text starts and the last ends."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def words(texts: pa.Array, kinds: np.ndarray = _KIND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word of the texts: its hash, the number of its text, its start in the bytes of all texts.

    ``kinds`` has the kind of each byte, 0 for white space.
    """
    data, at = buffers(texts)
    hashes, starts, pos = [], [], 0
    while pos < len(data):
        end = pos + CHUNK
        while end < len(data) and kinds[data[end]]:  # a word is never cut
            more = np.flatnonzero(kinds[data[end : end + 4096]] == 0)
            end += int(more[0]) if len(more) else 4096
        d = data[pos:end]
        kind = kinds[d]
        new = np.empty(len(d), bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        inside = at[np.searchsorted(at, pos, "right") : np.searchsorted(at, pos + len(d), "left")]
        new[inside - pos] = True
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(d))
        real = kind[first] != 0
        first, last = first[real], last[real]
        power, inverse = _power_tables(len(d))
        sums = np.zeros(len(d) + 1, np.uint64)
        np.cumsum(_LOWER[d] * power[: len(d)], out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * inverse[first]))
        starts.append(first + pos)
        pos += len(d)
    if not starts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(at, start, "right") - 1, start


def pairs(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of two words that follow each other in a text, and the number of the text."""
    same = text[1:] == text[:-1]
    return mix(hashes[:-1] * BASE + hashes[1:])[same], text[1:][same]
