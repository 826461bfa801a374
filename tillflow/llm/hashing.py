"""Hashes of the words of many texts at once, as arrays.

A word's hash is the sum, modulo 2**64, of its bytes' values, each times a random odd weight of its place
in the word, from running sums, so that no step handles a single word in Python. (Powers of one number as
weights would let regular words collide, whatever the number.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20_240_817))
_VALUES = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z as a-z.
_VALUES[65:91] = _VALUES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_weights = [np.ones(1, np.uint64)]
#: Shingles weigh their words by these odd numbers.
_WEIGHTS = _rng.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes hashed together.
STEP = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
    return x ^ (x >> np.uint64(31))


def _weight(count: int) -> np.ndarray:
    """The weights of at least ``count`` places in a word."""
    if len(_weights[0]) < count:
        size = 1 << int(count - 1).bit_length()
        _weights[0] = mix(np.arange(1, size + 1, dtype=np.uint64) * _WEIGHTS[-1]) | np.uint64(1)
    return _weights[0]


def _words_of(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words in ``data``; a text starts at each of ``breaks``."""
    n = len(data)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[breaks] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    place = np.arange(n)
    place -= np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [n]])))
    place[space] = 0
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * _weight(int((ends - starts).max()))[place], dtype=np.uint64, out=sums[1:])
    return mix(sums[ends] - sums[starts]), starts


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z read as a-z) of a column of texts, and the text each is from."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    found, places, start = [], [], 0
    while start < len(data):
        end = min(start + STEP, len(data))
        while end < len(data):  # not inside a word
            gaps = np.flatnonzero(_SPACE[data[start:end]])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
                break
            end = min(end + STEP, len(data))
        inside = offsets[(offsets >= start) & (offsets < end)] - start
        hashes, at = _words_of(data[start:end], inside)
        found.append(hashes)
        places.append(at + start)
        start = end
    place = np.concatenate(places)
    return np.concatenate(found), np.searchsorted(offsets, place, "right") - 1


def shingles(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, and the text each is from, sorted by both.

    A shingle is ``size`` words in a row; fewer words are one shingle together.
    """
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    n = len(words)
    full = max(n - size + 1, 0)
    total = np.zeros(full, np.uint64)
    for k in range(size):
        total += words[k : k + full] * _WEIGHTS[k]
    whole = owner[: len(total)] == owner[size - 1 :][: len(total)]
    hashes, owners = mix(total[whole]), owner[: len(total)][whole]
    first = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        more = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            there = counts[short] > k
            more[there] += words[first[short[there]] + k] * _WEIGHTS[k]
        more = mix(more + counts[short].astype(np.uint64) * _WEIGHTS[size])
        places = np.searchsorted(owners, short)
        hashes, owners = np.insert(hashes, places, more), np.insert(owners, places, short)
    return distinct_sorted(hashes, owners)


def distinct_sorted(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the hashes of each owner and drops repeats; ``owners`` must not decrease."""
    ends = np.flatnonzero(np.diff(owners, append=-1)) + 1
    start = 0
    for end in ends.tolist():
        hashes[start:end].sort()
        start = end
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], owners[new]
