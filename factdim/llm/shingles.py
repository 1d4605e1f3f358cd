"""Word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random 64-bit number for each byte.
_BYTE = np.random.default_rng(64).integers(1, 2**63, 256, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (finalizer of splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.cumprod(np.full(n - 1, base, np.uint64))
    return out


#: Bytes hashed at a time; a longer word is hashed whole.
BLOCK = 1 << 20


def _block_hashes(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a block; a hash is a polynomial read off prefix sums."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _IS_SPACE[data], [True]]).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    terms = _BYTE[_LOWER[data] if lower else data]
    terms *= _powers(_MULTIPLIER, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    inverse = _powers(pow(_MULTIPLIER, -1, 2**64), len(data) + 1)
    return starts, mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: Sequence[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and where each text's words begin (one more entry than texts).

    Words are runs of bytes other than ASCII white space, A-Z lowered unless ``lower`` is off.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while not _IS_SPACE[data[end - 1]]:  # every text ends in a space
            gap = np.flatnonzero(_IS_SPACE[data[end : end + BLOCK]])
            end = end + int(gap[0]) + 1 if len(gap) else min(end + BLOCK, len(data))
        s, h = _block_hashes(data[at:end], lower)
        starts.append(s + at)
        hashes.append(h)
        at = end
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), begins)


def shingle_sets(texts: Sequence[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, and where each text's set begins.

    A text of fewer than ``words`` words has its whole word sequence as one shingle, a text without words
    none.
    """
    hashes, begins = word_hashes(texts)
    n = np.diff(begins)
    owner = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(hashes)) - begins[owner]
    length = np.minimum(n, words)
    shingle = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        has = (k < length[owner]) & (place + k < n[owner])
        at = np.flatnonzero(has)
        shingle[at] += hashes[at + k] * np.uint64(2 * (k * 0x1D8E4E27C47D124F + 0x632BE59BD9B4E019) % 2**64 | 1)
    keep = place <= (n - length)[owner]
    shingle, owner = mix64(shingle[keep] + length[owner[keep]].astype(np.uint64)), owner[keep]
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    shingle, owner = shingle[new], owner[new]
    return shingle, np.searchsorted(owner, np.arange(len(texts) + 1))
