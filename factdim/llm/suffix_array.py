"""Two-stage suffix sorting, to a bounded depth, in numpy.

Suffixes that start with a byte smaller than, or equal to, the next one are sorted directly.  All others
are induced: scanning the buckets of first bytes upward, each suffix found puts the one before it at the next
free place of that one's bucket, which lies further up.  A bucket is complete when the scan reaches it, so
that it is processed as a whole.
"""

from __future__ import annotations

import numpy as np


def _word(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as a number that sorts like them; ``text`` has a margin."""
    return np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))[at].astype(np.uint64)


def _sorted_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` ordered by the ``depth`` bytes from each position, rounded up to eights."""
    order = np.argsort(_word(text, at), kind="stable")
    at = at[order]
    for offset in range(8, depth, 8):
        # only runs that are equal so far are looked at further
        before = _word(text, at + (offset - 8))
        if offset == 8:
            same = before[1:] == before[:-1]
        else:
            same &= before[1:] == before[:-1]
        if not same.any():
            break
        inside = np.zeros(len(at), bool)
        inside[1:] |= same
        inside[:-1] |= same
        rows = np.flatnonzero(inside)
        run = np.cumsum(np.concatenate([[True], ~same]))[rows]
        at[rows] = at[rows][np.lexsort((_word(text, at[rows] + offset), run))]
    return at


def two_stage_order(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Positions of ``text`` (those marked in ``wanted``) ordered by at least ``depth`` bytes from each.

    ``text`` is padded with zeros for the bytes beyond its end; positions equal to that depth stand in
    any order.  Besides the wanted positions only those that induce them are sorted.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    direct = text <= padded[1 : n + 1]
    needed = np.ones(n, bool) if wanted is None else wanted.copy()
    while wanted is not None:
        more = needed[:-1] & ~direct[:-1] & ~needed[1:]
        if not more.any():
            break
        needed[1:] |= more
    sorted_at = _sorted_directly(padded, np.flatnonzero(direct & needed), depth)
    first = text[sorted_at]
    begins = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and needed[n - 1] and not direct[n - 1]:  # the last suffix is induced by the empty one
        induced[text[n - 1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        bucket = np.concatenate([*induced[byte], sorted_at[begins[byte] : begins[byte + 1]]])
        if not len(bucket):
            continue
        bucket = bucket.astype(np.int64)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > byte) & needed[before]]
        if not len(before):
            continue
        kinds = text[before]
        order = np.argsort(kinds, kind="stable")
        before, kinds = before[order], kinds[order]
        found, starts = np.unique(kinds, return_index=True)
        for kind, part in zip(found, np.split(before, starts[1:]), strict=True):
            induced[kind].append(part)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order if wanted is None else order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each position in order but the first, whether ``depth`` bytes equal those of the one before."""
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    same = np.ones(max(len(order) - 1, 0), bool)
    for offset in [*range(0, depth - 7, 8), depth - 8]:
        rows = np.flatnonzero(same)
        if not len(rows):
            break
        same[rows] = _word(padded, order[rows] + offset) == _word(padded, order[rows + 1] + offset)
    return same
