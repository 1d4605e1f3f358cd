"""Anchors: positions of a text chosen by its content, at least one in every window of a fixed length.

A window of ``window`` bytes contains ``window - GRAM + 1`` grams of ``GRAM`` bytes; its anchor is the one
with the smallest hash, the leftmost of equals.  Equal windows have equal anchors at equal places, in whatever
documents they stand.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from factdim.llm.shingles import mix64

GRAM = 24
#: Bytes looked at in one go.
BLOCK = 1 << 18


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,)).astype(np.uint64)
    n = len(data) - GRAM + 1
    mixed = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed += words[8 : 8 + n]
    mixed *= np.uint64(0xD1B54A32D192ED03)
    mixed ^= mixed >> np.uint64(31)
    mixed += words[16 : 16 + n]
    return mix64(mixed)


def _window_anchors(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of the anchor of the window at each place."""
    value = _gram_hashes(data)
    place = np.arange(len(value), dtype=np.int32)
    width, span = 1, window - GRAM + 1
    while width < span:
        step = min(width, span - width)
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.minimum(value[step:], value[:-step])
        width += step
    return value, place


def document_anchors(texts: Sequence[bytes], window: int) -> dict[str, np.ndarray]:
    """The anchors of each text: text (number), hash, first (window it serves, from 0), windows (number)."""
    out: dict[str, list[np.ndarray]] = {"text": [], "hash": [], "first": [], "windows": []}
    for number, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        n = len(data) - window + 1
        for at in range(0, n, BLOCK):
            value, place = _window_anchors(data[at : at + BLOCK + window - 1], window)
            new = np.flatnonzero(np.diff(place, prepend=-1))
            out["text"].append(np.full(len(new), number))
            out["hash"].append(value[new])
            out["first"].append(new + at)
            out["windows"].append(np.diff(new, append=len(place)))
    kinds = {"text": np.int64, "hash": np.uint64, "first": np.int64, "windows": np.int64}
    return {k: np.concatenate([np.zeros(0, t), *out[k]]).astype(t) for k, t in kinds.items()}
