"""Exact top-k by integer inner product over a bit-sliced index.

The components of every vector are quantised to integers.  A slab of rows stores, for each component
and bit, one bitmap over its rows.  A query adds the bitmaps its components call for with bitwise
carry-save adders, which leaves the scores of all rows as bit slices.  The best rows are then chosen from
the most significant slice downward; rows equal in all slices at the boundary go by vec_id.
"""

from __future__ import annotations

import operator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factdim.llm.common import settle
from factdim.llm.vectors import dealt, matrix, parts, search_slabs, usable

#: Quantised components from here on are refused: their spread would not fit into a long.
LARGEST = float(2**62)

SLAB_SCHEMA = "dim int, slab int, ids binary, low binary, bits binary, planes binary"


def pack_slab(ids: np.ndarray, values: np.ndarray) -> dict[str, bytes]:
    """Bitmaps of ``values`` (rows x components) above the smallest value of each component, by vec_id."""
    order = np.argsort(ids)
    ids, values = ids[order], values[order]
    low = values.min(0)
    above = values - low
    bits = np.array([int(m).bit_length() for m in above.max(0)], np.int64)
    words = -(-len(ids) // 64)
    planes = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, n in enumerate(bits):
        for b in range(n):
            packed = np.packbits((above[:, d] >> b & 1).astype(np.uint8), bitorder="little")
            planes[at, : len(packed)] = packed
            at += 1
    return {"ids": ids.tobytes(), "low": low.tobytes(), "bits": bits.tobytes(), "planes": planes.tobytes()}


def add_slices(by_weight: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps, ``by_weight[w]`` holding stacks of weight 2 ** w, as one bitmap per bit."""
    slices, weight = [], 0
    while weight < len(by_weight):
        stack = np.concatenate(by_weight[weight]) if by_weight[weight] else np.zeros((0, 0), np.uint64)
        carries = []
        while len(stack) > 1:
            m = len(stack) // 3
            if m:
                a, b, c = stack[:m], stack[m : 2 * m], stack[2 * m : 3 * m]
                half = a ^ b
                carries.append((a & b) | (half & c))
                stack = np.concatenate([half ^ c, stack[3 * m :]])
            else:
                carries.append((stack[:1] & stack[1:]))
                stack = stack[:1] ^ stack[1:]
        if carries:
            if weight + 1 == len(by_weight):
                by_weight.append([])
            by_weight[weight + 1].extend(carries)
        slices.append(stack[0] if len(stack) else None)
        weight += 1
    return slices


def best_rows(slices: list[np.ndarray | None], present: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the rows surely among the ``k`` best and of the equal rows at the boundary."""
    chosen, open_rows = np.zeros_like(present), present.copy()
    for bitmap in reversed(slices):
        if bitmap is None:
            continue
        ones = open_rows & bitmap
        n = int(np.bitwise_count(chosen | ones).sum())
        if n > k:
            open_rows = ones
        else:
            chosen |= ones
            open_rows &= ~bitmap
            if n == k:
                open_rows[:] = 0
                break
    return chosen, open_rows


class Slab:
    """A slab as stored, ready for queries."""

    def __init__(self, row: pd.Series) -> None:
        self.ids = np.frombuffer(row.ids, np.int64)
        self.low = np.frombuffer(row.low, np.int64)
        self.bits = np.frombuffer(row.bits, np.int64)
        self.words = -(-len(self.ids) // 64)
        self.planes = np.frombuffer(row.planes, np.uint64).reshape(-1, self.words)
        self.begin = np.concatenate([[0], np.cumsum(self.bits)])
        full = np.zeros(self.words * 8, np.uint8)
        ones = np.packbits(np.ones(len(self.ids), np.uint8), bitorder="little")
        full[: len(ones)] = ones
        self.present = full.view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list, int]:
        """Bit slices of the inner products, less a constant, and the constant."""
        wanted: dict[int, list[int]] = {}
        flips: dict[int, list[bool]] = {}
        constant = sum(map(operator.mul, query.tolist(), self.low.tolist()))  # of any size
        for d in np.flatnonzero(query):
            size, negative, n = abs(int(query[d])), query[d] < 0, int(self.bits[d])
            if negative:  # -x = (2 ** n - 1 - x) - (2 ** n - 1): add the complement
                constant -= size * ((1 << n) - 1)
            for j in range(size.bit_length()):
                if size >> j & 1:
                    for b in range(n):
                        wanted.setdefault(j + b, []).append(self.begin[d] + b)
                        flips.setdefault(j + b, []).append(negative)
        stacks: list[list[np.ndarray]] = [[] for _ in range(max(wanted, default=-1) + 1)]
        for w, planes in wanted.items():
            mask = np.where(flips[w], np.uint64(2**64 - 1), np.uint64(0))
            stacks[w].append(self.planes[planes] ^ mask[:, None])
        return add_slices(stacks), constant

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """vec_ids and exact scores of the ``k`` best rows but ``own``, in no order."""
        slices, constant = self.scores(query)
        present = self.present.copy()
        at = np.searchsorted(self.ids, own)
        if at < len(self.ids) and self.ids[at] == own:
            present[at // 64] &= ~np.uint64(1 << (int(at) % 64))
        chosen, ties = best_rows(slices, present, k)
        rows = self._rows(chosen)
        rows = np.concatenate([rows, self._rows(ties)[: k - len(rows)]])
        total = [constant] * len(rows)
        for w, bitmap in enumerate(slices):
            if bitmap is not None:
                ones = (bitmap[rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)).tolist()
                total = [t + (one << w) for t, one in zip(total, ones, strict=True)]
        if total and not -(2**63) <= min(total) <= max(total) < 2**63:
            raise OverflowError(f"a score of vector {own} exceeds a long")
        return self.ids[rows], np.array(total, np.int64)

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_inner_products(
    rows: DataFrame,
    queries: DataFrame | None = None,
    k: int = 20,
    scale: int = 64,
    every: int = 20,
    slab_rows: int = 16_384,
    chunk_queries: int = 512,
) -> DataFrame:
    """The ``k`` rows with the largest integer inner product for each query, whatever the scores' spread.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; a query is no
    candidate of its own.  Components become floor(``scale`` * x).  Queries are the rows whose vec_id
    is divisible by ``every``, or ``queries`` (vec_id, embedding).  Vectors that are null, empty or hold a
    null or non-finite component take no part, nor do null ids.  A quantised component of 2**62 or more, or a
    score among the best that exceeds a long, raises an error.  Rows that share a vec_id are one vector, the smallest.  Vectors of
    different length never meet.  Other columns are ignored; an empty table gives no rows.
    """
    too_large = F.raise_error(F.lit("a quantised component is 2**62 or more")).cast("long")
    quantised = F.transform(
        "embedding", lambda x: F.when(F.abs(x * scale) >= LARGEST, too_large).otherwise(F.floor(x * scale))
    )
    found = usable(rows, zero=True).withColumn("embedding", quantised)
    found = settle(found, "quantised")
    asked = found.where(F.col("vec_id") % every == 0)
    if queries is not None:
        asked = usable(queries, zero=True).withColumn("embedding", quantised)
    n_slabs, n_chunks = parts(found.count(), slab_rows), parts(asked.count(), chunk_queries)

    def build(key, group: pd.DataFrame) -> pd.DataFrame:
        values = np.stack([np.asarray(v, np.int64) for v in group["embedding"]])
        packed = pack_slab(group["vec_id"].to_numpy(), values)
        return pd.DataFrame([{"dim": key[0], "slab": key[1], **packed}])

    index = settle(
        found.withColumn("slab", dealt("vec_id", n_slabs)).groupBy("dim", "slab").applyInPandas(build, SLAB_SCHEMA),
        "bit-slices",
    )

    def find(slab: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        stored, out = Slab(slab.iloc[0]), []
        for own, vector in zip(chunk["vec_id"], chunk["embedding"], strict=True):
            ids, scores = stored.top(np.asarray(vector, np.int64), own, k)
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(out)

    return search_slabs(index, asked, n_slabs, n_chunks, find, k, descending=True, score_type="long")
