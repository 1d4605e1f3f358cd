"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of a grid over a few Gaussian projections.  Neighbours that miss the
query's own cell lie in cells next to it, so a query visits the cells of a table in the order of their
estimated success (the squared distance from its projections to the cell) until they hold as many rows as
it may look at, which grow less than the table does.  The posting lists of the cells meet
queries by (table, visited cell) in an equi-join, so that a row of the join is a cell and not a pair; the
candidates of all tables are merged, dealt over slabs of rows and ranked by exact distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factdim.llm.common import first_by_hash, settle
from factdim.llm.vectors import matrix, parts, usable

#: Vectors the grid's middle and scale are taken from.  Every row is indexed.
FIT_ROWS = 16_384

#: How the rows a query looks at in a table grow with the rows n: n ** GROWTH.  On vectors without any
#: structure, the hardest case, recall fell with the square root.
GROWTH = 0.75

#: Distinct vectors of which about one posting list of a cell may name all.  More of them deal each list in parts.
POSTING_ROWS = 1 << 20


@dataclass(frozen=True)
class Grid:
    """The hash functions of vectors of one length: ``tables`` grids over ``width`` projections.

    A cell is ``cell`` times the spread of the vectors wide.  Slots farther out than ``slots`` / 2 count as the
    outermost, so that a table has at most slots ** width cells, a bound that does not depend on the rows.
    """

    tables: int
    width: int
    cell: float
    slots: int
    seed: int
    middle: np.ndarray = field(compare=False)
    spread: float

    @cached_property
    def axes(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, len(self.middle)])
        axes = rng.standard_normal((len(self.middle), self.tables * self.width))
        return axes, rng.random(self.tables * self.width) - 0.5

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Projections in units of cells: rows x tables x width."""
        axes, shift = self.axes
        with np.errstate(over="ignore", invalid="ignore"):
            found = ((vectors - self.middle) / (self.cell * self.spread)) @ axes + shift
        return np.nan_to_num(found).reshape(-1, self.tables, self.width)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Cell numbers: rows x tables."""
        half = self.slots // 2
        slot = np.clip(np.floor(self.project(vectors)), -half, half - 1).astype(np.int64) + half
        return slot @ self.slots ** np.arange(self.width)

    def visits(self, projected: np.ndarray, cells: np.ndarray, counts: np.ndarray, rows: int) -> np.ndarray:
        """Positions in ``cells`` of a table that one query visits: best first, until they hold ``rows`` rows."""
        half = self.slots // 2
        low = np.concatenate([[-np.inf], np.arange(1 - half, half)])
        high = np.concatenate([np.arange(1 - half, half), [np.inf]])
        cost = np.zeros(1)
        for x in projected:
            away = np.maximum(np.maximum(low - x, x - high), 0) ** 2
            cost = (away[:, None] + cost).ravel()
        cost = cost[cells]
        # a cell of the directory holds a row at least, so no more than ``rows`` cells are needed
        best = np.argpartition(cost, rows - 1)[:rows] if rows < len(cost) else np.arange(len(cost))
        best = best[np.lexsort((cells[best], cost[best]))]
        return best[np.cumsum(counts[best]) - counts[best] < rows]


def _spots(ids: np.ndarray) -> np.ndarray:
    """A number below 2 ** 31 for each id that deals ids evenly over slabs, however they are numbered."""
    mixed = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)).astype(np.int64)


def _fit(found: DataFrame, **shape) -> dict[int, Grid]:
    """A grid for each length of vector, around the medians of the components, as wide as their quartiles."""
    sample = first_by_hash(found, "vec_id", FIT_ROWS)
    quartiles = F.percentile_approx("x", [0.25, 0.5, 0.75], 1000)
    by: dict[int, list] = {}
    components = sample.select("dim", F.posexplode("embedding").alias("at", "x"))
    for r in components.groupBy("dim", "at").agg(quartiles.alias("q")).orderBy("dim", "at").collect():
        by.setdefault(r.dim, []).append(r.q)
    grids = {}
    for (dim,) in found.select("dim").distinct().collect():
        low, middle, high = np.array(by.get(dim, [[0.0] * 3] * dim)).T
        with np.errstate(over="ignore"):
            spread = float(np.sqrt(((high - low) ** 2).sum())) / 1.35
        grids[dim] = Grid(**shape, middle=middle, spread=spread if 0 < spread < np.inf else 1.0)
    return grids


def _hashed(rows: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    """The rows with their cell in every table and their spot."""

    def hash_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, group in batch.to_pandas().groupby("dim"):
                codes = grids[dim].codes(matrix(group["embedding"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group["vec_id"].to_numpy(), pa.int64()),
                        pa.array(np.full(len(group), dim), pa.int32()),
                        pa.array(list(group["embedding"]), pa.list_(pa.float64())),
                        pa.array(list(codes), pa.list_(pa.int64())),
                        pa.array(_spots(group["vec_id"].to_numpy()), pa.int64()),
                    ],
                    ["vec_id", "dim", "embedding", "codes", "spot"],
                )

    return rows.select("vec_id", "dim", "embedding").mapInArrow(
        hash_rows, "vec_id long, dim int, embedding array<double>, codes array<long>, spot long"
    )


def _probes(asked: DataFrame, cells: DataFrame, grids: dict[int, Grid], k: int, reach: float) -> DataFrame:
    """The cells each query visits: query_id, dim, place (table), codes, and the rows they hold."""
    directory: dict[int, list] = {}
    for r in cells.groupBy("dim", "place", "code").count().orderBy("dim", "place", "code").collect():
        by = directory.setdefault(r.dim, [[] for _ in range(grids[r.dim].tables)])
        by[r.place].append((r.code, r["count"]))
    shared = asked.sparkSession.sparkContext.broadcast(
        {d: [np.array(t, np.int64).reshape(-1, 2).T for t in by] for d, by in directory.items()}
    )

    def choose_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, group in batch.to_pandas().groupby("dim"):
                if dim not in shared.value:
                    continue
                projected = grids[dim].project(matrix(group["embedding"]))
                out = []
                for t, (codes, counts) in enumerate(shared.value[dim]):
                    rows = max(k + 1, int(np.ceil(reach * counts.sum() ** GROWTH)))
                    for q, own in enumerate(group["vec_id"]):
                        best = grids[dim].visits(projected[q, t], codes, counts, rows)
                        out.append((own, dim, t, codes[best], int(counts[best].sum())))
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64())
                names = ["query_id", "dim", "place", "codes", "n"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names
                )

    return asked.select("vec_id", "dim", "embedding").mapInArrow(
        choose_cells, "query_id long, dim int, place int, codes array<long>, n long"
    )


def candidates(
    found: DataFrame, asked: DataFrame, grid: dict, k: int, reach: float, slab_rows: int, slab_pairs: int
) -> tuple[DataFrame, DataFrame]:
    """Rows (dim, slab, vec_id, embedding), and per query and slab the rows of cells it visits, once each.

    A slab holds ``slab_rows`` rows or fewer, and about ``slab_pairs`` of the rows queries look at.
    """
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = found.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    grids = _fit(found, **grid)
    index = settle(_hashed(distinct, grids), "hashed-vectors")
    cells = index.select("vec_id", "dim", "spot", F.posexplode("codes").alias("place", "code"))
    probes = settle(_probes(asked, cells, grids, k, reach), "probes")
    looked_at = probes.agg(F.sum("n")).first()[0] or 0
    rows = index.count()
    slabs = max(parts(rows, slab_rows), parts(looked_at, slab_pairs))
    part = (F.col("spot") % parts(rows, POSTING_ROWS)).alias("part")
    postings = cells.groupBy("dim", "place", "code", part).agg(F.collect_list("vec_id").alias("ids"))
    named = (
        probes.select("query_id", "dim", "place", F.explode("codes").alias("code"))
        .join(postings, ["dim", "place", "code"])
        .groupBy("dim", "part", "query_id")
        .agg(F.flatten(F.collect_list("ids")).alias("ids"))
    )
    slab = (F.col("spot") % slabs).alias("slab")
    return index.select("vec_id", "dim", "embedding", slab), _by_slab(named, slabs)


def _by_slab(named: DataFrame, slabs: int) -> DataFrame:
    """Per query and slab the ids its posting lists name, once each and without its own: dim, slab, query_id, candidates."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        names = ["dim", "slab", "query_id", "candidates"]
        for batch in batches:
            for row in range(batch.num_rows):
                dim, query = batch["dim"][row].as_py(), batch["query_id"][row].as_py()
                ids = np.unique(batch["ids"][row].values.to_numpy())
                ids = ids[ids != query]
                slab = _spots(ids) % slabs
                met = np.unique(slab)
                out = ([dim] * len(met), met, [query] * len(met), [ids[slab == s] for s in met])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return named.select("dim", "query_id", "ids").mapInArrow(
        deal, "dim int, slab long, query_id long, candidates array<long>"
    )


def nearest(
    rows: DataFrame,
    queries: DataFrame | None = None,
    k: int = 10,
    every: int = 100,
    tables: int = 20,
    width: int = 13,
    cell: float = 0.5,
    slots: int = 2,
    reach: float = 0.2,
    seed: int = 3,
    slab_rows: int = 16_384,
    slab_pairs: int = 4_000_000,
) -> DataFrame:
    """The ``k`` nearest rows found for each query: query_id, rank (from 1), vec_id, score.

    Score is the Euclidean distance in double precision; ties go to the smaller vec_id; a query is no
    candidate of its own.  Queries are the rows whose vec_id is divisible by ``every``, or ``queries``
    (vec_id, embedding).  Vectors that are null, empty, zero or hold a null or non-finite component take no
    part, nor do null ids.  Rows that share a vec_id are one vector, the smallest.  Vectors of different
    length never meet.  Other columns are ignored; an empty table gives no rows.

    Every row is indexed, in ``tables`` tables, but of equal vectors only the ``k`` + 1 smallest ids, as no
    others can be among the nearest of a query.  In each table a query looks at ``reach`` times the rows of
    its length to the power of ``GROWTH``: more finds more.  It looks at ``k`` + 1 at least, so every query gets
    ``k`` neighbours, or all there are.  The cells' row counts (at most slots ** width a table) are the only
    thing all tasks share.  The grid's middle and spread come from ``FIT_ROWS`` vectors, the first by hash
    of their id.  Distances above half the largest double are reported as infinity.
    """
    found = settle(usable(rows, zero=False), "vectors")
    asked = found.where(F.col("vec_id") % every == 0)
    if queries is not None:
        asked = usable(queries, zero=False)
    grid = {"tables": tables, "width": width, "cell": cell, "slots": slots, "seed": seed}
    slabs, met = candidates(found, asked, grid, k, reach, slab_rows, slab_pairs)

    def measure(slab: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(slab) or not len(asking):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        slab = slab.sort_values("vec_id")
        vectors, ids = matrix(slab["embedding"]), slab["vec_id"].to_numpy()
        out = []
        for own, vector, chosen in zip(asking["query_id"], asking["vector"], asking["candidates"], strict=True):
            at = np.searchsorted(ids, np.sort(chosen))
            with np.errstate(over="ignore"):
                distance = np.sqrt(((vectors[at] - np.asarray(vector, np.float64)) ** 2).sum(1))
            if len(at) > k:
                near = distance <= np.partition(distance, k - 1)[k - 1]
                at, distance = at[near], distance[near]
            best = np.lexsort((ids[at], distance))[:k]
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[at[best]], "score": distance[best]}))
        return pd.concat(out)

    asking = met.join(asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")), "query_id")
    near = slabs.groupBy("dim", "slab").cogroup(asking.groupBy("dim", "slab")).applyInPandas(
        measure, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
