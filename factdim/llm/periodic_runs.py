"""Runs of periodic words, found tile by tile.

Periods are taken in octaves: 1 to 3, 4 to 7, 8 to 15, ...  For an octave a document is covered by overlapping
tiles around anchors a fixed spacing apart, each as wide as the octave needs and no wider.  A tile is solved
on its own: two Z-functions at its anchor tell, for every period of the octave, how far the words repeat
to the right and to the left of it.  What a tile tells is a fragment, an interval of places that equal the
place one period on; fragments reach from one anchor to the next, so that the fragments of a document and
period, shuffled together, are stitched to whole stretches.

Long documents are dealt out: their tiles travel in strips to other tasks.  The tiles of the others are solved where
the document is read.  Only documents in which something repeats are looked at again at the end.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factdim.llm.common import ids_and_texts, settle, text_or_empty

#: Words of a strip; documents with more words than this have their tiles solved in other tasks.
STRIP_WORDS = 1 << 18

#: The shortest run, and how often a run holds its period at least.
SHORTEST, TIMES = 6, 4


class Octave(NamedTuple):
    """Periods ``low`` to ``high`` - 1, and the spacing of their anchors (a tile reaches as far to either side).

    The places of a run that equal the place a period on are ``TIMES`` - 1 periods at least (5 for period 1),
    more than twice the spacing less one, so that all places from some anchor to the next are among them.
    """

    low: int
    high: int
    spacing: int


def octaves(n: int) -> list[Octave]:
    """The octaves with periods that can have a run in ``n`` words."""
    found, low = [], 4
    if n >= SHORTEST:
        found.append(Octave(1, 4, 2))
    while TIMES * low <= n:
        found.append(Octave(low, 2 * low, low))
        low *= 2
    return found


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the start."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve_tile(x: list[int], anchor: int, octave: Octave) -> Iterator[tuple[int, int, int]]:
    """Fragments (period, from, to) of the tile around ``anchor``; it reaches one spacing to either side.

    A fragment is given where a whole side of the tile repeats.  Periods are skipped that are multiples of
    a period the tile has as a whole: a run of theirs has the smaller period all along.
    """
    low, high, reach = octave
    first, last = max(anchor - reach, 0), min(anchor + reach + high - 1, len(x))
    tile, mid = x[first:last], anchor - first
    size = len(tile)
    whole = z_function(tile)
    smallest = next((d for d in range(1, high) if d + whole[d] == size), None) if size > high else None
    forward = z_function(tile[mid:])
    backward = z_function([*tile[:mid][::-1], -1, *tile[::-1]])
    for period in range(low, min(high, size - mid)):
        if smallest is not None and period > smallest and period % smallest == 0:
            continue
        right = min(forward[period], reach)
        left = backward[mid + 1 + size - mid - period] if mid else 0
        if right == reach or left == reach:
            yield period, anchor - left, anchor + right


def _recurring(x: np.ndarray, octave: Octave) -> np.ndarray:
    """Places, at multiples of the spacing, from which a block of that length recurs a period of the octave on.

    Blocks are told by hash, so that a tile may be solved in vain, but none is missed.
    """
    low, high, spacing = octave
    n = len(x) - spacing + 1
    if n <= low:
        return np.zeros(0, np.int64)
    block, width = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03), 1
    block ^= block >> np.uint64(32)
    base = 0x9E3779B97F4A7C15
    while width < spacing:
        block = block[:-width] * np.uint64(pow(base, width, 1 << 64)) + block[width:]
        width *= 2
    anchors = block[::spacing]
    if low == spacing:  # the periods of the octave lead into the block after the anchor's
        same = np.repeat(anchors, spacing)[: n - spacing] == block[spacing:]
        return np.unique(np.flatnonzero(same) // spacing) * spacing
    found = [np.flatnonzero(anchors[: len(block[q::spacing])] == block[q::spacing]) for q in range(low, high)]
    return np.unique(np.concatenate(found)) * spacing


def solve_strip(
    x: np.ndarray, octave: Octave, first: int, last: int, base: int = 0
) -> list[tuple[int, int, int]]:
    """Fragments of the tiles with anchors in ``first`` .. ``last`` - 1, touching ones of a period joined.

    ``x`` holds the word numbers from place ``base`` on, at least a spacing before ``first`` and as far
    beyond ``last`` as tiles reach, or to the ends of the document.
    """
    live = _recurring(x, octave)
    if not len(live):
        return []
    anchors = np.unique(np.concatenate([live, live + octave.spacing])) + base
    anchors = anchors[(anchors >= first) & (anchors < last) & (anchors < base + len(x))]
    items = x.tolist()
    joined: dict[int, list[list[int]]] = {}
    for anchor in anchors.tolist():
        for period, a, b in solve_tile(items, anchor - base, octave):
            known = joined.setdefault(period, [])
            if known and a + base <= known[-1][1]:
                known[-1][1] = max(known[-1][1], b + base)
            else:
                known.append([a + base, b + base])
    return [(period, a, b) for period, spans in joined.items() for a, b in spans]


def strips(n: int, octave: Octave, words: int) -> Iterator[tuple[int, int, int, int]]:
    """(first anchor, last anchor, from, to): the tiles of an octave in strips of about ``words`` words."""
    step = max(words // octave.spacing, 4) * octave.spacing
    for first in range(0, n, step):
        last = min(first + step, n)
        yield first, last, max(first - octave.spacing, 0), min(last + octave.spacing + octave.high, n)


def periodic_words(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, for one document in ten (by crc32 of its id) repeated from some place on; see ``periodic_runs``."""
    n = len(words)
    if doc_id is None or not n:
        return words
    group, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    start = group % n
    period = 1 + (n - start) // (3 + group % 8)
    cycle = words[start : start + period]
    return words[:start] + (cycle * -(-(n - start) // period))[: n - start]


_FRAGMENT = pa.struct([("period", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("text", pa.binary()),
        ("sha256", pa.string()),
        ("fragments", pa.list_(_FRAGMENT)),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("spacing", pa.int64()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("base", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_FRAGMENTS = "fragments array<struct<period: long, a: long, b: long>>"
FOUND = (
    f"doc_id long, digest binary, text binary, sha256 string, {_FRAGMENTS},"
    " low long, high long, spacing long, first long, last long, base long, ids binary"
)
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
    + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("runs", pa.list_(_RUN))]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _as_dicts(fragments: list[tuple[int, int, int]]) -> list[dict]:
    return [{"period": p, "a": a, "b": b} for p, a, b in fragments]


def _read(strip_words: int, plant: bool):
    """Per document its fragments and, if there are any or strips follow, its words; a strip is a row of its own."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in ids_and_texts(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(ids, texts, strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                if plant:
                    words = periodic_words(words, doc_id)
                number = {w: i for i, w in enumerate(dict.fromkeys(words))}
                x = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
                joined = b" ".join(words)
                fragments, dealt = [], False
                if len(number) < len(words):  # else nothing repeats
                    key = hashlib.blake2b(f"{doc_id} ".encode() + joined, digest_size=16).digest()
                    for octave in octaves(len(words)):
                        if len(words) <= strip_words:
                            fragments += solve_strip(x, octave, 0, len(words))
                            continue
                        dealt = True
                        for first, last, a, b in strips(len(words), octave, strip_words):
                            yield _batch([(doc_id, key, None, None, None, *octave, first, last, a, x[a:b].tobytes())], _FOUND)
                if fragments or dealt:
                    rows.append((doc_id, key, joined, None, _as_dicts(fragments), *[None] * 7))
                else:
                    rows.append((doc_id, None, None, hashlib.sha256(joined).hexdigest(), None, *[None] * 7))
            yield _batch(rows, _FOUND)

    return read


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["digest", "fragments"]
    for batch in batches:
        for row in batch.to_pylist():
            octave = Octave(row["low"], row["high"], row["spacing"])
            x = np.frombuffer(row["ids"], np.int32)
            found = solve_strip(x, octave, row["first"], row["last"], row["base"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["digest"]], pa.binary()), pa.array([_as_dicts(found)], pa.list_(_FRAGMENT))], names
            )


def smallest_periods(runs: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of maximal stretches (start, length, period) those no other covers with a smaller period, by start and period.

    A stretch that has a smaller period lies in the maximal stretch of that period.
    """
    kept: list[tuple[int, int, int]] = []
    ends: dict[int, tuple[list[int], list[int]]] = {}  # period -> starts and ends of its stretches, ascending
    for start, length, period in sorted(runs, key=lambda r: (r[2], r[0])):
        covered = False
        for smaller in _divisors(period):
            starts, lasts = ends.get(smaller, ([], []))
            at = bisect_right(starts, start) - 1
            if at >= 0 and lasts[at] >= start + length:
                covered = True
                break
        if not covered:
            kept.append((start, length, period))
        starts, lasts = ends.setdefault(period, ([], []))
        starts.append(start)
        lasts.append(start + length)
    return sorted(kept, key=lambda r: (r[0], r[2]))


def _divisors(n: int) -> Iterator[int]:
    """Proper divisors: the smaller period of a stretch of four periods and more divides the larger."""
    for d in range(1, int(n**0.5) + 1):
        if n % d == 0:
            if d < n:
                yield d
            if d != 1 and n // d != d:
                yield n // d


def report(doc_id: int | None, joined: bytes, stretches: list[tuple[int, int, int]]) -> tuple:
    """The result row of a document from its words, joined by a space, and its maximal stretches."""
    runs = smallest_periods(stretches)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    collapsed, best = joined, (None,) * 4
    if runs:
        words = joined.split(b" ")
        gone = np.zeros(len(words) + 1, np.int64)
        for s, n, p in runs:
            gone[s + p] += 1
            gone[s + n] -= 1
        collapsed = b" ".join([w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g])
        s, n, p = runs[0]
        for run in runs[1:]:  # by start, then period: only a greater one takes over
            if run[1] * p > n * run[2]:
                s, n, p = run
        best = (s, n, p, 1000 * n // p)
    hashes = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())
    return doc_id, len(runs), *best, *hashes, [{"start": s, "length": n, "period": p} for s, n, p in runs]


def _finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, found = batch.columns
        yield _batch(
            [
                report(i.as_py(), t.as_py(), [(r["start"], r["length"], r["period"]) for r in s.as_py() or []])
                for i, t, s in zip(ids, texts, found, strict=True)
            ],
            _RESULT,
        )


def periodic_runs(docs: DataFrame, plant: bool = False, strip_words: int = STRIP_WORDS) -> DataFrame:
    """The runs of periodic words of every text.

    A run is a stretch of words with smallest period p (words p apart are equal) and a length of at least
    6 words and 4 periods that no neighbouring word extends keeping the period.  Returns doc_id, n_runs, of the
    run with the greatest exact length / period (ties: smallest start, then period; nulls if there is none)
    start, length, period and exponent_milli = floor(1000 length / period), the lower-case hex SHA-256 of all
    runs (lines ``start,length,period`` by start, then period) and of the collapsed text (without the words any
    run holds after its first period, joined by one space), and the runs.

    Words are runs of characters other than ASCII white space, numbered from 0.  With ``plant``, the words
    of documents with crc32(doc_id) = 0 mod 10 repeat from word g mod n on with period 1 + (n - start) / (3 + g mod 8),
    where g is crc32 / 10; a null id's words stay.  A null or empty text has no words and no runs.  Every
    row gives a row, repeated rows and null ids too.  Other columns are ignored; an empty table gives no rows.

    Texts of more than ``strip_words`` words are solved in strips of about that many words, in tasks of their
    own; the result does not depend on it.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = settle(texts.mapInArrow(_read(strip_words, plant), FOUND), "fragments")
    dealt = (
        found.where(F.col("ids").isNotNull())
        .repartition("digest", "low", "first")
        .mapInArrow(_solve, f"digest binary, {_FRAGMENTS}")
    )
    # repeated rows give the same fragments: they are combined before the shuffle
    fragments = found.where(F.size("fragments") > 0).select("digest", "fragments").unionByName(dealt)
    fragments = fragments.select("digest", F.inline("fragments")).distinct()

    inside = Window.partitionBy("digest", "period").orderBy("a", "b")
    before = F.max("b").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("a") <= before, 0).otherwise(1)
    stretches = (
        fragments.withColumn("fresh", fresh)
        .withColumn("number", F.sum("fresh").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("digest", "period", "number")
        .agg(F.min("a").alias("start"), (F.max("b") - F.min("a") + F.col("period")).alias("length"))
        .where(F.col("length") >= F.greatest(F.lit(SHORTEST), TIMES * F.col("period")))
        .groupBy("digest")
        .agg(F.collect_list(F.struct("start", "length", "period")).alias("found"))
    )
    repeated = (
        found.where(F.col("text").isNotNull())
        .join(stretches, "digest", "left")
        .select("doc_id", "text", "found")
        .mapInArrow(_finish, RESULT)
    )
    none = F.lit(None).cast("long")
    plain = found.where(F.col("sha256").isNotNull()).select(
        "doc_id",
        F.lit(0).cast("long").alias("n_runs"),
        *[none.alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.sha2(F.lit(""), 256).alias("runs_sha256"),
        F.col("sha256").alias("collapsed_sha256"),
        F.array().cast("array<struct<start: long, length: long, period: long>>").alias("runs"),
    )
    return repeated.unionByName(plain)
