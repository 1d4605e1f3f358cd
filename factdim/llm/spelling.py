"""Spelling variants: words one edit apart, found by dense comparison of tiles.

A single edit leaves what stands before and behind it as it was.  So words are tiled by what they share around
a window: of a length, the edit may lie in the first, second or last third of the shorter word, and the tile is named by
the prefix and suffix outside that third.  The words of a tile are rows of padded code-point
matrices, flush left and flush right; blocks of rows are compared with each other, and where common prefix plus
common suffix reach the longer length minus one, the two are a single edit apart.  The common prefix also
tells where the edit is, which leaves every pair to exactly one tile, so that counts can be added up.

A tile that holds too many words is tiled again by halves of its window.  A window of one letter ends that: its words
differ in one or two letters, so their number is bounded by the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factdim.llm.common import FLUSH_TERMS, _count_batches, ids_and_texts, settle, text_or_empty

# Fixed value: a run of letters, A-Z lowered.
RUN = re.compile("[a-zÀ-ÿ]+")

#: Windows the shorter word of a pair is cut into at first, words of a tile that is not cut further, and
#: letters of a matrix (a tile's whole, if it has more).
WINDOWS = 3
TILE_WORDS = 1024
CELLS = 1 << 22

TILE = ("size", "low", "high", "prefix", "suffix")


def document_words(text: str, doc_id: int | None, slip: int) -> Iterator[tuple[str, int]]:
    """Runs of a text with their numbers; where ``slip`` divides the crc32 of id and run, a letter is left out."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(lowered)).items():
        if slip:
            h = zlib.crc32(run.encode(), start)
            if h % slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
        yield run, n


def word_counts(docs: DataFrame, least_length: int, least_count: int, slip: int) -> DataFrame:
    """One row per word of all texts: word, n, size (code points)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for ids, texts in ids_and_texts(batches):
            for doc_id, text in zip(ids, texts, strict=True):
                for word, n in document_words(text, doc_id, slip):
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= FLUSH_TERMS:
                    yield from _count_batches(counts, pa.string())
                    counts = Counter()
        yield from _count_batches(counts, pa.string())

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .mapInArrow(count, "term string, n long")
        .groupBy(F.col("term").alias("word"))
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
        .withColumn("size", F.length("word"))
    )


def _around(words: DataFrame, windows: Column) -> DataFrame:
    """Rows (word, n, long, tile) of words in the tiles named by ``windows``, structs of size, low, high.

    ``size`` is the length of the shorter word of a pair; ``long`` marks a word that is longer by one.
    """
    placed = words.select("word", "n", F.length("word").alias("own"), F.inline(windows))
    behind = F.col("size") - F.col("high")
    return placed.select(
        "word",
        "n",
        (F.col("own") > F.col("size")).alias("long"),
        "size",
        "low",
        "high",
        F.col("word").substr(F.lit(1), F.col("low")).alias("prefix"),
        F.col("word").substr(F.col("own") - behind + 1, behind).alias("suffix"),
    )


def _first_windows(least_length: int) -> Column:
    def of(size: Column) -> Column:
        bound = lambda k: F.floor(size * k / WINDOWS).cast("int")
        return F.array(*[
            F.struct(size.alias("size"), bound(k).alias("low"), bound(k + 1).alias("high")) for k in range(WINDOWS)
        ])

    size = F.length("word")
    return F.when(size > least_length, F.concat(of(size), of(size - 1))).otherwise(of(size))


def _halves() -> Column:
    mid = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    part = lambda a, b: F.struct(F.col("size"), a.alias("low"), b.alias("high"))
    return F.array(part(F.col("low"), mid), part(mid, F.col("high")))


def padded(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words as rows, flush left and flush right, and their lengths; the padding matches nothing twice."""
    size = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(words)), size)
    column = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    left = np.zeros((len(words), width), np.uint32)
    right = np.zeros((len(words), width), np.uint32)
    left[row, column] = points
    right[row, column + (width - size)[row]] = points
    return left, right, size


def common(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the common prefixes and suffixes of the rows ``a`` and ``b``; padding counts as equal."""
    prefix = np.argmin(np.concatenate([left[a] == left[b], np.zeros((len(a), 1), bool)], 1), 1)
    suffix = np.argmin(np.concatenate([(right[a] == right[b])[:, ::-1], np.zeros((len(a), 1), bool)], 1), 1)
    return prefix, suffix


def _pairs(
    begins: np.ndarray, shorts: np.ndarray, ends: np.ndarray, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of about ``most`` pairs (tile, row, row): every short word of a tile with the words behind it.

    A tile's rows are its short words, from ``begins``, and its long ones, from ``shorts`` to ``ends``.
    """
    tile = np.repeat(np.arange(len(begins)), shorts - begins)
    row = np.arange(len(tile)) - np.repeat(np.cumsum(shorts - begins) - (shorts - begins), shorts - begins) + begins[tile]
    others = ends[tile] - row - 1
    done = np.concatenate([[0], np.cumsum(others)])
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(done, done[at] + most, side="right")) - 1)
        n = others[at:to]
        first = np.repeat(np.arange(at, to), n)
        second = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n) + row[first] + 1
        yield tile[first], row[first], second
        at = to


def solve_tiles(
    size: np.ndarray, low: np.ndarray, high: np.ndarray, members: list[list[tuple[bool, str, int]]]
) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
    """For each word of a tile with near ones: the word, their number, and n and word of the greatest of them.

    Members are (long, word, n), the short ones first.  Ties go to the word smaller in code-point order.
    """
    words = [w for tile in members for _, w, _ in tile]
    count = np.array([n for tile in members for *_, n in tile], np.int64)
    length = np.array([len(tile) for tile in members], np.int64)
    short = np.array([sum(not is_long for is_long, *_ in tile) for tile in members], np.int64)
    ends = np.cumsum(length)
    begins = ends - length
    left, right, own = padded(words, int(size.max()) + 1)
    rank = np.empty(len(words), np.int64)  # greater n first, then code-point order
    rank[sorted(range(len(words)), key=lambda i: (-count[i], words[i]))] = np.arange(len(words))
    near = np.zeros(len(words), np.int64)
    best = np.full(len(words), len(words), np.int64)
    for tile, a, b in _pairs(begins, begins + short, ends, max(CELLS // left.shape[1], 1)):
        prefix, suffix = common(left, right, a, b)
        longer = np.maximum(own[a], own[b])
        prefix, suffix = np.minimum(prefix, own[a]), np.minimum(suffix, own[a])
        one = (prefix + suffix >= longer - 1) & ((prefix < own[a]) | (own[a] < own[b]))
        # the edit stands behind the common prefix; an edit at the very end belongs to the last window
        at = np.minimum(prefix, size[tile] - 1)
        one &= (low[tile] <= at) & (at < high[tile])
        a, b = a[one], b[one]
        near += np.bincount(a, minlength=len(words)) + np.bincount(b, minlength=len(words))
        np.minimum.at(best, a, rank[b])
        np.minimum.at(best, b, rank[a])
    found = np.flatnonzero(near)
    form = np.argsort(rank)[best[found]]
    return [words[i] for i in found], near[found], count[form], [words[i] for i in form]


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, low, high = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
        members = [[(m["long"], m["word"], m["n"]) for m in tile] for tile in batch.column(3).to_pylist()]
        # tiles of like width share a matrix
        order = np.argsort(size, kind="stable")
        cells = (size[order] + 1) * np.array([len(members[i]) for i in order], np.int64)
        for some in np.split(order, np.flatnonzero(np.diff(np.cumsum(cells) // CELLS)) + 1):
            if not len(some):
                continue
            words, near, form_n, form = solve_tiles(size[some], low[some], high[some], [members[i] for i in some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(near), pa.array(form_n), pa.array(form, pa.string())],
                ["word", "near", "form_n", "form"],
            )


def near_words(words: DataFrame, least_length: int, tile_words: int = TILE_WORDS) -> DataFrame:
    """For every word with near ones: word, n_near, and ``best`` (n, word) of the nearest in rank."""
    members = _around(words, _first_windows(least_length))
    found = None
    while members is not None:
        sizes = members.groupBy(*TILE).agg(F.count(F.lit(1)).alias("rows"))
        large = settle(
            sizes.where((F.col("rows") > tile_words) & (F.col("high") - F.col("low") > 1)).select(*TILE), "large-tiles"
        )
        again = None if large.isEmpty() else members.join(large, list(TILE), "left_semi")
        if again is not None:
            members = members.join(large, list(TILE), "left_anti")
        tiles = (
            members.groupBy(*TILE)
            .agg(F.array_sort(F.collect_list(F.struct("long", "word", "n"))).alias("members"))
            .where((F.size("members") > 1) & ~F.col("members")[0]["long"])
            .select("size", "low", "high", "members")
        )
        solved = tiles.mapInArrow(_solve, "word string, near long, form_n long, form string")
        found = solved if found is None else found.unionByName(solved)
        members = None if again is None else _around(again, _halves())
    # the greatest n, then the smallest word: the least of (-n, word)
    least = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), least.alias("best"))


def spelling_variants(
    docs: DataFrame,
    least_length: int = 5,
    least_count: int = 3,
    factor: int = 2,
    slip: int = 0,
    tile_words: int = TILE_WORDS,
) -> DataFrame:
    """Words of all texts with the form each is a variant of: word, form, root, n, n_near, form_n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, of at least ``least_length`` code points
    and ``least_count`` occurrences (n).  Two are near if one inserted, deleted or replaced code point turns
    one into the other; n_near counts a word's near words.  Its form is the near word of greatest n (ties: the
    smallest in code-point order) if that n (form_n) is ``factor`` times its own or more, else null; its root is
    where following forms ends, itself without a form.

    ``slip`` plants misspellings: where it divides h = crc32 of "<doc_id>:<run>", the code point h mod length of
    the run is left out in that document (a null id counts as the empty text).  Null and empty texts have no words.
    Every row counts, repeated rows too.  Other columns are ignored; an empty table gives no rows.
    Tiles of more than ``tile_words`` words are tiled again; the result does not depend on it.
    """
    if factor < 2:
        raise ValueError("a form must occur twice as often at least, or forms could lead in a circle")
    words = settle(word_counts(docs, least_length, least_count, slip).select("word", "n"), "words")
    near = near_words(words, least_length, tile_words)
    best_n = -F.col("best.minus")
    takes = F.col("best").isNotNull() & (best_n >= factor * F.col("n"))
    named = settle(
        words.join(near, "word", "left").select(
            "word",
            F.when(takes, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(takes, best_n).alias("form_n"),
        ),
        "forms",
    )
    # every step at least doubles n, so chains are as short as its logarithm; a round doubles the steps
    largest = named.agg(F.max("n")).first()[0] or 1
    steps = max(1, int(np.ceil(np.log(largest) / np.log(factor))) + 1)
    known = named.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(int(np.ceil(np.log2(steps))) + 1):
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        known = settle(
            known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots"
        )
    return named.join(known, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
