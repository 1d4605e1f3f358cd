"""Best-fit packing of tokenized documents into sequences of a fixed length.

The packing proceeds in bulk-synchronous rounds, one for each piece length, longest first: all pieces of
the length seek the successor among the gaps (the smallest gap that holds them), equal claims are settled
by rank, the gaps shrink, and the next round starts; pieces without a gap open new sequences.  Pieces of
one length are interchangeable, and so are gaps of one size.  The rounds therefore run on counts: at most
one per length and gap size, a bound set by the sequence length whatever the corpus.  They leave a list of
assignments (length, ranks, sequences, place).  The pieces are ranked within their length in
parallel and look their rank up in that list.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factdim.llm.characters import SPACE, is_settled
from factdim.llm.common import ids_and_texts, settle, text_or_empty, tokenizer_at

#: White space for Python, but not for the tokenizer: texts with these are not split beforehand.
ODD = "\x1c\x1d\x1e\x1f"

# Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for 256, 257, ...
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}

# Fixed value: the split pattern of the tokenizer with word ends, applied to lower-case words.
PART = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
PART_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")

#: Distinct words of a generation a worker remembers with their ids (about 150 MB); it keeps two generations.
CACHE_WORDS = 800_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, salt int"


class Generation(dict):
    """Ids of words by word; a missing word comes from the generation before or is worked out."""

    def __init__(self, work_out: Callable[[str], bytes], before: dict[str, bytes]) -> None:
        self.work_out = work_out
        self.before = before

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.work_out(word)
        self[word] = ids
        return ids


class WordIds:
    """Ids of a text as little-endian bytes; a distinct word goes through the tokenizer once in a while.

    The tokenizer drops white space and never joins what it parts, so the ids of a text are those of
    its words, one after another.  Words that are still in use survive a change of generation.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer_at(path)
        self.merge = self.tokenizer.model.tokenize
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.has_special = re.compile("|".join(special) or "(?!)").search
        self.known = Generation(self._ids, {})
        self.short: dict[str, bytes] = {}  # ids of single characters: marks and digits

    def _ids(self, word: str) -> bytes:
        """The library's steps for one word: compose, lower, split, merge; or the library itself."""
        if word.isascii():
            parts = PART_ASCII.findall(word.lower())
        elif is_settled(word):
            # the library lowers letter by letter, without the final form of sigma
            parts = PART.findall(unicodedata.normalize("NFC", word).replace("\u03a3", "\u03c3").lower())
        else:
            parts = None
        if parts is None or self.has_special(word):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        data = b""
        for part in parts:
            ids = self.short.get(part)
            if ids is None:
                letters = part
                if not (part.isascii() and part.isprintable()):
                    letters = part.encode().decode("latin-1").translate(BYTE_LETTERS)
                ids = array("I", [t.id for t in self.merge(letters)]).tobytes()
                if len(part) == 1:
                    self.short[part] = ids
            data += ids
        return data

    def __call__(self, text: str) -> bytes:
        words = [text] if any(c in text for c in ODD) else text.split()
        out = []
        for at in range(0, len(words), CACHE_WORDS):
            if len(self.known) > CACHE_WORDS:
                self.known.before = {}
                self.known = Generation(self._ids, self.known)
            out += map(self.known.__getitem__, words[at : at + CACHE_WORDS])
        return b"".join(out)


def document_pieces(docs: DataFrame, tokenizer_path: str, size: int, end_id: int, salts: int) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, salt (spreads equal lengths)."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for ids, texts in ids_and_texts(batches):
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                data = ids_of(text) + end
                for k, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    crc = zlib.crc32(part)
                    rows.append((doc_id, k, at // 4, len(part) // 4, crc, (crc ^ (doc_id or 0)) % salts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[c] for r in rows], kind)
                    for c, kind in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
            )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(pieces, PIECE_SCHEMA)


def best_fit_rounds(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int]]:
    """Assignments (length, first rank, first sequence, offset), sorted by length and rank.

    ``counts`` holds the number of pieces of each length.  A run of ranks ends where the next one of
    its length begins; rank r of a run lies in sequence first sequence + (r - first rank).
    """
    runs: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size -> [(first sequence, number)]
    sizes: list[int] = []  # the gap sizes there are, ascending
    opened = 0

    def add(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:  # a superstep: the pieces left over claim the successor gap, or new sequences
            k = bisect.bisect_left(sizes, length)
            if k < len(sizes):
                gap = sizes[k]
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(k)
            else:
                gap, first, number = size, opened, -(-left // (size // length))
                opened += number
            width = min(number, -(-left // (gap // length)))
            add(gap, first + width, number - width)
            while gap >= length and left:  # layers of one piece for each of the sequences claimed
                n = min(width, left)
                runs.append((length, rank, first, size - gap))
                add(gap, first + n, width - n)
                rank, left, width, gap = rank + n, left - n, n, gap - length
            add(gap, first, width)
    return sorted(runs)


def pack_sequences(
    docs: DataFrame, tokenizer_path: str, size: int = 4096, end_id: int = 1, rows_per_salt: int = 1_000_000
) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; longer ones than ``size`` are cut into pieces of
    ``size`` tokens, the last may be shorter.  The pieces of a sequence lie gapless from offset 0.  A null
    or empty text is the end id alone.  Every row is a document of its own, repeated rows and null ids
    too.  Other columns are ignored; an empty table gives no rows.

    Pieces of one length are dealt into salts of about ``rows_per_salt`` rows at most, ranked inside a
    salt and shifted by the salts before, so that a frequent length is not ranked in one task.
    """
    spark = docs.sparkSession
    salts = 16 + docs.count() // rows_per_salt
    pieces = settle(document_pieces(docs, tokenizer_path, size, end_id, salts), "pieces")
    dealt = pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("_n"))
    counts = {r.length: r.n for r in dealt.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = np.array(best_fit_rounds(counts, size), np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast((runs[:, 0] << 44 | runs[:, 1], runs[:, 1:]))

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.select("length", "salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("_row", F.row_number().over(inside))
        .join(shifts, ["length", "salt"])
        .withColumn("_rank", F.col("_shift") + F.col("_row") - 1)
        .select("doc_id", "piece", "start", "length", "ids_crc32", "_rank")
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, found = shared.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            run = found[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 1] + rank - run[:, 0]), pa.array(run[:, 2])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
