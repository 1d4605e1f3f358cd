"""Removal of word windows that an earlier document holds.

Every window of a fixed number of words has a Rabin-Karp hash.  The documents are dealt into groups of a few
megabytes by hash of their id and text.  A group sends each distinct hash once, with its smallest document
id, to the bucket of that hash; a bucket counts the groups of a hash and tells those that have only larger
ids the smallest one.  So a window that very many documents share travels once a group, and what comes back
is repeated windows only.  Each document then merges its repeated windows into maximal intervals of words.

The texts are shuffled once, for both meetings.  Hashes travel sorted and plane by plane (all first bytes, all
second bytes, ...), which the shuffle's compression shortens by the bytes neighbours have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factdim.llm.common import ids_and_texts, text_or_empty
from factdim.llm.shingles import mix64, word_hashes

#: Bytes of text in a group of documents, and of the texts whose windows share a bucket.
GROUP_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)

MESSAGE = "key long, grp long, hashes binary, ids binary"
RESULT = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary,"
    " spans array<struct<start: long, end: long>>"
)
_MESSAGE = pa.schema([("key", pa.int64()), ("grp", pa.int64()), ("hashes", pa.binary()), ("ids", pa.binary())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    + [("kept", pa.binary()), ("spans", _SPANS)]
)


def to_planes(values: np.ndarray) -> bytes:
    """64-bit numbers as eight planes of bytes, most significant first."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def window_hashes(texts: Sequence[bytes], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every window of every text, the text it stands in, and where each text's words begin.

    A window's place among all words is its own number plus ``words`` - 1 for every text before it that
    has windows; ``places`` gives it.
    """
    hashes, begins = word_hashes(texts, lower=False)
    n = max(len(hashes) - words + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(words):  # the polynomial of the words, by Horner's rule for all windows at once
        rolled = rolled * BASE + hashes[k : k + n]
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    whole = owner[:n] == owner[words - 1 :][:n]
    return mix64(rolled[whole]), np.flatnonzero(whole), begins


def _smallest(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes ascending, the smallest id of each, and the number of each entry's hash."""
    distinct, number = np.unique(hashes, return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, number, ids)
    return distinct, least, number


class Group:
    """The rows of a group in a fixed order, and their windows."""

    def __init__(self, table: pa.Table, words: int) -> None:
        rows = sorted(
            zip(table.column("doc_id").to_pylist(), (v.as_buffer().to_pybytes() for v in table.column("text")), strict=True)
        )
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.texts = [t for _, t in rows]
        self.words = words
        hashes, self.place, self.begins = window_hashes(self.texts, words)
        self.owner = self.ids[np.searchsorted(self.begins, self.place, side="right") - 1]
        self.distinct, self.least, self.number = _smallest(hashes, self.owner)

    def messages(self, key: int, buckets: int) -> pa.Table:
        """The distinct hashes by bucket, which is their range."""
        bounds = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
        cuts = np.searchsorted(self.distinct, bounds).tolist() + [len(self.distinct)]
        rows = [
            (b, key, to_planes(self.distinct[i:j]), to_planes(self.least[i:j].view(np.uint64)))
            for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False))
            if j > i
        ]
        return _table(rows, _MESSAGE)

    def cut(self, answers: pa.Table) -> pa.Table:
        """The texts without the windows that smaller ids have, here or (``answers``) elsewhere."""
        least = self.least.copy()
        for hashes, ids in zip(answers.column("hashes").to_pylist(), answers.column("ids").to_pylist(), strict=True):
            least[np.searchsorted(self.distinct, from_planes(hashes))] = from_planes(ids).view(np.int64)
        at = self.place[least[self.number] < self.owner]
        change = np.zeros(self.begins[-1] + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + self.words, -1)
        gone = np.cumsum(change[:-1]) > 0
        rows = [
            kept_row(i, t, gone[a:b])
            for i, t, a, b in zip(self.ids.tolist(), self.texts, self.begins[:-1], self.begins[1:], strict=True)
        ]
        return _table(rows, _RESULT)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def kept_row(doc_id: int | None, text: bytes, gone: np.ndarray | None) -> tuple:
    words = text.split()
    spans = []
    kept = words
    if gone is not None and gone.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).tolist()
        spans = [{"start": a, "end": b} for a, b in zip(edges[0::2], edges[1::2], strict=True)]
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    joined = b" ".join(kept)
    return doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined, spans


def _answer(messages: pa.Table) -> pa.Table:
    """To every group of a bucket: its hashes that another group has with a smaller id, and that id."""
    groups = messages.column("grp").to_pylist()
    hashes = [from_planes(h) for h in messages.column("hashes").to_pylist()]
    ids = [from_planes(i).view(np.int64) for i in messages.column("ids").to_pylist()]
    distinct, least, number = _smallest(np.concatenate(hashes), np.concatenate(ids))
    rows, at = [], 0
    for group, own, low in zip(groups, hashes, ids, strict=True):
        found = least[number[at : at + len(own)]]
        at += len(own)
        told = found < low
        if told.any():
            rows.append((group, group, to_planes(own[told]), to_planes(found[told].view(np.uint64))))
    return _table(rows, _MESSAGE)


def remove_windows(
    docs: DataFrame, words: int = 13, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Texts without the windows of ``words`` words that documents with smaller ids hold.

    Returns doc_id, n_words, n_removed, kept_sha256 (lower-case hex), kept (the remaining words joined by one
    space) and spans (maximal intervals of removed words).  Words are runs of characters other than
    ASCII white space, compared as they are.  Windows are judged on the input and never cross documents.

    A null, empty or blank text has no words and leaves the empty text; a text of fewer than ``words`` words
    stays whole.  A row without doc_id takes no part and stays whole.  Rows that share a doc_id take nothing
    from each other, and each gives a row.  Other columns, whatever their names, are ignored; an empty table
    gives no rows.

    A group holds about ``group_bytes`` of text (a longer text is a group's alone or shares it), and the
    windows of about ``bucket_bytes`` of text are counted at a time; neither changes the result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups, buckets = max(1, -(-total // group_bytes)), max(1, -(-total // bucket_bytes))
    grouped = texts.where(F.col("doc_id").isNotNull()).withColumn(
        "grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups))
    )

    def send(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return Group(rows, words).messages(key[0].as_py(), buckets)

    def cut(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return Group(rows, words).cut(answers)

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in ids_and_texts(batches):
            rows = [kept_row(i, t.encode("utf-8", "surrogatepass"), None) for i, t in zip(ids, found, strict=True)]
            yield from _table(rows, _RESULT).to_batches()

    messages = grouped.groupBy("grp").applyInArrow(send, MESSAGE)
    answers = messages.groupBy("key").applyInArrow(_answer, MESSAGE)
    kept = grouped.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(cut, RESULT)
    return kept.unionByName(texts.where(F.col("doc_id").isNull()).mapInArrow(whole, RESULT))
