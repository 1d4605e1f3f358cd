"""Removal of repeated passages by suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id.
Equal strings have equal anchors (see ``anchors``), so the corpus is narrowed to the surroundings of anchors
that more than one document has.  These snippets are gathered by anchor, sorted by suffix, and neighbours in
that order with a common prefix of ``length`` bytes share the smallest document id.

The documents are dealt into groups of a few megabytes by hash of their id.  What travels besides their
text, once, is packed: anchor hashes by bucket, hot anchors by group, snippets by bucket, findings by group.
A group sends a snippet once, with the smallest id, however many of its documents hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factdim.llm.anchors import document_anchors
from factdim.llm.common import settle, text_or_empty
from factdim.llm.suffix_array import common_prefixes, two_stage_order

#: Bytes of text in a group of documents, and of snippets sorted at a time.
GROUP_BYTES = 4 << 20
SORT_BYTES = 4 << 20

NOTE = "key long, grp long, kind string, a binary, b binary, c binary, d binary"
RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary,"
    " spans array<struct<start: long, end: long>>"
)
_NOTE_FIELDS = [
    pa.field("key", pa.int64()),
    pa.field("grp", pa.int64()),
    pa.field("kind", pa.string()),
    *[pa.field(c, pa.binary()) for c in "abcd"],
]


def _notes(rows: list[tuple]) -> pa.Table:
    """Rows (key, grp, kind, arrays ...) as a table; missing arrays are empty."""
    full = [(*r[:3], *[x.tobytes() for x in r[3:]], *[b""] * (7 - len(r))) for r in rows]
    columns = list(zip(*full, strict=True)) or [[] for _ in _NOTE_FIELDS]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _NOTE_FIELDS, strict=True)], schema=pa.schema(_NOTE_FIELDS))


def _column(table: pa.Table, kind: str, name: str, dtype: str) -> list[np.ndarray]:
    rows = table.filter(pc.equal(table.column("kind"), kind))
    return [np.frombuffer(v.as_buffer(), dtype) for v in rows.column(name)]


def _joined(table: pa.Table, kind: str, name: str, dtype: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *_column(table, kind, name, dtype)])


class Documents:
    """The rows of a group in a fixed order, and which of them take part."""

    def __init__(self, table: pa.Table, notes: pa.Table) -> None:
        ids = table.column("doc_id").to_pylist()
        texts = [v.as_buffer().to_pybytes() for v in table.column("text")]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.order, self.ids, self.texts = order, [ids[i] for i in order], [texts[i] for i in order]
        ids = _joined(notes, "copy", "a", "<i8").tolist()
        digests = _joined(notes, "copy", "b", "V16").tolist()
        copies, copied_ids = set(zip(ids, digests, strict=True)), set(ids)
        self.copied = [
            i in copied_ids and (i, hashlib.sha256(t).digest()[:16]) in copies for i, t in zip(self.ids, self.texts, strict=True)
        ]
        self.active = np.array(
            [k for k, i in enumerate(self.ids) if i is not None and not self.copied[k]], np.int64
        )

    def anchors(self, length: int) -> dict[str, np.ndarray]:
        found = document_anchors([self.texts[k] for k in self.active], length)
        return found | {"text": self.active[found["text"]]}


def _send_anchors(length: int, buckets: int):
    """Distinct anchor hashes of a group, each once, with the mark of those several documents have."""

    def send(key, docs: pa.Table, notes: pa.Table) -> pa.Table:
        group = Documents(docs, notes)
        found = group.anchors(length)
        order = np.lexsort((found["text"], found["hash"]))
        hashes, owner = found["hash"][order], found["text"][order]
        begins = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        ends = np.concatenate([begins[1:], [len(hashes)]]).astype(np.int64)
        # one id twice is one document
        ids = np.array([i or 0 for i in group.ids], np.int64)[owner] if len(owner) else owner
        several = ids[begins] != ids[ends - 1] if len(begins) else np.zeros(0, bool)
        hashes = hashes[begins]
        bucket = (hashes >> np.uint64(20)) % np.uint64(buckets)
        rows = []
        for b in np.unique(bucket):
            own = bucket == b
            rows.append((int(b), key[0].as_py(), "anchors", hashes[own], several[own].astype(np.uint8)))
        return _notes(rows)

    return send


def _find_hot(notes: pa.Table) -> pa.Table:
    """Which anchors of each group occur in more than one document of the corpus."""
    groups = notes.column("grp").to_pylist()
    parts = _column(notes, "anchors", "a", "<u8")
    several = _column(notes, "anchors", "b", "u1")
    if not parts:
        return _notes([])
    everything = np.concatenate(parts)
    order = np.argsort(everything, kind="stable")
    run = np.cumsum(np.concatenate([[0], everything[order][1:] != everything[order][:-1]]))
    hot = (np.bincount(run) > 1) | (np.bincount(run, np.concatenate(several)[order]) > 0)
    mark = np.empty(len(everything), bool)
    mark[order] = hot[run]
    rows, at = [], 0
    for group, part in zip(groups, parts, strict=True):
        chosen = part[mark[at : at + len(part)]]
        at += len(part)
        if len(chosen):
            rows.append((group, group, "hot", chosen))
    return _notes(rows)


def _send_snippets(length: int, buckets: int):
    """Distinct surroundings of hot anchors to their buckets, and to the group itself where they stand."""

    def send(key, docs: pa.Table, notes: pa.Table) -> pa.Table:
        hot = np.sort(_joined(notes, "hot", "a", "<u8"))
        if not len(hot):
            return _notes([])
        own, group = key[0].as_py(), Documents(docs, notes)
        found = group.anchors(length)
        at = np.minimum(np.searchsorted(hot, found["hash"]), len(hot) - 1)
        found = {k: v[hot[at] == found["hash"]] for k, v in found.items()}
        numbers: dict[bytes, int] = {}
        first_id, last_id, bucket = [], [], []
        number = np.empty(len(found["text"]), np.int32)
        hashes = ((found["hash"] >> np.uint64(20)) % np.uint64(buckets)).tolist()
        places = zip(found["text"].tolist(), found["first"].tolist(), found["windows"].tolist(), hashes, strict=True)
        for e, (text, first, windows, b) in enumerate(places):
            snippet = group.texts[text][first : first + windows + length - 1]
            n = numbers.setdefault(snippet, len(numbers))
            doc_id = group.ids[text]
            if n == len(first_id):
                first_id.append(doc_id)
                last_id.append(doc_id)
                bucket.append(b)
            else:
                last_id[n] = doc_id  # documents come by ascending id
            number[e] = n
        snippets, bucket = list(numbers), np.array(bucket, np.int64)
        low = np.array(first_id, np.int64)
        alone = (low == np.array(last_id, np.int64)).astype(np.uint8)
        rows = [(buckets + own, own, "places", number, found["text"].astype(np.int32), found["first"])]
        for b in np.unique(bucket):
            mine = np.flatnonzero(bucket == b)
            sizes = np.array([len(snippets[i]) for i in mine], np.int32)
            data = np.frombuffer(b"".join([snippets[i] for i in mine]), np.uint8)
            head = np.stack([mine, low[mine], alone[mine]])
            rows.append((int(b), own, "snippets", sizes, data, head))
        return _notes(rows)

    return send


def _find_repeats(length: int):
    """Runs of windows of each snippet whose string some document has, with the smallest id."""

    def find(notes: pa.Table) -> pa.Table:
        places = notes.filter(pc.equal(notes.column("kind"), "places"))
        rest = notes.filter(pc.equal(notes.column("kind"), "snippets"))
        if not rest.num_rows:
            return places.set_column(0, _NOTE_FIELDS[0], places.column("grp"))
        groups = rest.column("grp").to_pylist()
        sizes = _column(rest, "snippets", "a", "<i4")
        heads = [h.reshape(3, -1) for h in _column(rest, "snippets", "c", "<i8")]
        data = _joined(rest, "snippets", "b", "u1")
        size = np.concatenate(sizes).astype(np.int64)
        head = np.concatenate(heads, 1)
        group = np.repeat(np.array(groups, np.int64), [len(s) for s in sizes])
        # equal snippets of different groups are sorted once
        begin = np.cumsum(size) - size
        seen: dict[bytes, int] = {}
        raw = data.tobytes()
        kind = np.array([seen.setdefault(raw[b : b + s], len(seen)) for b, s in zip(begin.tolist(), size.tolist(), strict=True)])
        low = np.full(len(seen), np.iinfo(np.int64).max)
        np.minimum.at(low, kind, head[1])
        text = np.frombuffer(b"".join(seen), np.uint8)
        own_size = np.array([len(s) for s in seen], np.int64)
        own_begin = np.cumsum(own_size) - own_size
        windows = own_size - length + 1
        window_at = np.repeat(own_begin - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        valid = np.zeros(len(text), bool)
        valid[window_at] = True
        order = two_stage_order(text, length, valid)
        same = common_prefixes(text, order, length)
        run = np.cumsum(np.concatenate([[0], ~same]))
        owner = np.repeat(np.arange(len(own_size)), windows)
        rank = np.empty(len(text), np.int64)
        rank[order] = run
        string = rank[window_at]  # number of the string at each window
        smallest = np.full(run[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, string, low[owner])
        least = smallest[string]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])])
        start = np.flatnonzero(new)
        count = np.diff(start, append=len(least))
        offset = window_at[start] - own_begin[owner[start]]
        per = np.searchsorted(owner[start], np.arange(len(own_size) + 1))
        # hand the runs to every group that holds the snippet
        repeat = (per[1:] - per[:-1])[kind]
        holder = np.repeat(np.arange(len(kind)), repeat)
        run_at = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat) + per[kind][holder]
        found = least[start][run_at]
        useful = (found < head[1][holder]) | (head[2][holder] == 0)
        holder, run_at, found = holder[useful], run_at[useful], found[useful]
        rows = []
        cuts = np.searchsorted(group[holder], np.unique(groups)) if (np.diff(group) >= 0).all() else None
        if cuts is None:
            by = np.argsort(group[holder], kind="stable")
            holder, run_at, found = holder[by], run_at[by], found[by]
            cuts = np.searchsorted(group[holder], np.unique(groups))
        for g, a, b in zip(np.unique(groups), cuts, [*cuts[1:], len(holder)], strict=True):
            if b > a:
                rows.append(
                    (int(g), int(g), "runs", head[0][holder[a:b]].astype(np.int32), offset[run_at[a:b]].astype(np.int32), count[run_at[a:b]].astype(np.int32), found[a:b])
                )
        return pa.concat_tables([_notes(rows), places.set_column(0, _NOTE_FIELDS[0], places.column("grp"))])

    return find


def _removed(group: Documents, notes: pa.Table, length: int) -> list[np.ndarray]:
    """For every document the bytes that go, as a mask."""
    begins = np.concatenate([[0], np.cumsum([len(t) for t in group.texts])])
    change = np.zeros(begins[-1] + 1, np.int32)
    number, text, first = (_joined(notes, "places", c, t) for c, t in (("a", "<i4"), ("b", "<i4"), ("c", "<i8")))
    snippet, offset, count, least = (
        _joined(notes, "runs", c, t) for c, t in (("a", "<i4"), ("b", "<i4"), ("c", "<i4"), ("d", "<i8"))
    )
    if len(snippet) and len(number):
        order = np.argsort(snippet, kind="stable")
        snippet, offset, count, least = snippet[order], offset[order], count[order], least[order]
        a, b = np.searchsorted(snippet, number), np.searchsorted(snippet, number, side="right")
        place = np.repeat(np.arange(len(number)), b - a)
        at = np.arange(len(place)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[place]
        ids = np.array([i or 0 for i in group.ids], np.int64)
        goes = ids[text[place]] > least[at]
        place, at = place[goes], at[goes]
        start = begins[text[place]] + first[place] + offset[at]
        np.add.at(change, start, 1)
        np.add.at(change, start + count[at] + (length - 1), -1)
    mask = np.cumsum(change[:-1]) > 0
    return [
        np.ones(len(t), bool) if copied and len(t) >= length else mask[a:b]
        for t, copied, a, b in zip(group.texts, group.copied, begins[:-1], begins[1:], strict=True)
    ]


def whole_characters(text: bytes, gone: np.ndarray) -> np.ndarray:
    """The mask without characters of which only a part goes."""
    data = np.frombuffer(text, np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    if not len(data) or character[0] < 0:
        return gone
    all_gone = np.bincount(character, gone) == np.bincount(character)
    return all_gone[character]


def _cut(length: int, characters: bool):
    def cut(docs: pa.Table, notes: pa.Table) -> pa.Table:
        group = Documents(docs, notes)
        rows = []
        for doc_id, text, gone in zip(group.ids, group.texts, _removed(group, notes, length), strict=True):
            if characters:
                gone = whole_characters(text, gone)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if len(edges) else text
            spans = [{"start": a, "end": b} for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True)]
            rows.append((doc_id, len(text), int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest(), kept, spans))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), span)
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        table = pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})
        if "about" in docs.column_names:
            table = table.append_column("about", docs.column("about").take(pa.array(group.order, pa.int64())))
        return table

    return cut


def remove_repeats(
    docs: DataFrame, length: int = 50, characters: bool = False, group_bytes: int = GROUP_BYTES, carry: Sequence[str] = ()
) -> DataFrame:
    """Texts without the passages that documents with smaller ids hold.

    Returns doc_id, n_bytes (UTF-8), n_removed, n_spans (maximal removed runs), kept_sha256 (lower-case hex),
    kept (the remaining bytes) and spans (start, end).  Strings are judged on the input; matches never
    cross documents.  With ``characters``, characters of which only a part would go are kept.  The columns named by
    ``carry`` come along with their row, as fields of a struct ``about``.

    A null or empty text has 0 bytes and stays as it is, as do texts of fewer than ``length`` bytes.  A row
    without doc_id takes no part and is kept whole.  Rows that share a doc_id are parts of one document:
    they take nothing from each other, and each gives a row.  Columns not in ``carry`` are ignored; an empty
    table gives no rows.  ``length`` must be at least 32, which leaves windows room for several anchors.
    """
    if length < 32:
        raise ValueError("length must be at least 32 bytes")
    about = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("about")] if carry else []
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *about)
    digests = settle(texts.select("doc_id", F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("n")), "digests")
    groups = max(1, -(-(digests.agg(F.sum("n")).first()[0] or 0) // group_bytes))
    group_of = F.pmod(F.xxhash64("doc_id"), F.lit(groups))
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = (
        digests.where(F.col("n") >= length)
        .join(first, "digest")
        .where(F.col("doc_id") > F.col("first"))
        .select("doc_id", F.unhex(F.substring("digest", 1, 32)).alias("digest"), group_of.alias("grp"))
        .distinct()
    )

    # exact copies (id and half the digest), packed by group: the whole text goes, and its strings are those
    # of the first copy; other texts of the same id are judged on their own
    def pack(key, t):
        digests = np.frombuffer(b"".join(t.column("digest").to_pylist()), "V16")
        return _notes([(key[0].as_py(), key[0].as_py(), "copy", t.column("doc_id").to_numpy(), digests)])

    copied = settle(copies.groupBy("grp").applyInArrow(pack, NOTE), "copies")

    # rows without an id take no part, so any group will do
    anywhere = F.pmod(F.xxhash64("text"), F.lit(groups))
    carried = texts.withColumn("grp", F.when(F.col("doc_id").isNull(), anywhere).otherwise(group_of))
    # every step takes the rows as they are, so that one shuffle of the texts serves them all
    meet = lambda notes: carried.groupBy("grp").cogroup(notes.groupBy("grp"))
    anchors = meet(copied).applyInArrow(_send_anchors(length, groups), NOTE)
    hot = anchors.groupBy("key").applyInArrow(_find_hot, NOTE)
    snippets = meet(copied.unionByName(hot)).applyInArrow(_send_snippets(length, groups), NOTE)
    repeats = snippets.groupBy("key").applyInArrow(_find_repeats(length), NOTE)
    notes = copied.unionByName(repeats)
    result = StructType.fromDDL(RESULT)
    if carry:
        result = result.add(texts.schema["about"])
    return meet(notes).applyInArrow(_cut(length, characters), result)
