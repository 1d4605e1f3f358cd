"""Near-duplicate documents: MinHash signatures joined by a multi-index over their chunks.

A document's signature has ``SYMBOLS`` values of 16 bits.  Two signatures that differ in at most
``CHUNKS * (ERRORS + 1) - 1`` values have, by pigeonhole, a chunk in which they differ in at most ``ERRORS``
values.  A chunk is therefore indexed under each choice of ``ERRORS`` values to leave out, and all pairs within
the distance share a key.  Candidates are confirmed on the full shingle sets.

Only links that matter for the groups are confirmed: first every member of a key with the key's leader,
then, inside the tasks, all pairs within the distance that are still in different groups.  No link between
different groups can be missed, and the pairs of a group of copies never leave a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factdim.llm.common import settle, text_or_empty
from factdim.llm.graph import connected_components
from factdim.llm.shingles import mix64, shingle_sets

SYMBOLS, CHUNKS, ERRORS = 64, 16, 1
CHUNK = SYMBOLS // CHUNKS
#: All pairs within this signature distance are found.  At similarity 0.75 the distance is 16 on average,
#: with a deviation of 3.5: one in 100 000 pairs lies beyond.
MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Rows of a key that meet in one task; a larger key is cut into blocks that meet pairwise.
BLOCK_ROWS = 4096
#: Bytes of text turned into shingles at a time.
TEXT_BYTES = 1 << 21

_RANDOM = np.random.default_rng(75)
_FACTOR = _RANDOM.integers(1, 2**63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
_SHIFT = _RANDOM.integers(0, 2**63, SYMBOLS, dtype=np.uint64)


def signatures(shingles: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """MinHash values, the low 16 bits of the smallest 32-bit hash; texts without shingles get zeros."""
    out = np.zeros((len(begins) - 1, SYMBOLS), np.uint16)
    full = np.flatnonzero(np.diff(begins))
    if len(full):
        at = begins[full]
        for k in range(SYMBOLS):
            hashed = ((shingles * _FACTOR[k] + _SHIFT[k]) >> np.uint64(32)).astype(np.uint32)
            out[full, k] = np.minimum.reduceat(hashed, at) & np.uint32(0xFFFF)
    return out


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """The keys of each signature: chunk and left-out place in the high bits, the other values below."""
    parts = signature.reshape(len(signature), CHUNKS, CHUNK).astype(np.int64)
    keys = []
    for left_out in range(CHUNK):
        key = (np.arange(CHUNKS, dtype=np.int64) * CHUNK + left_out) << 48
        for place, k in enumerate(k for k in range(CHUNK) if k != left_out):
            key = key | parts[:, :, k] << (16 * place)
        keys.append(key)
    return np.concatenate(keys, 1)


def _grouped_texts(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[list[list], list[bytes]]]:
    """Values of ``columns`` and texts as bytes, a few megabytes of text at a time."""
    rows: list[tuple] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        named = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
        text = batch.column(batch.schema.get_field_index("text"))
        for i, row in enumerate(zip(*named, strict=True)):
            rows.append(row)
            texts.append(text[i].as_buffer().to_pybytes())
            size += len(texts[-1])
            if size >= TEXT_BYTES or len(texts) == 2000:
                yield list(map(list, zip(*rows, strict=True))), texts
                rows, texts, size = [], [], 0
    if rows:
        yield list(map(list, zip(*rows, strict=True))), texts


def _sketch(words: int):
    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), texts in _grouped_texts(batches, "doc_id"):
            shingles, begins = shingle_sets(texts, words)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(shingles ^ np.uint64(c)))]) for c in (17, 71)]
            low, high = ((s[begins[1:]] - s[begins[:-1]]).astype(np.int64) for s in sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(np.diff(begins).astype(np.int64)),
                    pa.array(low),
                    pa.array(high),
                    pa.array([s.tobytes() for s in signatures(shingles, begins)], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_id", "check", "signature"],
            )

    return sketch


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            signature = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            keys = chunk_keys(signature)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1])), pa.array(keys.ravel())],
                ["set_id", "key"],
            )


def _sets(words: int):
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (wanted,), texts in _grouped_texts(batches, "set_id"):
            shingles, begins = shingle_sets(texts, words)
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(shingles ^ np.uint64(17)))])
            own = (total[begins[1:]] - total[begins[:-1]]).astype(np.int64)
            rows = np.flatnonzero(own == np.array(wanted, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[rows]),
                    pa.array([shingles[begins[r] : begins[r + 1]].astype(np.int64) for r in rows], pa.list_(pa.int64())),
                ],
                ["set_id", "shingles"],
            )

    return sets


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures are within the distance."""
    for batch in batches:
        if batch.num_rows:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SYMBOLS) for c in (2, 3))
            near = pa.array((left != right).sum(1) <= MAX_DISTANCE)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each (key, i, j), which come sorted; a run may go on in the next batch."""
    held = None
    for batch in batches:
        batch = batch if held is None else pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        key, i, j = (batch.column(c).to_numpy() for c in range(3))
        new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
        held = batch.slice(cuts[-1])
    if held is not None:
        yield held


class _Run:
    """The members of one key, or of two of its blocks."""

    def __init__(self, rows: pa.RecordBatch) -> None:
        self.place = rows.column(0)[0].as_py() >> 48
        self.ids, self.label, self.size = (rows.column(c).to_numpy() for c in (3, 4, 5))
        self.signature = np.frombuffer(b"".join(rows.column(6).to_pylist()), np.uint16).reshape(-1, SYMBOLS)

    def partners(self, i: int, label: np.ndarray) -> np.ndarray:
        """Later members in other groups within the distance of member ``i``, whose first common key is this."""
        size = self.size[i]
        rest = slice(i + 1, None)
        likely = (label[rest] != label[i]) & (4 * np.minimum(self.size[rest], size) >= 3 * np.maximum(self.size[rest], size))
        others = np.flatnonzero(likely) + i + 1
        if len(others):
            same = self.signature[others] == self.signature[i]
            near = same.sum(1) >= SYMBOLS - MAX_DISTANCE
            others, same = others[near], same[near].reshape(-1, CHUNKS, CHUNK)
            agree = same.sum(2)
            chunk = np.argmax(agree >= CHUNK - ERRORS, 1)
            rows = np.arange(len(others))
            left_out = np.where(agree[rows, chunk] == CHUNK, 0, np.argmin(same[rows, chunk], 1))
            others = others[chunk * CHUNK + left_out == self.place]
        return others


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a key that have a candidate partner there."""
    for rows in _runs(batches):
        run = _Run(rows)
        wanted = np.zeros(len(run.ids), bool)
        for i in range(len(run.ids) - 1):
            if len(others := run.partners(i, run.label)):
                wanted[i] = wanted[others] = True
        if wanted.any():
            yield rows.filter(pa.array(wanted))


def _links(percent: int):
    def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Confirmed links between members of different groups; linked groups become one on the way."""
        for rows in _runs(batches):
            run = _Run(rows)
            label, found = run.label.copy(), []
            lists = rows.column(7)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)  # ascending as unsigned
            for i in range(len(run.ids) - 1):
                others = run.partners(i, label)
                if not len(others):
                    continue
                sets = [flat[ends[k] : ends[k + 1]] for k in others]
                own = flat[ends[i] : ends[i + 1]]
                other = np.concatenate(sets)
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                sizes = np.array([len(x) for x in sets])
                both = np.add.reduceat((own[at] == other).astype(np.int64), np.cumsum(sizes) - sizes)
                for k in others[100 * both >= percent * (len(own) + sizes - both)]:
                    if label[k] != label[i]:
                        found.append((run.ids[i], run.ids[k]))
                        label[label == label[k]] = label[i]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("_both", both)
        .where(100 * F.col("_both") >= percent * (F.size("_x") + F.size("_y") - F.col("_both")))
        .select("a", "b")
    )


def _cross_links(grouped: DataFrame, sketches: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between members of a key that are still in different groups.

    Signatures go to the keys first, full sets only to the members left with a candidate.  A pair with
    several keys in common is looked at under the first, and only confirmed pairs leave the task.
    """
    labelled = grouped.select("key", "set_id").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "set_id"))
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("_low"), F.max("label").alias("_high"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_low") != F.col("_high"))
        .select("key", F.ceil(F.col("_n") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(F.col("block"), other).alias("i"), F.greatest(F.col("block"), other).alias("j")),
    )
    columns = "key long, i int, j int, set_id long, label long, n_shingles long, signature binary"
    rows = (
        labelled.join(mixed, "key")
        .withColumn("block", block)
        .withColumn("meet", F.explode(meets))
        .join(sketches.select("set_id", "n_shingles", "signature"), "set_id")
        .select("key", F.col("meet.i").alias("i"), F.col("meet.j").alias("j"), "set_id", "label", "n_shingles", "signature")
    )
    left = (
        rows.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "set_id")
        .mapInArrow(_candidates, columns)
    )
    return (
        left.join(sets, "set_id")
        .select("key", "i", "j", "set_id", "label", "n_shingles", "signature", "shingles")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "set_id")
        .mapInArrow(_links(percent), "a long, b long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """Groups of documents with similar shingle sets: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``words``-word
    shingles (see :func:`factdim.llm.shingles.shingle_sets`).  component_id is the smallest doc_id
    reachable by links, kept tells whether it is the document's own.  A document without words or text has
    no shingles and is linked with nothing, nor is a row without doc_id, which is kept and has no
    component_id.  Every row gives a row; rows that share a doc_id count as documents of their own.  Other
    columns are ignored; an empty table gives no rows.  ``percent`` must not be under 75: the signature
    distance is made for that similarity.
    """
    if percent < 75:
        raise ValueError("the signature distance covers similarities from 75 %")
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    sketched = settle(
        texts.mapInArrow(_sketch(words), "doc_id long, n_shingles long, set_id long, check long, signature binary"),
        "sketches",
    )
    sketches = settle(
        sketched.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("set_id", "check", "n_shingles")
        .agg(F.min("doc_id").alias("first_doc"), F.min("signature").alias("signature")),
        "sets",
    )
    # a set of fewer than 3 shingles is as similar as 0.75 to itself only
    keys = settle(sketches.where(F.col("n_shingles") > 2).select("set_id", "signature").mapInArrow(_keys, "set_id long, key long"), "keys")
    leaders = keys.groupBy("key").agg(F.min("set_id").alias("leader"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    grouped = settle(keys.join(leaders.drop("_n"), "key"), "shared-keys")

    members = grouped.select("set_id").distinct().join(sketches.select("set_id", "first_doc"), "set_id")
    sets = settle(
        texts.join(members, texts["doc_id"] == members["first_doc"])
        .select("set_id", "text")
        .mapInArrow(_sets(words), "set_id long, shingles array<long>")
        .dropDuplicates(["set_id"]),
        "shingle-sets",
    )

    signature = sketches.select("set_id", "signature")
    led = (
        grouped.where(F.col("set_id") != F.col("leader"))
        .select(F.col("leader").alias("a"), F.col("set_id").alias("b"))
        .distinct()
        .join(signature.select(F.col("set_id").alias("a"), F.col("signature").alias("x")), "a")
        .join(signature.select(F.col("set_id").alias("b"), F.col("signature").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(_near, "a long, b long")
    )
    links = settle(_confirmed(led, sets, percent), "links")
    labels = connected_components(links)
    found = settle(_cross_links(grouped, sketches, sets, labels, percent), "links")
    stars = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    labels = connected_components(stars.unionByName(found))

    grouped_docs = sketches.select("set_id", "first_doc").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    grouped_docs = grouped_docs.withColumn("label", F.coalesce("label", "set_id"))
    smallest = grouped_docs.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    components = grouped_docs.join(smallest, "label").select(F.col("set_id"), F.col("component_id"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        sketched.join(components, "set_id", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def without_near_duplicates(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their group; see :func:`near_duplicates`.

    Of rows that share a doc_id all stay or go together; rows without doc_id stay.  Of rows with the same
    doc_id and the same text (null ids and null texts count as the same) one stays, the smallest by its other columns.
    """
    found = near_duplicates(docs, percent, words).where(F.col("doc_id").isNotNull())
    copies = found.groupBy("doc_id").agg(F.max("kept").alias("_kept")).where(~F.col("_kept")).select("doc_id")
    copies = settle(copies, "copies")
    # rows whose id and text occur more than once are found by digest; only they move
    digest = F.xxhash64(F.col("doc_id").cast("string"), "text")
    several = settle(docs.groupBy(digest.alias("digest")).count().where(F.col("count") > 1).select("digest"), "repeated")
    first = docs.join(copies, "doc_id", "left_anti")
    marked = first.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest.alias("digest"))
    others = [F.col(f"row.`{c}`").cast("string") for c in docs.columns if c not in ("doc_id", "text")]
    one = F.min_by("row", F.struct(F.lit(0), *others)).alias("row")
    repeated = marked.join(several, "digest", "left_semi").groupBy("row.doc_id", "row.text").agg(one)
    return marked.join(several, "digest", "left_anti").select("row.*").unionByName(repeated.select("row.*"))
