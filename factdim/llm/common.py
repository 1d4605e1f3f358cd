"""Helpers the operators share: intermediate tables, word splitting, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import factdim
from factdim.session import configure, scratch_dir

#: Distinct terms a task counts in memory before it hands its counts on.
FLUSH_TERMS = 150_000


#: Rows of an Arrow batch: whole texts travel in them, and a task holds a few at a time.
ARROW_ROWS = "1000"


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the operators, and the package's source sent to the executors, once an application."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(factdim.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="factdim-")) / "factdim.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))  # the driver serves it; the temporary copy is its own
        _shipped.add(context.applicationId)
    return spark


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


@lru_cache(maxsize=2)
def tokenizer_at(path: str):
    """The tokenizer of a file, one for a worker process, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def largest(df: DataFrame, by: Column, n: int) -> DataFrame:
    """The rows with the largest values of ``by`` (positive), ``n`` at most.

    The cut is found from a histogram, 16 bins for each doubling, of which at most some thousand rows reach the
    driver; the rows of the bin that would exceed ``n`` are left out.
    """
    bin_of = F.floor(F.log2(by) * 16)
    lowest, seen = None, 0
    for found in sorted(df.groupBy(bin_of.alias("bin")).count().collect(), reverse=True):
        seen += found["count"]
        if seen > n:
            break
        lowest = found["bin"]
    return df.where(F.lit(False) if lowest is None else bin_of >= lowest)


def first_by_hash(df: DataFrame, column: str, n: int, bins: int = 4096) -> DataFrame:
    """The rows that come first by hash of ``column``, ``n`` at most; the cut is found from a histogram."""
    bin_of = F.pmod(F.xxhash64(column), F.lit(bins))
    last, seen = -1, 0
    for found in sorted(df.groupBy(bin_of.alias("bin")).count().collect()):
        seen += found["count"]
        if seen > n:
            break
        last = found["bin"]
    return df if seen <= n else df.where(bin_of <= last)


def byte_words(text: str) -> list[bytes]:
    """Words of ``text`` as UTF-8 bytes: A-Z lowered, split at ASCII white space (9-13 and 32)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def count_terms(
    texts: Iterable[str], split: Callable[[str], Iterable], kind: pa.DataType, flush: int = FLUSH_TERMS
) -> Iterator[pa.RecordBatch]:
    """Counts of the terms of ``texts``, combined in the task; a term may be handed on repeatedly."""
    counts: Counter = Counter()
    for text in texts:
        counts.update(split(text))
        if len(counts) >= flush:
            yield from _count_batches(counts, kind)
            counts = Counter()
    yield from _count_batches(counts, kind)


def _count_batches(counts: Counter, kind: pa.DataType, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    terms, numbers = list(counts), list(counts.values())
    for at in range(0, len(terms), rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms[at : at + rows], kind), pa.array(numbers[at : at + rows], pa.int64())],
            ["term", "n"],
        )


def texts_of(batches: Iterable[pa.RecordBatch], name: str = "text") -> Iterator[str]:
    """The texts of a column one by one, so that few are Python strings at a time."""
    for batch in batches:
        for value in batch.column(batch.schema.get_field_index(name)):
            yield value.as_py()


def ids_and_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, Iterator[str]]]:
    """Per batch the values of doc_id, and the texts one by one."""
    for batch in batches:
        yield batch.column(batch.schema.get_field_index("doc_id")).to_pylist(), texts_of([batch])
