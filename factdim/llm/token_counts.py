"""Token counts of texts under a byte-level BPE vocabulary.

The merges of a byte-level BPE never cross the borders of its pre-tokens.  So the tokenizer runs once
per distinct pre-token of the corpus, and the count of a document is the sum over its pre-tokens of
occurrences times pieces.  Token ids are never made for whole documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factdim.llm.characters import SPACE, is_settled
from factdim.llm.common import count_terms, ids_and_texts, largest, settle, text_or_empty, texts_of, tokenizer_at

# The split pattern of byte-level BPE, in general and for ASCII texts.
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
PRE_TOKEN_ASCII = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
    r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)

#: Texts longer than this are split lazily instead of into one list.
LONG_TEXT = 1 << 20
#: At most so many pre-tokens, each of at most HEAD_CHARS characters, are broadcast with their pieces.
HEAD_TERMS = 1 << 16
HEAD_CHARS = 48


def pre_tokens(text: str, tokenizer) -> Iterable[str]:
    """The pre-tokens of ``text`` in order."""
    if not is_settled(text):
        return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    pattern = PRE_TOKEN_ASCII if text.isascii() else PRE_TOKEN
    if len(text) <= LONG_TEXT:
        return pattern.findall(text)
    return (m.group() for m in pattern.finditer(text))


def splitter(tokenizer) -> Callable[[str], Iterable[str]]:
    """Splits a text into its pre-tokens and the added tokens in it.

    Added tokens are cut out before anything else, as the library does, and are terms of their own.
    """
    added = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    special = regex.compile("|".join(map(regex.escape, added))) if added else None

    def split(text: str) -> Iterable[str]:
        if special is None or not special.search(text):
            return pre_tokens(text, tokenizer)
        terms, at = [], 0
        for m in special.finditer(text):
            terms.extend(pre_tokens(text[at : m.start()], tokenizer))
            terms.append(m.group())
            at = m.end()
        terms.extend(pre_tokens(text[at:], tokenizer))
        return terms

    return split


def count_pieces(terms: list[str], tokenizer) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch(terms, add_special_tokens=False)]


def piece_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per distinct pre-token: term, occurrences n, pieces."""

    def count(batches):
        split = splitter(tokenizer_at(tokenizer_path))
        return count_terms(texts_of(batches), split, pa.string())

    def pieces(batches):
        tokenizer = tokenizer_at(tokenizer_path)
        for batch in batches:
            found = count_pieces(batch.column(0).to_pylist(), tokenizer)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["term", "n", "pieces"]
            )

    counted = (
        docs.select(text_or_empty().alias("text"))
        .mapInArrow(count, "term string, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
    )
    return counted.mapInArrow(pieces, "term string, n long, pieces long")


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, head_terms: int = HEAD_TERMS
) -> DataFrame:
    """Tokens per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Added tokens written out in a text count as one token, as the library does by default.  A null or
    empty text has 0 bytes and 0 tokens.  Rows that share a doc_id (null is an id too) are parts of one
    document: their figures are summed into one row.  Other columns are ignored.  An empty table gives
    no rows.

    The ``head_terms`` most frequent pre-tokens (of at most ``HEAD_CHARS`` characters, which bounds the
    broadcast) are summed where a document is split; only rarer ones are shuffled, once per document
    and pre-token, to be joined with their pieces.
    """
    spark = docs.sparkSession
    table = settle(piece_table(docs, tokenizer_path), "pieces")
    frequent = largest(table.where(F.length("term") <= HEAD_CHARS), F.col("n"), head_terms)
    head = {r.term: r.pieces for r in frequent.select("term", "pieces").collect()}
    shared = spark.sparkContext.broadcast(head)

    def split_documents(batches) -> Iterator[pa.RecordBatch]:
        known = shared.value
        split = splitter(tokenizer_at(tokenizer_path))
        for ids, texts in ids_and_texts(batches):
            n_bytes, sums, terms, numbers, ends = [], [], [], [], [0]
            for text in texts:
                total = 0
                for term, n in Counter(split(text)).items():
                    pieces = known.get(term)
                    if pieces is None:
                        terms.append(term)
                        numbers.append(n)
                    else:
                        total += pieces * n
                n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
                sums.append(total)
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.string())),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int64())),
                ],
                ["doc_id", "n_bytes", "n_tokens", "terms", "numbers"],
            )

    parts = settle(
        docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
            split_documents,
            "doc_id long, n_bytes long, n_tokens long, terms array<string>, numbers array<long>",
        ),
        "document-pieces",
    )
    rare = (
        parts.select("doc_id", F.explode(F.arrays_zip("terms", "numbers")).alias("t"))
        .select("doc_id", F.col("t.terms").alias("term"), F.col("t.numbers").alias("times"))
        .join(table.select("term", "pieces"), "term")
        .select("doc_id", F.lit(0).cast("long").alias("n_bytes"), (F.col("times") * F.col("pieces")).alias("n_tokens"))
    )
    return (
        parts.select("doc_id", "n_bytes", "n_tokens")
        .unionByName(rare)
        .groupBy("doc_id")
        .agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
