"""From raw documents to packed training sequences: the stages in order, and all of them in one run."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factdim.llm.common import load, prepare, settle
from factdim.llm.mixing import mix_texts
from factdim.llm.near_dup import without_near_duplicates
from factdim.llm.packing import pack_sequences
from factdim.llm.suffix_dedup import remove_repeats
from factdim.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the labels of two folds in three are learned from.

    Every row is judged by its text alone (null: empty), so repeated rows stay or go together; rows without id
    are judged too and no label is theirs.
    """
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    return without_toxic(docs, labels, held_out=(3, 1), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Of rows with the same id and text one stays.  Rows without id, without words or without text are copies of
    no other document.
    """
    prepare(spark)
    return without_near_duplicates(docs, percent=75, words=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that a document with a smaller id holds are cut out of the texts.

    Characters are never cut in two.  Every row stays, if need be with an empty text (a null text becomes empty),
    with its own other columns.  Rows without id are left whole.
    """
    prepare(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = remove_repeats(docs, length=50, characters=True, carry=others)
    text = F.decode("kept", "UTF-8")
    columns = {c: F.col(f"about.`{c}`") for c in others}
    columns |= {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": text}
    if "n_chars" in others:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document may come whole, in part or twice."""
    prepare(spark)
    return mix_texts(docs, share=1.5, weights=(5, 2, 1), max_repeat=2)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    prepare(spark)
    return pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), size=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_documents),
]

#: The stages learn a model and run a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``, each written as Parquet and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
