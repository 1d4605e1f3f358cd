"""Mixing of sources to target weights by Sainte-Lague apportionment of word blocks.

A source is dealt into shards of a few thousand documents.  The words of a shard, in seeded order, are
cut into blocks of about ``block_words`` words.  Blocks are seats: the sources get them by highest
quotient of their targets, the shards of a source by highest quotient of their words.  A shard takes
its quota as whole rounds over its blocks and the rest as a seeded choice of blocks.  Everything is
DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factdim.llm.common import settle, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"


def apportion(df: DataFrame, group: Sequence[str], keys: Sequence[str], votes: str, seats: str) -> DataFrame:
    """Add ``quota``: ``seats`` (same for all rows of a group) dealt by highest quotient votes / (2k - 1).

    ``keys`` name the rows of a group; ties go to the smaller key, null last.  The quota of a row lies
    between the roundings of its share of ``seats`` minus and plus half the rows, so only the few
    quotients between these two are compared.  Rows without votes get 0.
    """
    rows = Window.partitionBy(*group)
    total, n = F.sum(votes).over(rows), F.count(F.lit(1)).over(rows)
    share = F.coalesce(F.try_divide(F.col(votes).cast("double"), total.cast("double")), F.lit(0.0))
    bounded = (
        df.withColumn("_share", share)
        .withColumn("_n", n)
        .withColumn("_low", F.floor(F.col("_share") * F.greatest(F.lit(0.0), F.col(seats) - F.col("_n") / 2) + 0.5))
        .withColumn("_high", F.greatest("_low", F.floor(F.col("_share") * (F.col(seats) + F.col("_n") / 2 + 1) + 0.5)))
        .withColumn("_open", F.col(seats) - F.sum("_low").over(rows))
        .withColumn("_k", F.explode(F.sequence("_low", "_high")))
        .withColumn("_sure", F.col("_k") == F.col("_low"))
        .withColumn("_quotient", F.col(votes) / (2 * F.col("_k") - 1))
    )
    order = Window.partitionBy(*group).orderBy(
        F.desc("_sure"), F.desc("_quotient"), *[F.asc_nulls_last(k) for k in keys], "_k"
    )
    won = F.col("_sure") | (F.row_number().over(order) <= F.col("_open") + F.col("_n"))
    named = list(dict.fromkeys([*group, *keys]))
    others = [c for c in df.columns if c not in named]
    return (
        bounded.withColumn("_won", won)
        .groupBy(*named)
        .agg(*[F.first(c).alias(c) for c in others], F.max(F.when(F.col("_won"), F.col("_k"))).alias("quota"))
        .select(*df.columns, "quota")
    )


def source_targets(
    sizes: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), max_repeat: int = 2
) -> DataFrame:
    """source, source_size, weight, target for a table of (source, words).

    Sources in code-point order, null last, take ``weights`` in turn and share ``share`` times all
    words.  A target stops at ``max_repeat`` times the size of its source; what is above goes to the
    others by weight until none is above.  With the sources ordered by cap over weight, the common level
    that the uncapped ones reach is the largest of (what the sources before leave) / (their weights).
    The windows have no partition: they run over one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_cap = Window.orderBy("_ratio", "_place").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(by_cap), F.lit(0.0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.groupBy("source")
        .agg(F.sum("words").alias("source_size"))
        .withColumn("_place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("_cap", F.col("source_size") * float(max_repeat))
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_all", F.sum("source_size").over(everything) * float(share))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_reach", (F.col("_all") - before("_cap")) / (F.col("_weights") - before("weight")))
        .withColumn("_level", F.max("_reach").over(everything))
        .withColumn("target", F.least("_cap", F.col("weight") * F.col("_level")))
        .select("source", "source_size", "weight", "target")
    )


def _taken_in(turn: int) -> Callable[[Column], Column]:
    return lambda r: r["times"] >= turn


def mix_ranges(
    docs: DataFrame,
    share: float = 1.5,
    weights: Sequence[float] = (5, 2, 1),
    max_repeat: int = 2,
    block_words: int = 64,
    shard_docs: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """What the mix takes, as word ranges: one row per document and block of its shard.

    Columns: doc_id, source, mark (hash of id and text), size, source_size, target, shard, place (of the
    row in its shard), first (word of the document the range begins with, from 0), length, times.
    A document without words has one row of length 0.
    """
    text = text_or_empty()
    shards = max(1, -(-docs.count() // shard_docs))
    sized = settle(
        docs.select(
            F.col("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64(F.lit(seed), F.col("doc_id"), text).alias("mark"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ).withColumn("shard", F.pmod("mark", F.lit(shards))),
        "mix-sizes",
    )
    words = sized.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    targets = source_targets(words, share, weights, max_repeat)
    everything = Window.partitionBy()
    seats = F.round(F.sum("target").over(everything) / block_words).cast("long")
    sources = apportion(targets.withColumn("_seats", seats), [], ["source"], "target", "_seats")
    sources = sources.select(F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("_seats"))
    dealt = apportion(
        words.join(sources, words["source"].eqNullSafe(sources["_source"])).drop("_source"),
        ["source"],
        ["shard"],
        "words",
        "_seats",
    )
    blocks = F.greatest(F.lit(1), F.round(F.col("words") / block_words)).cast("long")
    plan = (
        dealt.withColumn("_blocks", blocks)
        .withColumn("quota", F.least("quota", max_repeat * F.col("_blocks")))
        .select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "source_size", "target", "words", "quota", "_blocks")
    )
    shard = Window.partitionBy("source", "shard")
    in_order = shard.orderBy("mark", "doc_id")
    start = lambda block: F.expr(f"({block}) * words div _blocks")
    block_of = lambda word: F.expr(f"((({word}) + 1) * _blocks - 1) div nullif(words, 0)")
    placed = (
        sized.join(plan, sized["source"].eqNullSafe(plan["_source"]) & (sized["shard"] == plan["_shard"]))
        .drop("_source", "_shard")
        .withColumn("place", F.row_number().over(in_order))
        .withColumn("_end", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_begin", F.col("_end") - F.col("size"))
        .withColumn("_from", block_of("_begin"))
        .withColumn("_to", block_of("_end - 1"))
        .withColumn("_block", F.explode_outer(F.when(F.col("size") > 0, F.sequence("_from", "_to"))))
    )
    by_seed = shard.orderBy(F.col("_block").isNull(), F.xxhash64(F.lit(seed), "shard", "_block"), "_block")
    extra = (F.dense_rank().over(by_seed) <= F.col("quota") % F.col("_blocks")).cast("long")
    first = F.greatest(F.col("_begin"), start("_block"))
    last = F.least(F.col("_end"), start("_block + 1"))
    return placed.select(
        "doc_id",
        "source",
        "mark",
        "size",
        "source_size",
        "target",
        "shard",
        "place",
        F.coalesce(first - F.col("_begin"), F.lit(0)).cast("long").alias("first"),
        F.coalesce(last - first, F.lit(0)).cast("long").alias("length"),
        F.coalesce(F.expr("quota div _blocks") + extra, F.lit(0)).cast("long").alias("times"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """Words the mix takes of each document: doc_id, size, source_size, target, taken.

    ``options`` are those of :func:`mix_ranges`.  Size is the number of words (null text: 0); a word
    taken twice counts twice; no document gives more than ``max_repeat`` times its size.  Every input row
    gives one row, repeated rows and null ids too; the choice depends on id, text and seed only, so that
    reruns agree.  A null source is a source of its own.  Documents without words give 0.  Other columns
    are ignored, an empty table gives no rows.
    """
    return (
        mix_ranges(docs, **options)
        .groupBy("source", "shard", "place")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")],
            F.sum(F.col("length") * F.col("times")).alias("taken"),
        )
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mix_texts(docs: DataFrame, max_repeat: int = 2, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row per document and round that takes words of it.

    A document taken whole keeps its text; of one taken in part the row holds the taken words, joined by
    spaces.  A document taken twice gives two rows with its doc_id.  Rows equal in id and text are
    told apart by number.
    """
    pair = Window.partitionBy("doc_id", "mark")
    seed = options.get("seed", 7)
    ranges = (
        mix_ranges(docs, max_repeat=max_repeat, **options)
        .where((F.col("times") > 0) & (F.col("length") > 0))
        .groupBy("source", "shard", "place")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "mark", "size")],
            F.array_sort(F.collect_list(F.struct("first", "length", "times"))).alias("_ranges"),
        )
        .withColumn("_copy", F.row_number().over(pair.orderBy("source", "place")))
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "_copy", F.col("size").alias("_size"), "_ranges")
    )
    own = F.xxhash64(F.lit(seed), F.col("doc_id"), text_or_empty()).alias("_own")
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own).withColumn(
        "_number", F.row_number().over(Window.partitionBy("row.doc_id", "_own").orderBy(F.asc_nulls_last("row.source")))
    )
    match = F.col("row.doc_id").eqNullSafe(ranges["_id"]) & (numbered["_own"] == ranges["_mark"]) & (numbered["_number"] == ranges["_copy"])
    rounds = []
    for j in range(1, max_repeat + 1):
        kept = F.filter("_ranges", _taken_in(j))
        count = F.aggregate(kept, F.lit(0).cast("long"), lambda n, r: n + r["length"])
        part = F.array_join(
            F.flatten(F.transform(kept, lambda r: F.slice("_words", (r["first"] + 1).cast("int"), r["length"].cast("int")))), " "
        )
        rounds.append(F.when(count == F.col("_size"), F.col("row.text")).when(count > 0, part))
    mixed = (
        numbered.join(ranges, match)
        .withColumn("_words", F.regexp_extract_all(text_or_empty("row.text"), F.lit(WORD), F.lit(0)))
        .withColumn("_text", F.explode(F.array(*rounds)))
        .where(F.col("_text").isNotNull())
    )
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return mixed.select(*[columns[c].alias(c) for c in docs.columns])
