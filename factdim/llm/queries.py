"""The registered queries of the package, ``opN_<name>``, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factdim.llm.bit_sliced import top_inner_products
from factdim.llm.common import load
from factdim.llm.language_model import score_texts
from factdim.llm.licenses import NOTICES, PHRASES, license_labels
from factdim.llm.mixing import mix
from factdim.llm.near_dup import near_duplicates
from factdim.llm.nearest import nearest
from factdim.llm.packing import pack_sequences
from factdim.llm.periodic_runs import periodic_runs
from factdim.llm.spelling import spelling_variants
from factdim.llm.suffix_dedup import remove_repeats
from factdim.llm.token_counts import token_counts
from factdim.llm.toxicity import toxicity
from factdim.llm.window_dedup import remove_windows


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(load(spark, folder, "documents"), share=1.5, weights=(5, 2, 1), max_repeat=2)


def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(load(spark, folder, "documents"), held_out=(7, 2))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = load(spark, folder, "labels").select("doc_id", "toxic")
    scored = toxicity(load(spark, folder, "documents"), labels, held_out=(3, 1), threshold=0.7)
    return scored.withColumn("n_passages", F.size("passages")).drop("passages")


def op4_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner_products(load(spark, folder, "embeddings"), k=20, scale=64, every=20)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(load(spark, folder, "documents"), length=50).drop("kept", "spans")


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(load(spark, folder, "documents"), percent=75, words=5)


def op7_license_labels(spark: SparkSession, folder: str) -> DataFrame:
    return license_labels(load(spark, folder, "documents"))


def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(load(spark, folder, "embeddings"), k=10, every=100)


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_sequences(load(spark, folder, "documents"), path, size=4096, end_id=1)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(load(spark, folder, "documents"), path, limit=512)


def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the windows of 13 words that a smaller id has; see ``remove_windows`` for nulls, ties and repeats."""
    return remove_windows(load(spark, folder, "documents"), words=13).drop("kept", "spans")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every text, planted ones included; see ``periodic_runs`` for nulls, ties and repeats."""
    return periodic_runs(load(spark, folder, "documents"), plant=True).drop("runs")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all texts and what they are variants of; see ``spelling_variants`` for nulls, ties and repeats."""
    return spelling_variants(load(spark, folder, "documents"), least_length=5, least_count=3, factor=2, slip=97)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_language_model": op2_language_model,
    "op3_toxicity": op3_toxicity,
    "op4_bit_sliced_top_k": op4_bit_sliced_top_k,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_license_labels": op7_license_labels,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_counts": op10_token_counts,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

#: Inner products of quantised vectors, ranked.
TOP_K_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""



def _license_sql() -> str:
    """Word pairs of the texts against those of the templates; islands of diagonals by running sums."""
    grams = []
    for t, template in enumerate((*PHRASES, *NOTICES)):
        words = template.words.split()
        for i, (a, b) in enumerate(zip(words, words[1:], strict=False)):
            grams.append(f"({t}, {i}, '{a}', '{b}', {len(words) - 1}, '{template.label}', {template.phrase})")
    return f"""
WITH grams(template, spot, a, b, size, label, phrase) AS (VALUES {", ".join(grams)}),
spelt AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), pairs AS (
    SELECT doc_id, pos, w[pos + 1] AS a, w[pos + 2] AS b FROM spelt, unnest(range(len(w) - 1)) AS p(pos)
), votes AS (
    SELECT DISTINCT doc_id, template, spot, size, label, phrase, pos - spot AS diagonal
    FROM pairs JOIN grams USING (a, b)
), diagonals AS (
    SELECT doc_id, template, size, label, phrase, diagonal, count(*) AS n FROM votes GROUP BY ALL
), cut AS (
    SELECT *, CASE WHEN phrase OR diagonal - lag(diagonal) OVER w <= 3 IS NOT TRUE THEN 1 ELSE 0 END AS fresh
    FROM diagonals WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)
), numbered AS (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM cut
), spans AS (
    SELECT doc_id, template, label, phrase, span, least(1.0, sum(n) / size::DOUBLE) AS part, min(diagonal) AS start
    FROM numbered GROUP BY doc_id, template, label, phrase, size, span
), found AS (
    SELECT doc_id, start, label, part, phrase AND part = 1 AS whole, NOT phrase AND part >= 0.7 AS quoted, phrase
    FROM spans
), by_document AS (
    SELECT doc_id, count(*) FILTER (whole) AS n_base,
           min(start) FILTER (whole) AS first_word, max(start) FILTER (whole) AS last_word,
           array_to_string(list_sort(list_distinct(list(label) FILTER (whole))), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list(label) FILTER (whole OR quoted))), ',') AS labels,
           max(part) FILTER (whole OR NOT phrase) AS score
    FROM found GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM spelt s LEFT JOIN by_document b ON s.doc_id = b.doc_id
"""


#: Every window as text, and the smallest document that has it.
WINDOWS_SQL = """
WITH spelt AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, pos, array_to_string(w[pos + 1:pos + 13], ' ') AS s FROM spelt, unnest(range(len(w) - 12)) AS p(pos)
), firsts AS (
    SELECT s, min(doc_id) AS first FROM windows GROUP BY s
), gone AS (
    SELECT DISTINCT doc_id, pos + k AS spot
    FROM windows JOIN firsts USING (s), unnest(range(13)) AS t(k) WHERE first < doc_id
), words AS (
    SELECT doc_id, spot, w[spot + 1] AS word FROM spelt, unnest(range(len(w))) AS p(spot)
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY spot) AS text
    FROM words ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM spelt LEFT JOIN kept USING (doc_id)
"""


def _crc32(text: str) -> str:
    """crc32 of a text expression: byte by byte, eight shifts each."""
    octet = f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT)"
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {octet})"
    shifts = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))"
    return f"xor(list_reduce([4294967295] || {octets}, lambda a, b: {shifts}), 4294967295)"


#: Runs by definition: equal words a distance apart, islands of neighbouring places, no smaller period around.
RUNS_SQL = f"""
WITH spelt AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h
    FROM documents
), planned AS (
    SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS plant, h // 10 AS g,
           CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a
    FROM spelt
), words AS (
    SELECT doc_id, n, i, CASE WHEN plant AND i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE w[i + 1] END AS word
    FROM planned, unnest(range(n)) AS r(i)
), same AS (
    SELECT x.doc_id, y.i - x.i AS period, x.i
    FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), placed AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM same
), stretches AS (
    SELECT doc_id, period, min(i) AS start, count(*) + period AS length FROM placed GROUP BY doc_id, period, island
), long AS (
    SELECT * FROM stretches WHERE length >= greatest(6, 4 * period)
), runs AS (
    SELECT * FROM long r WHERE NOT EXISTS (
        SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.period < r.period
            AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
), best AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM planned p LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""

#: Near words by equal texts with one letter left out or replaced by a star.
SPELLING_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents WHERE text IS NOT NULL
), counted AS (
    SELECT doc_id || ':' || run AS named, run, count(*) AS n FROM runs GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {_crc32("named")} AS h FROM counted
), written AS (
    SELECT CASE WHEN h % 97 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), parts AS (
    SELECT word, substr(word, 1, i) AS before, substr(word, i + 2) AS behind FROM words, unnest(range(length(word))) AS r(i)
), near AS (
    SELECT DISTINCT a.word, b.word AS other FROM parts a JOIN parts b USING (before, behind) WHERE a.word <> b.word
      AND length(a.word) = length(b.word)
    UNION SELECT p.word, w.word FROM parts p JOIN words w ON w.word = before || behind
    UNION SELECT w.word, p.word FROM parts p JOIN words w ON w.word = before || behind
), ranked AS (
    SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
           row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place
    FROM near JOIN words ON words.word = other
), formed AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 2 * w.n THEN other END AS form,
           CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
), chains AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), ended AS (
    SELECT c.word, c.root FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ended USING (word)
"""

ORACLE_SQL: dict[str, str] = {
    "op4_bit_sliced_top_k": TOP_K_SQL,
    "op7_license_labels": _license_sql(),
    "op11_substring_dedup": WINDOWS_SQL,
    "op12_periodic_runs": RUNS_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}
