import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from factdim.llm import token_counts as tc
from factdim.llm.common import first_by_hash, largest

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def expected(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdlmé\xa0 \x1c\x85<|>")), max_size=40))
def test_pre_tokens_hold_the_tokens_of_a_text(text):
    split = tc.splitter(TOKENIZER)
    assert sum(tc.count_pieces(list(split(text)), TOKENIZER)) == expected(text)


def test_counts_equal_the_library(spark):
    texts = ["", None, "It's  a test\n\n of 12 things", "a" * 5000, "x <|endoftext|> y<|endoftext|>", "ééé 你好　!", "tie", "tie"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (0, "twice", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    # a head of two terms sends nearly everything through the join
    got = {r.doc_id: r for r in tc.token_counts(df, PATH, limit=5, head_terms=2).collect()}
    want = {i: expected(t) for i, t in enumerate(texts)} | {None: expected("no id")}
    want[0] = expected("") + expected("twice")
    assert {k: r.n_tokens for k, r in got.items()} == want
    assert got[2].n_bytes == len(texts[2]) and got[1].n_bytes == 0
    assert got[5].n_bytes == len(texts[5].encode())
    assert all(r.over_limit == (r.n_tokens > 5) for r in got.values())


def test_long_texts_are_split_lazily():
    text = "word " * 300_000
    assert sum(1 for _ in tc.pre_tokens(text, TOKENIZER)) == len(tc.PRE_TOKEN_ASCII.findall(text))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tc.token_counts(df, PATH).collect() == []


def test_largest_and_first_by_hash_take_at_most_so_many(spark):
    counts = spark.range(1, 2001).selectExpr("id", "cast(4000 / id as int) + 1 as n")
    for most in (0, 1, 10, 100, 1999, 2000, 5000):
        found = [r.n for r in largest(counts, F.col("n"), most).collect()]
        assert len(found) <= most
        left_out = counts.count() - len(found)
        assert not left_out or len(found) == 0 or min(found) > min(r.n for r in counts.collect())
        assert first_by_hash(counts, "id", most).count() <= most
    assert largest(counts, F.col("n"), 2000).count() == first_by_hash(counts, "id", 2000).count() == 2000
    assert 1500 < first_by_hash(counts, "id", 1800).count() <= 1800
    assert largest(counts.limit(0), F.col("n"), 5).count() == 0
