import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factdim.llm.packing import WordIds, best_fit_rounds, pack_sequences

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
IDS = WordIds(PATH)


def expected(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n'sdlmÉİ\xa0\x1c\x85<|>1")), max_size=40))
def test_word_ids_equal_the_library(text):
    assert IDS(text) == expected(text)


def test_special_strings_equal_the_library():
    for text in ("a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|>", "<|endoftext |>"):
        assert IDS(text) == expected(text)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), min_size=1, max_size=20))
def test_rounds_fill_sequences_without_overlap(counts):
    size = 50
    runs = best_fit_rounds(counts, size)
    used: dict[int, list] = {}
    for (length, rank, first, offset), after in zip(runs, [*runs[1:], (0, 0, 0, 0)], strict=True):
        end = after[1] if after[0] == length else counts[length]
        assert end > rank
        for k in range(end - rank):
            used.setdefault(first + k, []).append((offset, length))
    assert sum(map(len, used.values())) == sum(counts.values())
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    # sequential best-fit decreasing as the measure
    bins: list[int] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = min((g for g in bins if g >= length), default=None)
            if fit is None:
                bins.append(size - length)
            else:
                bins[bins.index(fit)] -= length
    assert len(used) <= len(bins) + 1


def test_pack(spark):
    texts = ["", None, "one two", "one two", "word " * 300, "x" * 2000, "a <|endoftext|> b", "tie", "tie"]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 1), (3, "one two", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = pack_sequences(df, PATH, size=64, end_id=1).collect()
    pieces: dict = {}
    for i, t, _ in rows:
        data = expected(t) + np.array([1], "<u4").tobytes()
        for k, at in enumerate(range(0, len(data), 256)):
            pieces.setdefault((i, k), []).append((at // 4, len(data[at : at + 256]) // 4, zlib.crc32(data[at : at + 256])))
    found: dict = {}
    for r in got:
        found.setdefault((r.doc_id, r.piece), []).append((r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in pieces.items()}
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-sum(r.length for r in got) // 64) + 2


def test_empty_table(spark):
    assert pack_sequences(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
