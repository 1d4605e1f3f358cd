import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from factdim.llm.spelling import common, padded, spelling_variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least_length=5, least_count=3, slip=0):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    about = {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        form = min(others, key=lambda v: (-words[v], v), default=None)
        about[w] = (form if form and words[form] >= 2 * n else None, len(others))
    out = []
    for w, (form, n_near) in about.items():
        root = w
        while about[root][0]:
            root = about[root][0]
        out.append((w, form, root, words[w], n_near, words.get(form)))
    return sorted(out)


def found(df, **options):
    got = spelling_variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(tuple(r) for r in got)


def test_common_prefix_and_suffix():
    left, right, size = padded(["abcé", "abxé", "bé", "abcéz"], 6)
    assert size.tolist() == [4, 4, 2, 5]
    prefix, suffix = common(left, right, np.array([0, 0, 0]), np.array([1, 3, 2]))
    assert np.minimum(prefix, 4).tolist() == [2, 4, 0] and np.minimum(suffix, 2).tolist() == [1, 0, 1]


def corpus(rng):
    base = ["tiger", "tigers", "parler", "aaaaa", "aaaaaa", "aaaaaaa", "ábaco", "éééèèè", "mississippi"]
    base += ["".join(rng.choices("abé", k=rng.randint(4, 9))) for _ in range(40)]
    texts = ["", None, "...", "Tiger TIGER tiger TÎGER tîger ÀÀÀÀÀ ààààà"]
    for _ in range(120):
        words = []
        for w in rng.choices(base, weights=[3] * 9 + [1] * 40, k=12):
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "q" + w[at:], w[:at] + "z" + w[at + 1 :], w + "s"])
            words.append(w)
        texts.append(rng.choice([" ", "-", "1"]).join(words))
    return texts


@pytest.mark.parametrize("options", [{}, {"slip": 7}, {"tile_words": 2, "slip": 5}])
def test_variants_equal_brute_force(spark, options):
    texts = corpus(random.Random(13))
    rows = [*enumerate(texts), (5, texts[9]), (5, texts[9]), (None, texts[10]), (None, texts[10])]
    schema = "doc_id long, text string, word string, n string, size int"
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], schema)
    expected = brute(rows, slip=options.get("slip", 0))
    assert len(expected) > 30 and any(r[1] for r in expected)
    assert found(df, **options) == expected


def test_chains_and_ties(spark):
    text = " ".join(["abcde"] * 3 + ["abcdef"] * 6 + ["abcdefg"] * 12 + ["abcdefgh"] * 24 + ["xbcde"] * 6 + ["loner"] * 3)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert found(df) == brute([(1, text)])
    assert {r[0]: r[1:3] for r in found(df)}["abcde"] == ("abcdef", "abcdefgh")


def test_many_words_in_a_tile_and_a_very_long_word(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêë"
    words = ["pre" + "".join(rng.choices(letters, k=2)) + "end" for _ in range(600)]
    giant = "y" * 20_000
    rows = [(1, " ".join(words * 3)), (2, " ".join([giant] * 6 + [giant + "z"] * 3))]
    expected = [*brute(rows[:1]), (giant, None, giant, 6, 1, None), (giant + "z", giant, giant, 3, 1, 6)]
    same = found(spark.createDataFrame(rows, "doc_id long, text string"), tile_words=50) == expected
    assert same  # no report of the long words


def test_empty_table_and_small_factor(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(empty).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(empty, factor=1)
