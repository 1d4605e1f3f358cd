import random
import re

from factdim.llm.licenses import license_labels
from factdim.llm.mixing import apportion, mix, mix_texts


def targets(sizes, share=1.5, weights=(5, 2, 1)):
    """Shares by weight, capped at twice the size, the excess shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        out = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if out[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return out | capped
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_mix(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        source = rng.choice(["b", "a", "é", None, "c", "c", "c", "c"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 40, 90, 300])), source, 7))
    rows += [(None, None, "a", 7), (7000, "", "zero", 7), (5, "same same", "a", 7), (5, "same same", "a", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    got = mix(df, shard_docs=64).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    taken: dict = {}
    source_of = {}
    for i, t, s, _ in rows:
        source_of[(i, len((t or "").split()))] = s
    for r in got:
        s = source_of[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 64 + 0.01 * t
    again = mix(df.repartition(5), shard_docs=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mix_texts(df, shard_docs=64)
    assert mixed.columns == df.columns
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(taken.values())


def test_apportionment_equals_the_highest_quotients(spark):
    rng = random.Random(2)
    rows = [(g, k, float(rng.choice([0, 1, 5, 50, 1000])), rng_seats) for g in range(8) for rng_seats in [rng.randint(0, 60)] for k in range(12)]
    df = spark.createDataFrame(rows, "g int, k int, votes double, seats long")
    got = {(r.g, r.k): r.quota for r in apportion(df, ["g"], ["k"], "votes", "seats").collect()}
    for g in range(8):
        own = [r for r in rows if r[0] == g]
        quotients = sorted(((-v / (2 * j - 1), k, j) for _, k, v, _ in own for j in range(1, 70) if v), key=lambda q: q)
        want = dict.fromkeys(range(12), 0)
        for _, k, _ in quotients[: own[0][3]]:
            want[k] += 1
        assert {k: got[g, k] for k in range(12)} == want


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(df).collect() == [] and mix_texts(df).collect() == []
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mix(blank).collect()] == [(0, 0.0, 0)] * 2


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def test_licenses(spark):
    texts = [
        "", None, "MIT License mit-license", "the Apache  License, (GNU General Public\nLicense)", "cc-by cc by ccby",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted today free of charge to any person obtaining a copy of this software", "mİt license émit license",
        "word " * 5000 + "apache license",
    ]
    rows = [*enumerate(texts), (None, texts[2]), (3, texts[3])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, labels string")
    got = license_labels(df).collect()
    assert len(got) == len(rows)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_id: dict = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
        places = [(k, label) for p, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        for r in by_id[i]:
            assert (r.n_words, r.n_base) == (len(words), len(places))
            assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
            assert r.base_labels == ",".join(sorted({label for _, label in places}))
            assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
            assert 0 <= r.score <= 1
    assert by_id[5][0].labels == by_id[6][0].labels == "mit" and by_id[5][0].base_labels == ""
    assert by_id[0][0].score == 0.0
    assert license_labels(df.limit(0)).collect() == []


def test_license_of_a_very_long_text(spark):
    """More than two megabytes in one document: work grows with the length, not with its square."""
    n = 400_000
    words = [f"w{i % 977}" for i in range(n)]
    words[1000:1002], words[n - 4 :] = ["MIT", "license"], ["GNU", "general", "public", "License"]
    df = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "mit")], "doc_id long, text string")
    found = {r.doc_id: r for r in license_labels(df).collect()}
    assert (found[1].n_words, found[1].n_base, found[1].first_word, found[1].last_word) == (n, 2, 1000, n - 4)
    assert found[1].base_labels == "gpl,mit" and (found[2].n_words, found[3].n_words) == (0, 1)
