"""Sums along an order, slot by slot, against brute force in Python."""

import random

import pytest
from helpers import table

from factdim.operators import longest_streak, max_wins_in_stretch, slot_of
from factdim.operators.ordered import rolling_sum, running_totals
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, an outlier in the order column, keys of one row, and gaps."""
    rng = random.Random(5)
    data = [("hot", g, rng.randint(0, 3)) for g in sorted(rng.sample(range(2_000), 700))]
    data.append(("hot", 9_000_000_000, 2))
    data += [("warm", g, rng.randint(0, 3)) for g in range(0, 300, 2)]
    data += [(f"k{i}", i, 1) for i in range(50)]
    data += [("cold", g, None if g % 3 else 1) for g in range(30)]
    return table(spark, "k string, g bigint, v int", *data).repartition(5), data


def _by_key(data):
    groups = {}
    for k, g, v in sorted(data):
        groups.setdefault(k, []).append((g, v))
    return groups


@pytest.mark.parametrize("slots", [1, 40, 10**12])
def test_running_totals(spark, skewed, slots):
    df, data = skewed
    out = running_totals(
        df, ["k"], "g", {"pos": F.lit(1), "cum": F.col("v")}, slots
    )
    expected = {}
    for k, items in _by_key(data).items():
        total = 0
        for i, (g, v) in enumerate(items, 1):
            total += v or 0
            expected[k, g] = (i, total)
    assert {(r.k, r.g): (r.pos, r.cum) for r in out.collect()} == expected


@pytest.mark.parametrize("width", [1, 2, 7, 40, 90, 500])
@pytest.mark.parametrize("slots", [3, 10**12])
def test_rolling_sum(spark, skewed, slots, width):
    df, data = skewed
    out = rolling_sum(df, ["k"], "g", F.col("v"), width, "s", slots, block_rows=slots)
    expected = {}
    for k, items in _by_key(data).items():
        for i, (g, _) in enumerate(items):
            values = [v for _, v in items[max(0, i - width + 1) : i + 1] if v is not None]
            expected[k, g] = sum(values) if values else None
    got = out.collect()
    assert len(got) == len(expected)
    assert {(r.k, r.g): r.s for r in got} == expected


@pytest.mark.parametrize("slots", [2, 50, 10**12])
def test_longest_streak(spark, skewed, slots):
    df, data = skewed
    out = longest_streak(
        df, F.col("v") >= 1, "k", "g", slots, ("n", "lo", "hi")
    )
    expected = set()
    for k, items in _by_key(data).items():
        runs, run = [], []
        for g, v in [*items, (None, None)]:
            if v is not None and v >= 1:
                run.append(g)
            elif run:
                runs.append((k, len(run), run[0], run[-1]))
                run = []
        best = max((r[1] for r in runs), default=None)
        expected |= {r for r in runs if r[1] == best}
    assert {tuple(r) for r in out.collect()} == expected


@pytest.mark.parametrize("slots", [7, 10**6])
def test_max_wins_in_stretch(spark, slots):
    rng = random.Random(11)
    data = []
    for game in range(400):
        a, b = rng.sample(["A", "B", "C"] if game % 3 else ["A", "B"], 2)
        data += [(game, a, rng.randint(0, 9)), (game, b, rng.randint(0, 9))]
    games = table(spark, "game_id bigint, team_abbreviation string, pts int", *data)
    got = {tuple(r) for r in max_wins_in_stretch(games, 25, slots=slots, block_rows=slots).collect()}
    wins = {}
    for i in range(0, len(data), 2):
        (g, a, x), (_, b, y) = data[i], data[i + 1]
        wins.setdefault(a, []).append(int(x > y))
        wins.setdefault(b, []).append(int(y > x))
    assert got == {
        (t, max(sum(w[max(0, i - 24) : i + 1]) for i in range(len(w)))) for t, w in wins.items()
    }


def test_slots_rise_with_every_kind_of_order(spark):
    df = spark.sql(
        "select id, cast(id as decimal(12, 2)) / 4 as dec, date_add(date'1970-01-01', cast(id as int)) as day,"
        " timestamp_seconds(id) as at, cast(id as string) as name from range(-30, 30)"
    )
    for order in ("id", "dec", "day", "at"):
        found = [r.s for r in df.orderBy("id").select(slot_of(df, order, 7).alias("s")).collect()]
        assert found == sorted(found) and len(set(found)) > 2, order
    with pytest.raises(TypeError):
        slot_of(df, "name", 7)
    with pytest.raises(ValueError):
        slot_of(df, "id", 0)


def test_text_order_with_named_slots_and_null_order(spark):
    rng = random.Random(2)
    names = sorted({"".join(rng.choices("abc", k=4)) for _ in range(60)})
    data = [("k", n, i) for i, n in enumerate(names)]
    df = table(spark, "k string, name string, v int", *data, ("k", None, 1000), (None, "a", 1))
    out = running_totals(df, ["k"], "name", {"cum": F.col("v")}, F.substring("name", 1, 1))
    assert [r.cum for r in out.orderBy(F.col("name").asc_nulls_first()).collect()] == [
        1000 + sum(range(i)) for i in range(len(names) + 1)
    ]


def test_plan_is_built_without_a_job(spark, skewed):
    """Nothing is counted while the sums are put together."""
    df, _ = skewed
    context = spark.sparkContext
    context.setJobGroup("build", "")
    longest_streak(df, F.col("v") >= 1, "k", "g", 10, ("n", "lo", "hi"))
    rolling_sum(df, ["k"], "g", F.col("v"), 5, "s", 10)
    assert not context.statusTracker().getJobIdsForGroup("build")
    context.setLocalProperty("spark.jobGroup.id", None)
