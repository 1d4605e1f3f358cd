"""Visitors counted from merged bitmaps against counts over the events."""

import datetime as dt
import random

import pytest
from helpers import rows, table
from pyspark.sql import functions as F

from factdim.operators import count_visitors, trailing_visitors, visitor_bitmaps
from factdim.plans.inspect import python_nodes

SCHEMA = "user_id bigint, host string, event_time timestamp"


def events(seed=4, n=600):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 25)
    users = [0, -1, 1, -32768, 32768, 32769, 65536, 2**40, -(2**40), *range(100, 140)]
    found = []
    for _ in range(n):
        time = start + dt.timedelta(hours=rng.randrange(24 * 20))
        if time.day in (29, 30):
            continue  # two days without events
        found.append((rng.choice(users), rng.choice(["a", "a", "b"]), time))
    return [*found, (None, "a", start), (5, None, start), (5, "a", None)]


def usable(data):
    return [r for r in data if None not in r]


def test_months_and_totals(spark):
    data = events()
    days = visitor_bitmaps(table(spark, SCHEMA, *data), ["host"])
    month = F.trunc("date", "month").alias("month")
    want = {}
    for user, host, time in usable(data):
        want.setdefault((host, time.date().replace(day=1)), set()).add(user)
    got = count_visitors(days, ["host", month])
    assert got.columns == ["host", "month", "visitors"] and python_nodes(got) == 0
    assert rows(got) == sorted((*k, len(v)) for k, v in want.items())
    assert rows(count_visitors(days, [])) == [(len({r[0] for r in usable(data)}),)]


@pytest.mark.parametrize("window", [1, 3, 7])
def test_trailing_windows(spark, window):
    data = events(window)
    days = visitor_bitmaps(table(spark, SCHEMA, *data), ["host"])
    dates = sorted({r[2].date() for r in usable(data)})
    want = []
    for host in ("a", "b"):
        for n in range((dates[-1] - dates[0]).days + 1):
            day = dates[0] + dt.timedelta(days=n)
            first = day - dt.timedelta(days=window - 1)
            seen = {u for u, h, t in usable(data) if h == host and first <= t.date() <= day}
            if seen:
                want.append((host, day, len(seen)))
    assert rows(trailing_visitors(days, window, ["host"])) == sorted(want)


def test_empty(spark):
    days = visitor_bitmaps(table(spark, SCHEMA), ["host"])
    assert rows(count_visitors(days, ["host"])) == [] and rows(trailing_visitors(days, 7)) == []


def test_visitors_must_be_numbers(spark):
    bad = table(spark, "user_id string, host string, event_time timestamp", ("u1", "a", dt.datetime(2024, 1, 1)))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        visitor_bitmaps(bad, ["host"]).collect()
