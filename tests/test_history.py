"""The stored history: equal to a backfill at every period, without touching closed runs."""

import random
from pathlib import Path

import pytest
from helpers import rows, table

from factdim.operators import scd2_backfill
from factdim.plans.inspect import executed_plan
from factdim.sinks import HistoryTable

SCHEMA = "actorid string, actor string, quality_class string, is_active boolean, current_year int"
YEARS = range(2000, 2007)


def snapshots(seed=1, keys=25):
    """Random statuses with missing years, late starts and renamed actors."""
    rng = random.Random(seed)
    found = []
    for key in range(keys):
        state = ("good", True)
        for year in YEARS:
            if rng.random() < 0.25:
                continue
            if rng.random() < 0.4:
                state = (rng.choice(["good", "bad", None]), rng.random() < 0.5)
            found.append((f"k{key}", f"name {key} of {year}", *state, year))
    return found


def files(path, state):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet") if f"state={state}" in str(f)}


def test_every_period_equals_a_backfill(spark, tmp_path):
    stored = table(spark, SCHEMA, *snapshots())
    history = HistoryTable(spark, str(tmp_path))
    written = {}
    for year in YEARS:
        history.increment(stored, year)
        closed = files(tmp_path, "closed")
        assert written.items() <= closed.items()
        written = closed
    for year in YEARS:
        assert rows(history.as_of(year)) == rows(scd2_backfill(stored, as_of=year))


def test_a_period_run_again_replaces_itself(spark, tmp_path):
    data = snapshots(2)
    history = HistoryTable(spark, str(tmp_path))
    history.load(scd2_backfill(table(spark, SCHEMA, *data), as_of=2003), 2003)
    for year in (2004, 2005):
        history.increment(table(spark, SCHEMA, *data), year)
    before = rows(history.as_of())
    history.increment(table(spark, SCHEMA, *data), 2005)
    assert rows(history.as_of()) == before
    mended = [(*r[:2], "mended", *r[3:]) if r[4] == 2005 and r[0] < "k2" else r for r in data]
    history.increment(table(spark, SCHEMA, *mended), 2005)
    assert rows(history.as_of()) == rows(scd2_backfill(table(spark, SCHEMA, *mended), as_of=2005)) != before
    assert [c.period for c in history.commits()] == [2003, 2004, 2005]
    history.increment(table(spark, SCHEMA, *mended), 2006)
    assert rows(history.as_of()) == rows(scd2_backfill(table(spark, SCHEMA, *mended), as_of=2006))


def test_first_period_may_be_run_again(spark, tmp_path):
    history = HistoryTable(spark, str(tmp_path))
    for quality in ("good", "bad"):
        history.increment(table(spark, SCHEMA, ("a", "A", quality, True, 2000)), 2000)
    assert rows(history.as_of()) == [("a", "A", "bad", True, 2000, 2000, 2000)]


def test_periods_without_rows(spark, tmp_path):
    history = HistoryTable(spark, str(tmp_path))
    one = table(spark, SCHEMA, ("a", "A", "good", True, 2000), ("a", "A", "good", True, 2003))
    for year in range(2000, 2004):
        history.increment(one, year)
    assert rows(history.as_of(2002)) == [("a", "A", "good", True, 2000, 2000, 2002)]
    assert [r[4:6] for r in rows(history.as_of())] == [(2000, 2000), (2003, 2003)]
    empty = HistoryTable(spark, str(tmp_path / "empty"))
    empty.increment(one.limit(0), 2000)
    empty.increment(one, 2001)
    assert rows(empty.as_of()) == []


def test_gaps_old_periods_and_null_keys_are_refused(spark, tmp_path):
    data = table(spark, SCHEMA, *snapshots(3))
    history = HistoryTable(spark, str(tmp_path))
    history.load(scd2_backfill(data, as_of=2002), 2002)
    history.increment(data, 2003)
    for year in (2001, 2002, 2005):
        with pytest.raises(ValueError, match="cannot add"):
            history.increment(data, year)
    with pytest.raises(ValueError, match="not stored"):
        history.as_of(2001)
    with pytest.raises(Exception, match="is NULL"):
        history.increment(table(spark, SCHEMA, (None, "A", "good", True, 2004)), 2004)
    assert rows(history.as_of()) == rows(scd2_backfill(data, as_of=2003))


def test_a_crash_before_the_commit_leaves_no_trace(spark, tmp_path, monkeypatch):
    data = table(spark, SCHEMA, *snapshots(4))
    history = HistoryTable(spark, str(tmp_path))
    history.increment(data, 2000)
    with monkeypatch.context() as patch:
        patch.setattr(HistoryTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            history.increment(data, 2001)
    assert rows(history.as_of()) == rows(scd2_backfill(data, as_of=2000))
    history.increment(data, 2001)
    assert rows(history.as_of()) == rows(scd2_backfill(data, as_of=2001))


def test_a_period_reads_open_runs_only(spark, tmp_path):
    data = table(spark, SCHEMA, *snapshots(5))
    history = HistoryTable(spark, str(tmp_path))
    for year in (2000, 2001, 2002):
        history.increment(data, year)
    plan = executed_plan(history.step(data, 2003))
    assert "(state#" in plan and "= open)" in plan and "= closed)" not in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line or "Location:" in line]
    assert scans and all("PartitionFilters: []" not in line for line in scans)
    read = [f for f in history.step(data, 2003).inputFiles() if "/runs/" in f]
    assert read and all("/run=2002-" in f for f in read)
