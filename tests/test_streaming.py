"""Session streams on files that arrive one per micro-batch."""

import json

import pytest
from helpers import rows

from factdim.operators import sessionize
from factdim.plans.jobs import JOBS
from factdim.sources import read_web_events
from factdim.streaming import (
    KeyedTable,
    accepted_events,
    accounts,
    foreach_batch_writer,
    latest_sessions,
    refused_events,
    session_table,
    sessionize_stream,
    start_intake,
    start_session_stream,
)
from factdim.streaming.intake import take_in
from factdim.streaming.sessions import STATE_CONF

MIN = 60_000
T0 = 1_700_000_000_000 - 1_700_000_000_000 % (60 * MIN)


class Feed:
    """Files renamed into the source folder one by one."""

    def __init__(self, spark, base):
        self.spark, self.base, self.n = spark, base, 0
        (base / "in").mkdir()

    def add(self, *events):
        lines = [json.dumps({"ip": ip, "host": "h", "ts": T0 + ms, "path": "/"}) for ip, ms in events]
        staged = self.base / f"staged{self.n}"
        staged.write_text("\n".join([*lines, ""]))
        staged.rename(self.base / "in" / f"{self.n:04}.json")
        self.n += 1
        return self

    def run(self):
        source = read_web_events(self.spark, str(self.base / "in"), streaming=True)
        query = start_session_stream(
            sessionize_stream(source), str(self.base / "out"), str(self.base / "state"), available_now=True
        )
        query.awaitTermination()
        return query

    def sessions(self):
        out = latest_sessions(self.spark, str(self.base / "out"))
        return {(r.ip, int(r.session_start.timestamp() * 1000) - T0): r.event_count for r in out.collect()}

    @staticmethod
    def dropped(query):
        return sum(
            s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
        )


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_sessions_close_and_restart_continues(spark, feed):
    feed.add(("a", 0), ("a", 5 * MIN), ("b", MIN)).run()
    assert feed.sessions() == {}
    # out of order within 10 seconds of the newest event
    feed.add(("a", 7 * MIN), ("c", 7 * MIN + 9_000), ("c", 7 * MIN)).run()
    feed.add(("z", 40 * MIN)).run()
    feed.add(("z", 41 * MIN)).run()
    assert feed.sessions() == {("a", 0): 3, ("b", MIN): 1, ("c", 7 * MIN): 2}
    stored = read_web_events(spark, str(feed.base / "in"))
    batch = sessionize(stored)
    streamed = latest_sessions(spark, str(feed.base / "out"))
    closed = batch.filter("ip <> 'z'").select(*streamed.columns)
    assert rows(closed, "session_id") == rows(streamed, "session_id")


def test_late_rows_are_dropped_and_counted(feed):
    feed.add(("a", 0)).run()
    feed.add(("z", 30 * MIN)).run()
    feed.add(("z", 31 * MIN)).run()  # the watermark counts from the batch after it moved
    query = feed.add(("a", MIN), ("z", 32 * MIN)).run()
    assert feed.dropped(query) == 1
    feed.add(("z", 60 * MIN)).run()
    feed.add(("z", 61 * MIN)).run()
    assert feed.sessions() == {("a", 0): 1, ("z", 30 * MIN): 3}


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    write = foreach_batch_writer(str(tmp_path / "out"))
    rows_of = lambda n: spark.createDataFrame([("i", "h", s, n) for s in range(n)], "ip string, host string, session_start int, event_count int")
    write(rows_of(3), 0)
    write(rows_of(3), 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    write(rows_of(2), 1)
    assert sorted(map(tuple, latest_sessions(spark, str(tmp_path / "out")).select("session_start", "event_count").collect())) == [(0, 2), (1, 2), (2, 3)]
    assert callable(foreach_batch_writer({"url": "jdbc:none", "dbtable": "t"}))


DAY = 24 * 60 * MIN


def _sessions(spark, *data):
    """Rows (host, ip, start in ms, event_count) as a batch of sessions."""
    rows = spark.createDataFrame(list(data), "host string, ip string, ms long, event_count long")
    return rows.selectExpr("host", "ip", "timestamp_millis(ms) as session_start", "event_count")


def _content(table):
    return sorted((r.host, r.ip, int(r.session_start.timestamp() * 1000), r.event_count) for r in table.current().collect())


def test_keyed_table_takes_each_batch_once_and_the_highest_batch_wins(spark, tmp_path):
    table = session_table(spark, str(tmp_path / "t"))
    assert table.current() is None
    first = _sessions(spark, ("h", "a", 0, 1), ("h", "b", DAY, 1), ("h", "b", DAY, 2))
    table.upsert(first, 0)
    table.upsert(first, 0)  # replayed
    assert _content(table) == [("h", "a", 0, 1), ("h", "b", DAY, 2)]
    table.upsert(_sessions(spark, ("h", "a", 0, 7), ("h", "c", 3 * DAY, 3)), 5)
    table.upsert(_sessions(spark, ("h", "a", 0, 4), ("h", "d", 0, 4)), 3)  # arrives late, is older
    table.upsert(_sessions(spark), 6)  # an empty batch
    expected = [("h", "a", 0, 7), ("h", "b", DAY, 2), ("h", "c", 3 * DAY, 3), ("h", "d", 0, 4)]
    assert _content(table) == expected
    folders = {r.day.day: r.n for r in table.live().groupBy("day").count().withColumnRenamed("count", "n").collect()}
    assert folders == {1: 3, 2: 1, 4: 1}
    table.compact()
    plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("Sort", "Aggregate", "Exchange"))  # days of one folder are read as they are
    assert _content(table) == expected
    assert table.live().groupBy("day").count().agg({"count": "max"}).first()[0] == 1
    table.upsert(_sessions(spark, ("h", "a", 0, 5)), 4)  # older than what the compaction merged
    table.upsert(_sessions(spark, ("h", "a", 0, 9)), 8)
    assert _content(table)[0] == ("h", "a", 0, 9)


def test_keyed_table_compacts_crowded_days_by_itself(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["host", "ip", "session_start"], "session_start", most_folders=2)
    for n in range(4):
        table.upsert(_sessions(spark, ("h", "a", 0, n), ("h", f"x{n}", 0, n)), n)
    assert table.live().count() <= 2
    assert _content(table) == [("h", "a", 0, 3), *[("h", f"x{n}", 0, n) for n in range(4)]]


def test_keyed_table_does_not_see_a_crashed_batch(spark, tmp_path, monkeypatch):
    table = session_table(spark, str(tmp_path / "t"))
    table.upsert(_sessions(spark, ("h", "a", 0, 1)), 0)

    def crash(entries):
        raise RuntimeError("lost before the entry was written")

    with monkeypatch.context() as m:
        m.setattr(table, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.upsert(_sessions(spark, ("h", "a", 0, 2)), 1)
        assert _content(table) == [("h", "a", 0, 1)]
    table.upsert(_sessions(spark, ("h", "a", 0, 2)), 1)  # the retry
    assert _content(table) == [("h", "a", 0, 2)]


def test_keyed_table_refuses_what_it_cannot_address(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), ["host", "ip"], "session_start")
    table = session_table(spark, str(tmp_path / "t"))
    with pytest.raises(Exception, match="key of the batch is NULL"):
        table.upsert(_sessions(spark, (None, "a", 0, 1)), 0)
    assert table.current() is None


def test_sessions_upsert_over_restarts_equals_batch(spark, feed):
    """One batch and one restart a file; sessions span files."""
    table = session_table(spark, str(feed.base / "table"))
    for n in range(6):
        at = n * 4 * MIN + (10 * MIN if n > 2 else 0)
        feed.add(("a", at), ("b", at), ("b", at + 5_000))
        source = read_web_events(spark, str(feed.base / "in"), streaming=True, files_per_batch=1)
        query = start_session_stream(sessionize_stream(source), table, str(feed.base / "state"), available_now=True)
        query.awaitTermination()
    assert {k: spark.conf.get(k) for k in STATE_CONF} == STATE_CONF
    stored = sessionize(read_web_events(spark, str(feed.base / "in")))
    closed = stored.filter(f"unix_millis(session_end) <= {T0 + 30 * MIN + 5_000 - 10_000}")
    assert closed.count() == 2
    assert rows(table.current().select(*stored.columns), "session_id") == rows(closed, "session_id")


def _line(ip, ms):
    return json.dumps({"ip": ip, "host": "h", "ts": T0 + ms})


def test_intake_accounts_for_every_row(spark, tmp_path):
    target = str(tmp_path / "out")
    batches = [
        [_line("a", 0), _line("a", 10 * MIN), "", "{broken", '{"ip": "a", "ts": 1}', '{"host": "h", "ts": 1}', None],
        [_line("b", 4 * MIN + 50_000), _line("b", 4 * MIN + 50_001), '{"ip": "a", "host": "h", "ts": "soon"}'],
        [],
        [_line("c", 30 * MIN), _line("c", MIN)],
    ]
    for number, values in enumerate(batches):
        messages = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset long")
        for _ in range(2):  # each batch is replayed
            take_in(messages, number, target, "value", 5 * MIN, 10_000)
    counted = accounts(spark, target).orderBy("batch_id").collect()
    assert [(r.accepted, r.late, r.rejected) for r in counted] == [(2, 0, 5), (1, 1, 1), (0, 0, 0), (1, 1, 0)]
    assert [r.newest and r.newest - T0 for r in counted] == [10 * MIN, 4 * MIN + 50_001, None, 30 * MIN]
    assert {(r.ip, r.ts - T0, r.path) for r in accepted_events(spark, target).collect()} == {
        ("a", 0, ""), ("a", 10 * MIN, ""), ("b", 4 * MIN + 50_001, ""), ("c", 30 * MIN, "")
    }
    refused = sorted((r.batch_id, r.offset, r.outcome, r.reason) for r in refused_events(spark, target).collect() if r.reason)
    assert refused == [
        (0, 2, "rejected", "empty"), (0, 3, "rejected", "malformed"), (0, 4, "rejected", "no host"),
        (0, 5, "rejected", "no ip"), (0, 6, "rejected", "empty"), (1, 2, "rejected", "no ts"),
    ]


def test_intake_stream_restarts(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n in range(3):
        (source / f"{n}.txt").write_text(_line("a", n * 20 * MIN) + "\n" + _line("a", 0) + "\n")
        lines = spark.readStream.schema("value string").text(str(source))
        start_intake(lines, target, str(tmp_path / "state"), available_now=True).awaitTermination()
    counted = accounts(spark, target).orderBy("batch_id").collect()
    assert [(r.accepted, r.late, r.rejected) for r in counted] == [(2, 0, 0), (2, 0, 0), (1, 1, 0)]


def test_sessions_upsert_with_every_session_open_gives_no_rows(spark, tmp_path):
    """Events of five days less than a gap apart: no session is closed, so the table stays without rows."""
    spark.sql(
        "SELECT id AS event_id, timestamp_seconds(1704067200 + id * 200) AS ts, 30L AS user_id, 'view' AS event_type FROM range(2100)"
    ).write.parquet(str(tmp_path / "events.parquet"))
    upserted, stored = (JOBS[name](spark, str(tmp_path)) for name in ("sessions_upsert", "sessions"))
    assert [(f.name, f.dataType) for f in upserted.schema] == [(f.name, f.dataType) for f in stored.schema]
    assert upserted.collect() == [] and stored.count() == 1
