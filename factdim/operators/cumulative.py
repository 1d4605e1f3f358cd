"""Cumulative snapshot tables: actors with their films, and lists of active dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import days_in_words, empty_array, on_day, quality_class
from ..functions.bits import WORD_DAYS
from ..schemas import FILM_STATS

# --- actors ---------------------------------------------------------------------------------


def _films_of_year() -> Column:
    """Films of one actor and year in film id order, as array<struct<film,votes,rating,filmid>>."""
    fields = FILM_STATS.fieldNames()
    sortable = F.struct("filmid", *[f for f in fields if f != "filmid"])
    return F.transform(
        F.array_sort(F.collect_list(sortable)), lambda f: F.struct(*[f[n].alias(n) for n in fields])
    )


def _yearly(films: DataFrame, with_films: bool, strict: bool) -> DataFrame:
    """One row per actor and year with films: name, class of the year, optionally the films."""
    latest_name = F.max_by("actor", F.struct("filmid", "actor"))
    columns = [
        latest_name.alias("actor"),
        quality_class(F.avg("rating"), strict).alias("quality_class"),
    ]
    if with_films:
        columns.append(_films_of_year().alias("films"))
    return films.filter(F.col("actorid").isNotNull()).groupBy("actorid", "year").agg(*columns)


def _require_previous(prev: DataFrame, period: str, now, before, last) -> None:
    """Refuse a history that ends before the period in front of ``now``: its keys would vanish.

    ``last`` tells where the history ends; otherwise it is looked up, which is cheap in a table
    partitioned by ``period``.  A history without earlier periods is a first load.
    """
    if last is None:
        last = prev.filter(F.col(period) < F.lit(now)).agg(F.max(period)).first()[0]
    if last is not None and last < before:
        raise ValueError(f"history ends at {last}, cannot add {now}: {before} is missing")


def cumulate_actors(
    prev: DataFrame, films: DataFrame, year: int, strict: bool = False, last_period: int | None = None
) -> DataFrame:
    """The snapshot of ``year`` from the snapshot of ``year`` - 1 and the films of ``year``.

    ``prev`` may hold other years too (they are pruned) and may be empty; if it holds earlier years but
    not ``year`` - 1 it is refused (``last_period`` spares the look).  An actor without films in ``year``
    keeps class and films and becomes inactive.
    """
    _require_previous(prev, "current_year", year, year - 1, last_period)
    before = prev.filter(F.col("current_year") == year - 1).alias("b")
    now = _yearly(films.filter(F.col("year") == year), True, strict).alias("n")
    none = F.array().cast(prev.schema["films"].dataType)
    return before.join(now, F.col("b.actorid") == F.col("n.actorid"), "full").select(
        F.coalesce("n.actor", "b.actor").alias("actor"),
        F.coalesce("n.actorid", "b.actorid").alias("actorid"),
        F.concat(F.coalesce("b.films", none), F.coalesce("n.films", none)).alias("films"),
        F.coalesce("n.quality_class", "b.quality_class").alias("quality_class"),
        F.col("n.year").isNotNull().alias("is_active"),
        F.lit(year).alias("current_year"),
    )


def _carry_forward(yearly: DataFrame, last_year: Column) -> DataFrame:
    """Repeat every active year up to the year before the next one (or ``last_year``)."""
    w = Window.partitionBy("actorid").orderBy("year")
    until = F.coalesce(F.lead("year").over(w) - 1, last_year)
    return (
        yearly.withColumn("_until", until)
        .withColumn("current_year", F.explode(F.sequence("year", "_until")))
        .withColumn("is_active", F.col("current_year") == F.col("year"))
    )


def _last_year(films: DataFrame, last_year: int | None) -> tuple[DataFrame, Column]:
    if last_year is None:
        return films, films.select(F.max("year")).scalar()
    return films.filter(F.col("year") <= last_year), F.lit(last_year)


def backfill_actor_status(
    films: DataFrame, last_year: int | None = None, strict: bool = False
) -> DataFrame:
    """Class and activity of every actor and year from the debut on, without the film arrays.

    The input of type-2 history: nothing but fixed-size values is aggregated or shuffled.
    """
    films, last = _last_year(films, last_year)
    return _carry_forward(_yearly(films, False, strict), last).select(
        "actor", "actorid", "quality_class", "is_active", "current_year"
    )


def backfill_actors(
    films: DataFrame, last_year: int | None = None, strict: bool = False
) -> DataFrame:
    """All yearly snapshots in one job: equal to running :func:`cumulate_actors` year by year.

    A snapshot row holds all films of the actor up to its year, as the table defines; the window
    runs over years with films, the years between are generated afterwards.
    """
    films, last = _last_year(films, last_year)
    w = Window.partitionBy("actorid").orderBy("year")
    so_far = F.flatten(F.collect_list("films").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return _carry_forward(
        _yearly(films, True, strict).withColumn("films", so_far), last
    ).select("actor", "actorid", "films", "quality_class", "is_active", "current_year")


# --- date lists -----------------------------------------------------------------------------


def cumulate_dates(
    prev: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    date: dt.date,
    ts_col: str = "event_time",
    list_col: str = "activity_datelist",
    max_history_days: int | None = None,
    last_period: dt.date | None = None,
) -> DataFrame:
    """Date lists of ``date`` from those of the day before and the events of ``date``.

    A history with earlier days but without the day before is refused (``last_period`` spares the look).
    Rows with a NULL key are left out.  ``max_history_days`` trims dates that are older.
    """
    keys = list(keys)
    _require_previous(prev, "date", date, date - dt.timedelta(days=1), last_period)
    before = prev.filter(F.col("date") == date - dt.timedelta(days=1)).select(*keys, list_col)
    today = (
        events.filter(on_day(F.col(ts_col), date))
        .dropna(subset=keys)
        .select(*keys)
        .distinct()
        .withColumn("_today", F.array(F.lit(date)))
    )
    none = empty_array("date")
    listed = F.concat(F.coalesce(list_col, none), F.coalesce("_today", none))
    if max_history_days is not None:
        oldest = date - dt.timedelta(days=max_history_days - 1)
        listed = F.filter(listed, lambda d: d >= F.lit(oldest))
    return before.join(today, keys, "full").select(
        *keys, listed.alias(list_col), F.lit(date).alias("date")
    )


def backfill_dates(
    events: DataFrame,
    keys: Sequence[str],
    start: dt.date,
    end: dt.date,
    ts_col: str = "event_time",
    list_col: str = "activity_datelist",
) -> DataFrame:
    """Date lists of ``end`` for all events of ``start``..``end`` in one aggregation.

    Active days are OR-ed as bits into as many BIGINTs as the range needs, so each map task ships
    one fixed-size row per key, however many events the key has.
    """
    n_days = (end - start).days + 1
    offset = F.datediff(F.col(ts_col), F.lit(start))
    words = []
    for first in range(0, n_days, WORD_DAYS):
        inside = offset.between(first, first + WORD_DAYS - 1)
        shift = F.when(inside, offset - first).otherwise(0)
        bit = F.when(inside, F.call_function("shiftleft", F.lit(1).cast("bigint"), shift))
        words.append(F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint")))
    in_range = (F.col(ts_col) >= F.lit(start)) & (F.col(ts_col) < F.lit(end + dt.timedelta(days=1)))
    masks = (
        events.filter(in_range)
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.array(*words).alias("_words"))
    )
    days = days_in_words(F.col("_words"), F.lit(start), n_days)
    return masks.select(*keys, days.alias(list_col), F.lit(end).alias("date"))


def as_date_map(lists: DataFrame, key: str, map_key: str, list_col: str, name: str) -> DataFrame:
    """The map form of date lists: one row per ``key`` with ``map_key`` -> dates."""
    entries = F.collect_list(F.struct(map_key, list_col))
    return lists.groupBy(key, "date").agg(F.map_from_entries(entries).alias(name))
