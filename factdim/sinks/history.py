"""A stored type-2 history whose closed runs are written once.

Every period adds one folder of rows: the runs that reach it (``state=open``) and those it closed (``state=closed``),
and then one commit entry that names the folder.  A period is made from the open runs of the period before and its
own snapshot; closed runs, which are nearly all of an old history, are neither read nor written again.  The history
as of a period is its open runs and the closed runs of all periods up to it.  Readers see what the commits name:
a run that crashed before its entry leaves no trace, and a period that is run again replaces itself as a whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd import ACTOR_ATTRS, scd2_backfill, scd2_increment

COMMITS = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("base", T.BooleanType()),  # entries before a base count no more
        T.StructField("folder", T.StringType()),
        T.StructField("columns", T.StringType()),
    ]
)


class HistoryTable:
    """The history in the folder ``path``; the names are those of ``scd2_increment``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "actorid",
        attrs: Sequence[str] = ACTOR_ATTRS,
        period: str = "current_year",
        label: str | None = "actor",
        start: str = "start_year",
        end: str = "end_year",
    ):
        self.spark, self.path, self.period, self.start, self.end = spark, path.rstrip("/"), period, start, end
        self.key = key
        self.names = {"key": key, "attrs": attrs, "period": period, "label": label, "start": start, "end": end}

    def commits(self) -> list[Row]:
        """The entry that counts for each stored period, oldest first: one row a period."""
        try:
            found = self.spark.read.schema(COMMITS).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        first = found.where("base").select(F.max("number")).scalar()
        newest = F.max_by(F.struct(*COMMITS.fieldNames()), "number").alias("entry")
        return [r.entry for r in found.where(F.col("number") >= first).groupBy("period").agg(newest).orderBy("period").collect()]

    # --- writing -------------------------------------------------------------------------------

    def load(self, history: DataFrame, year: int) -> None:
        """Start anew from a whole history as of ``year``."""
        self._store(history, year, base=True)

    def increment(self, snapshot: DataFrame, year: int) -> None:
        """Add ``year``, or run the last stored period again.

        A key without a row in the snapshot keeps its run closed, a key that comes back opens a new one.  A NULL key
        is refused, and so is a year that would leave a gap or lie before the last one.
        """
        stored = self.commits()
        if not stored or (stored[-1].base and stored[-1].period == year and self._starts_at(stored[-1])):
            whole = scd2_backfill(self._checked(snapshot, year), as_of=year, **self.names)
            self._store(whole, year, base=True)
            return
        self._store(self.step(snapshot, year), year, base=False)

    def step(self, snapshot: DataFrame, year: int) -> DataFrame:
        """The rows ``year`` adds: its open runs and those it closes, from the open runs of the year before."""
        stored = self.commits()
        before = [c for c in stored if c.period == year - 1]
        if not before or stored[-1].period not in (year - 1, year):
            raise ValueError(f"periods {[c.period for c in stored]} are stored, cannot add {year}")
        open_runs = self._read(before, "open").withColumn(self.period, F.lit(year - 1))
        return scd2_increment(open_runs, self._checked(snapshot, year), year, last_period=year - 1, **self.names)

    def _checked(self, snapshot: DataFrame, year: int) -> DataFrame:
        key = F.col(self.key)
        refused = F.when(key.isNull(), F.raise_error(F.lit("a key of the snapshot is NULL"))).otherwise(key)
        return snapshot.where(F.col(self.period) == year).withColumn(self.key, refused)

    def _starts_at(self, entry: Row) -> bool:
        """Whether the period holds a first snapshot and nothing older."""
        older = F.col(self.start) < entry.period
        return all(self._read([entry], state).where(older).isEmpty() for state in ("open", "closed"))

    def _store(self, rows: DataFrame, year: int, base: bool) -> None:
        runs = rows.drop(self.period)
        folder = f"run={year}-{uuid.uuid4().hex}"
        state = F.when(F.col(self.end) == year, "open").otherwise("closed")
        (
            runs.withColumn("state", state)
            .hint("rebalance", F.col("state"))
            .write.partitionBy("state")
            .parquet(f"{self.path}/runs/{folder}")
        )
        self._commit(year, base, folder, runs.schema)

    def _commit(self, year: int, base: bool, folder: str, columns: T.StructType) -> None:
        """One file, put in place by one rename."""
        number = 1 + max((c.number for c in self.commits()), default=0)
        entry = self.spark.createDataFrame([(number, year, base, folder, columns.json())], COMMITS)
        entry.coalesce(1).write.parquet(f"{self.path}/commits/{number}-{uuid.uuid4().hex}")

    # --- reading -------------------------------------------------------------------------------

    def _read(self, entries: Sequence[Row], state: str) -> DataFrame:
        columns = T.StructType.fromJson(json.loads(entries[-1].columns))
        schema = T.StructType([*columns.fields, T.StructField("state", T.StringType())])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/runs")
        found = reader.parquet(*[f"{self.path}/runs/{c.folder}" for c in entries])
        return found.where(F.col("state") == state).drop("state", "run")

    def as_of(self, year: int | None = None) -> DataFrame:
        """The history as it stood after ``year`` (default: the last stored period)."""
        stored = [c for c in self.commits() if year is None or c.period <= year]
        if not stored or (year is not None and stored[-1].period != year):
            raise ValueError(f"period {year} is not stored")
        runs = self._read(stored[-1:], "open").unionByName(self._read(stored, "closed"))
        return runs.withColumn(self.period, F.lit(stored[-1].period))
