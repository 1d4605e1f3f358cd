"""A table keyed and partitioned by day that a stream upserts into, on plain parquet.

Every micro-batch adds one folder of rows and then one entry to the manifest, which names the folder and the days in
it.  Readers see what the manifest names and nothing else, so a batch that crashed before its entry was
written does not exist, and a batch whose entry exists is not written again.  Rows carry the number of their batch:
of several rows of a key the one from the highest batch counts, in whatever order batches arrive.

A day with one folder is read as it is.  A day with several is merged on read, by key; compaction
merges it for good, and its entry takes the merged folders out.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.relational import dedup

MANIFEST = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),  # NULL for a compaction
        T.StructField("day", T.DateType()),
        T.StructField("folder", T.StringType()),
        T.StructField("replaces", T.ArrayType(T.StringType())),
    ]
)
#: Folders of a day beyond which a batch that touches the day compacts it.
MOST_FOLDERS = 16


class KeyedTable:
    """The table in the folder ``path`` with key ``keys``; ``time`` (part of the key) tells the day of a row."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], time: str, most_folders: int = MOST_FOLDERS):
        if time not in keys:
            raise ValueError(f"{time} is not part of the key: an update could move a row to another day")
        self.spark, self.path, self.keys, self.time = spark, path.rstrip("/"), list(keys), time
        self.most_folders = most_folders

    # --- the manifest --------------------------------------------------------------------------

    def manifest(self) -> DataFrame:
        """All entries: one row per day of a batch or compaction."""
        try:
            return self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def live(self) -> DataFrame:
        """The folders that make up each day: day, folder."""
        entries = self.manifest()
        gone = entries.select(F.explode("replaces").alias("folder")).distinct()
        named = entries.where(F.col("folder").isNotNull() & F.col("day").isNotNull()).select("day", "folder").distinct()
        # a folder of a batch holds several days; each is replaced by itself
        place = F.concat(F.col("folder"), F.lit("/day="), F.col("day").cast("string"))
        return named.withColumn("place", place).join(gone.withColumnRenamed("folder", "place"), "place", "left_anti")

    def _commit(self, entries: DataFrame) -> None:
        """One file, put in place by one rename: the entry is there as a whole or not at all."""
        entries.select(*MANIFEST.fieldNames()).coalesce(1).write.parquet(f"{self.path}/manifest/{uuid.uuid4().hex}")

    def _rows(self, places: Sequence[str]) -> DataFrame:
        found = self.spark.read.option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/{p}" for p in places])
        return found.drop("commit").withColumn("day", F.col("day").cast("date"))

    # --- writing -------------------------------------------------------------------------------

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch: its rows replace those of the same key from lower batches.

        A batch that is in the manifest is left alone, so a replay changes nothing.  Of rows that share a key
        in a batch the greatest counts, compared column by column.  A NULL in the key is refused.
        """
        if not self.manifest().where(F.col("batch_id") == batch_id).isEmpty():
            return
        missing = F.lit(False)
        for key in self.keys:
            missing = missing | F.col(key).isNull()
        checked = rows.withColumn("day", F.when(missing, F.raise_error(F.lit("a key of the batch is NULL"))).otherwise(F.to_date(self.time)))
        others = [c for c in rows.columns if c not in self.keys]
        one_each = dedup(checked, self.keys, others, keep="last") if others else checked.dropDuplicates(self.keys)
        folder = f"commit=batch-{batch_id}-{uuid.uuid4().hex}"
        self._write(one_each.withColumn("_batch", F.lit(batch_id).cast("long")), folder)
        none = self.spark.createDataFrame([(None,)], "day date")
        days = self._rows([folder]).select("day").distinct() if self._has_rows(folder) else none
        self._commit(
            days.select(
                F.lit(batch_id).cast("long").alias("batch_id"),
                "day",
                F.lit(folder).alias("folder"),
                F.array().cast("array<string>").alias("replaces"),
            )
        )
        self.compact(self.most_folders, within=folder)

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(f"{self.path}/rows/{folder}")

    def _has_rows(self, folder: str) -> bool:
        try:
            self.spark.read.parquet(f"{self.path}/rows/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return False
        return True

    def compact(self, most_folders: int = 1, within: str | None = None) -> None:
        """Merge every day of more than ``most_folders`` folders (of the days in folder ``within``) into one."""
        live = self.live()
        crowded = live.groupBy("day").agg(F.collect_list("place").alias("places")).where(F.size("places") > most_folders)
        if within is not None:
            crowded = crowded.join(live.where(F.col("folder") == within).select("day"), "day", "left_semi")
        found = crowded.collect()  # a row for each day with small files
        if not found:
            return
        folder = f"commit=merged-{uuid.uuid4().hex}"
        merged = self._newest(self._rows([p for r in found for p in r.places]))
        self._write(merged, folder)
        self._commit(
            self.spark.createDataFrame([(None, r.day, folder, r.places) for r in found], MANIFEST)
        )

    # --- reading -------------------------------------------------------------------------------

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*self.keys, "day", "_batch")]
        newest = F.max_by(F.struct("_batch", *values), "_batch").alias("_newest")
        return rows.groupBy("day", *self.keys).agg(newest).select("day", *self.keys, "_newest.*")

    def current(self, schema: T.StructType | None = None) -> DataFrame | None:
        """One row per key as the manifest stands now, with the columns of ``schema`` if given.

        A table without rows has no files that tell its columns: it gives no rows of ``schema``, or None without one.
        """
        days = self.live().groupBy("day").agg(F.collect_list("place").alias("places")).collect()
        settled = [p for r in days if len(r.places) == 1 for p in r.places]
        crowded = [p for r in days if len(r.places) > 1 for p in r.places]
        parts = []
        if settled:
            parts.append(self._rows(settled))
        if crowded:
            parts.append(self._newest(self._rows(crowded)))
        if not parts:
            return None if schema is None else self.spark.createDataFrame([], schema)
        found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return found.drop("day", "_batch") if schema is None else found.select(*schema.fieldNames())
