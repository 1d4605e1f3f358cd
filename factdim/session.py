"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job of the library assumes.  They can be applied to a session
# somebody else built, so none of them is a static setting.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the split costs one more shuffle further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # merge the sessions of one map task before they are shuffled to the state store
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

#: Bytes of a file, and of a shuffle, that a task takes where whole tables of narrow rows are sorted, and the
#: number of shuffle partitions to begin with at least; adaptive execution merges those that stay small.
SMALL_SPLIT, SMALL_PARTITION, LEAST_PARTITIONS = "32m", "16m", 200

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "factdim",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the library's settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def bucket_join_session(spark: SparkSession) -> SparkSession:
    """A sibling session (same tables) in which a join on (a, b) may use buckets on a alone.

    The setting is kept away from other jobs: there, placing rows by part of the join key would
    pile up the rows of a hot value that the full key spreads.
    """
    sibling = configure(spark.newSession())
    sibling.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    sibling.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return sibling


def small_task_session(spark: SparkSession) -> SparkSession:
    """A sibling session (same tables) whose tasks take few rows, for jobs that sort whole tables of narrow rows.

    A row of some numbers and a short name takes about 12 bytes of a file or shuffle, but over 100 of a sort: by
    Spark's defaults (128 MB of a file, 64 MB of a shuffle) a task would sort up to ten million of them.
    """
    sibling = configure(spark.newSession())
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    sibling.conf.set("spark.sql.shuffle.partitions", partitions)
    sibling.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(LEAST_PARTITIONS, int(partitions))))
    sibling.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", SMALL_PARTITION)
    sibling.conf.set("spark.sql.files.maxPartitionBytes", SMALL_SPLIT)
    return sibling


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; on a cluster a machine-local
    folder would be lost with its machine, so the call fails instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="factdim-")
        base = _local_scratch[context.applicationId]
    return f"{base.rstrip('/')}/factdim/{label}-{uuid.uuid4().hex}"
