"""Session settings shared by every job."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results; applied to any session a job is handed.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of making the document unparseable.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# The JVM does not compile methods beyond 8000 bytes of bytecode. Long rule lists would be generated
# as one such method; below this limit Spark splits them instead.
CODEGEN_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings that change speed only; applied when this module builds the session.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "5",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "custodia", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the settings the operators rely on.

    On a cluster the master, memory and shuffle width come from ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING_CONF, **SEMANTIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that fix results, and the code size limit, to a session created elsewhere."""
    for key, value in {**SEMANTIC_CONF, **CODEGEN_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    A temporary folder stands in only for a local session that names none.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="custodia-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpointing(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


@contextmanager
def state_partitions(spark: SparkSession, count: int | None = None) -> Iterator[None]:
    """Start stateful streams with this many state stores, by default one per core.

    The number is fixed for the life of a checkpoint, so it is worth choosing; the session default of
    shuffle partitions is made for batch shuffles, which adaptive execution can still merge.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)
