"""One commit over several sinks.

A micro-batch that goes to several tables is written table by table, so a reader, or a driver that dies in
between, could find it in one and not in another. Here the batch counts only once a record of it
stands in a commit log, which is written after all tables; readers join the log, so a batch is
seen in all of them or in none. A batch that is handed over again after its record was written is not written
anew; one that died before is replaced as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custodia.streaming.batches import each_batch, write_batch, writer_name

RECORD = "batch_id string, sinks array<string>"

Split = Callable[[DataFrame], dict[str, DataFrame]]


def _file(spark: SparkSession, path: str):
    context = spark.sparkContext
    name = context._jvm.org.apache.hadoop.fs.Path(path)
    return name, name.getFileSystem(context._jsc.hadoopConfiguration())


def is_committed(spark: SparkSession, log: str, batch: str) -> bool:
    name, fs = _file(spark, f"{log.rstrip('/')}/{batch}.json")
    return fs.exists(name)


def commit(spark: SparkSession, log: str, batch: str, sinks: list[str]) -> None:
    """Write the record beside its place and rename it, so that there is all of it or nothing."""
    name, fs = _file(spark, f"{log.rstrip('/')}/{batch}.json")
    staged, _ = _file(spark, f"{log.rstrip('/')}/_{batch}.staged")
    stream = fs.create(staged, True)
    stream.write((json.dumps({"batch_id": batch, "sinks": sinks}) + "\n").encode())
    stream.close()
    if not fs.rename(staged, name) and not fs.exists(name):
        raise OSError(f"cannot commit {batch}")


def write_all(batch: DataFrame, split: Split, number: int, writer: str, log: str | None, fmt: str = "parquet") -> None:
    """Write one micro-batch to several tables, reading it once, and commit it where there is a log.

    ``split`` makes the rows of each table, named by its folder.
    """
    spark, name = batch.sparkSession, f"{writer}-{number}"
    if log is not None and is_committed(spark, log, name):
        return
    batch.persist()
    try:
        parts = split(batch)
        for path, rows in parts.items():
            write_batch(rows, path, number, fmt, writer=writer)
    finally:
        batch.unpersist()
    if log is not None:
        commit(spark, log, name, sorted(parts))


def atomic_fan_out(rows: DataFrame, split: Split, log: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """A stream into several tables that agree at any time, whatever dies."""
    writer = writer_name(rows.sparkSession, checkpoint)
    return each_batch(rows, lambda batch, number: write_all(batch, split, number, writer, log), checkpoint, interval)


def committed(spark: SparkSession, log: str) -> DataFrame:
    """Batches that count; empty while there is no log."""
    name, fs = _file(spark, log)
    if not fs.exists(name):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("pathGlobFilter", "*.json").json(log)


def read_committed(spark: SparkSession, path: str, log: str) -> DataFrame:
    """Rows of a table that belong to committed batches.

    The batch is a folder of the table, so folders of other batches are pruned and never read.
    """
    name, fs = _file(spark, path)
    if not fs.exists(name):
        raise FileNotFoundError(path)
    rows = spark.read.option("mergeSchema", True).parquet(path).withColumn("batch_id", F.col("batch_id").cast("string"))
    return rows.join(committed(spark, log).select("batch_id"), "batch_id", "left_semi").drop("batch_id")
