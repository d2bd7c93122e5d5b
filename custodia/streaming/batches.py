"""Micro-batches and the folders they are written to."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def triggered(writer: DataStreamWriter, interval: str | None = None) -> DataStreamWriter:
    """Run on an interval, or once over all that is available when none is given."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def each_batch(
    rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Run a function on every micro-batch; a batch that failed is handed over again with the same number."""
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()


def writer_name(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the writer that owns a checkpoint, kept in its folder.

    Batch numbers start at 0 in every checkpoint. With the writer's name in front, two streams, or one
    stream under a new checkpoint, never replace each other's batches in a shared table.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/writer")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        stream = fs.create(path, False)
        stream.write(uuid.uuid4().hex.encode())
        stream.close()
    return spark.read.text(path.toString()).first()[0]


def write_batch(
    rows: DataFrame, path: str, batch_id: int, fmt: str = "parquet", partition: list[str] | None = None, writer: str = ""
) -> None:
    """Write one micro-batch under its own folder, named by its writer and number.

    A replayed batch replaces what its first try left behind, so nothing is stored twice.
    """
    name = f"{writer}-{batch_id}" if writer else str(batch_id)
    out = rows.write.format(fmt).mode("overwrite")
    if partition:
        out = out.partitionBy(*partition)
    out.save(f"{path}/batch_id={name}")
