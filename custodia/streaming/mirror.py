"""Change streams to a mirrored table.

Without a transactional table format the mirror is a table of change batches; a reader
folds them to the newest row per key. A batch is stored under its writer and number, so a replay
replaces itself and nothing else, and ``fold_mirror`` folds all batches into one base batch. Where Delta is deployed, ``merge_delta``
upserts in place instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custodia.operators.customers import fold_changes, latest_per_key
from custodia.sources.schemas import additive_columns
from custodia.sources.writers import merge_statement
from custodia.streaming.batches import each_batch, write_batch, writer_name


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: str, deleted: str = "is_delete") -> DataFrame:
    """Target after applying changes by key; columns that only the changes have are added."""
    additive_columns(target.schema, changes.drop(deleted).schema)
    current = target.withColumn(deleted, F.lit(False))
    stacked = current.unionByName(changes, allowMissingColumns=True)
    return fold_changes(stacked, keys, [F.col(order)], F.col(deleted)).drop(deleted)


def mirror_stream(
    changes: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, interval: str | None = None
) -> StreamingQuery:
    """Store the newest change per key of every micro-batch; deletes are kept as marked rows.

    Changes without a key name no row and are left out; ``rejected_changes`` finds them.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    writer = writer_name(changes.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_per_key(batch.filter(keyed), keys, [F.col(order)]), f"{path}/changes", batch_id, writer=writer)

    return each_batch(changes, write, checkpoint, interval)


def read_mirror(spark: SparkSession, path: str, keys: list[str], order: str, deleted: str = "is_delete") -> DataFrame:
    """Current rows of the mirror."""
    changes = spark.read.option("mergeSchema", True).parquet(f"{path}/changes").drop("batch_id")
    return fold_changes(changes, keys, [F.col(order)], F.col(deleted)).drop(deleted)


def merge_delta(batch: DataFrame, table: str, keys: list[str], order: str, deleted: str = "is_delete") -> None:
    """Upsert one micro-batch into a Delta table; the batch is first reduced to one row per key."""
    newest = latest_per_key(batch, keys, [F.col(order)])
    view = f"staged_{table.replace('.', '_').replace('`', '')}"
    newest.createOrReplaceTempView(view)
    columns = [c for c in newest.columns if c != deleted]
    batch.sparkSession.sql(merge_statement(table, view, keys, columns, deleted))


def fold_mirror(spark: SparkSession, path: str, target: str, keys: list[str], order: str) -> None:
    """Write the newest change per key of all batches as the base of a new mirror folder.

    The base has a name of its own, so the batches of a stream that goes on there are added to it.

    Marked deletes stay, so that a change which arrives late cannot bring a deleted key back.
    """
    changes = spark.read.option("mergeSchema", True).parquet(f"{path}/changes").drop("batch_id")
    write_batch(latest_per_key(changes, keys, [F.col(order)]), f"{target}/changes", 0, writer="base")
