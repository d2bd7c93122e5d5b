"""An initial snapshot joined to a running change log.

The snapshot is read in chunks while changes go on. The positions of the log just before and just after
a chunk's reading fence it in: the chunk holds every change up to ``low``, none beyond ``high``, and of those
between them nobody can tell. A row of the chunk whose key changes inside the fence is therefore dropped, as the log
has its newer state; every other row takes its place in the log at ``high``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.operators.customers import fold_changes

CHUNK, LOW, HIGH = "chunk", "low", "high"


def chunk_of(keys: list[str], chunks: int) -> Column:
    """The chunk of a key, by hash, so that a table is cut without a shuffle and every key lies in one chunk."""
    return F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int")


def fenced(rows: DataFrame, fences: DataFrame) -> DataFrame:
    """Rows with their chunk's ``low`` and ``high``; there is one fence a chunk.

    A chunk without a fence was not read to its end. Its rows say nothing and are left out.
    """
    return rows.join(fences.select(CHUNK, LOW, HIGH), CHUNK)


def surviving_reads(rows: DataFrame, fences: DataFrame, changes: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Rows of the snapshot whose key does not change inside their fence, with ``position`` at the fence's high end.

    A change at ``high`` itself counts as inside, so no read ever shares its position with a change of its
    key. Changes meet one row of the snapshot each; a key with most of the changes is split by the skew join.
    """
    inside = fenced(rows, fences)
    touched = (
        changes.select(*keys, F.col(position).alias("_at"))
        .join(inside.select(*keys, LOW, HIGH), keys)
        .where((F.col("_at") > F.col(LOW)) & (F.col("_at") <= F.col(HIGH)))
        .select(*keys)
        .distinct()
    )
    kept = inside.join(touched, keys, "left_anti").withColumn(position, F.col(HIGH))
    return kept.drop(CHUNK, LOW, HIGH)


def interleave(
    rows: DataFrame, fences: DataFrame, changes: DataFrame, keys: list[str], position: str, deleted: str = "is_delete"
) -> DataFrame:
    """One log of snapshot reads (``op`` is ``read``) and changes, to be applied in order of ``position``.

    Whoever applies it, from its start and in order, has the state of the source at its end.
    """
    reads = surviving_reads(rows, fences, changes, keys, position).withColumn(deleted, F.lit(False))
    return reads.withColumn("op", F.lit("read")).unionByName(changes.withColumn("op", F.lit("change")), allowMissingColumns=True)


def state_after(
    rows: DataFrame, fences: DataFrame, changes: DataFrame, keys: list[str], position: str, deleted: str = "is_delete"
) -> DataFrame:
    """Current state from a snapshot and the changes since it began."""
    log = interleave(rows, fences, changes, keys, position, deleted).drop("op")
    return fold_changes(log, keys, [F.col(position)], F.col(deleted)).drop(deleted)
